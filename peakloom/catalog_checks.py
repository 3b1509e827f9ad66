"""Queries over paired checks, cross-modal gaps, and filters of links."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import catalog
from .operators import links, pairing, regulons, validate
from .plans import canonical as c
from .registered import query

_OBS_A = "SELECT c_custkey AS place, CASE WHEN c_custkey % 211 = 7 THEN c_custkey - 1 ELSE c_custkey END AS obs_id FROM customer"
_OBS_B = "SELECT c_custkey AS place, CASE WHEN c_custkey % 97 = 3 THEN c_custkey + 1000000 ELSE c_custkey END AS obs_id FROM customer"
_GENE = "SELECT CASE p_partkey % 50 WHEN 0 THEN '' WHEN 1 THEN ' ' || p_name WHEN 2 THEN 'NA' ELSE p_name || p_partkey END AS name FROM part"
_REGION = "SELECT CASE p_partkey % 60 WHEN 0 THEN 'chr1-5-9' WHEN 1 THEN 'chr1:x-9' WHEN 2 THEN 'chr1:' || p_partkey || '-3' WHEN 3 THEN 'chr1:-4-' || p_partkey WHEN 4 THEN '7:1-' || (p_partkey + 9) ELSE 'chr2:' || p_partkey || '-' || (p_partkey + 50) END AS name FROM part"
_VALUE = "SELECT o_custkey AS obs_id, CASE WHEN o_custkey % 83 = 1 OR o_orderkey % 401 = 2 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 409 = 5 THEN CAST('inf' AS DOUBLE) ELSE o_totalprice END AS value FROM orders"
_RE = r"'^([^:]*):(-?[0-9]+)-(-?[0-9]+)$'"
_ONE = lambda name, sql: f"SELECT '{name}' AS \"check\", (SELECT count(*) FROM ({sql})) AS n, (SELECT coalesce(string_agg(item, ' | ' ORDER BY item), '') FROM (SELECT DISTINCT CAST(item AS VARCHAR) AS item FROM ({sql}) ORDER BY 1 LIMIT 3)) AS examples"
_CHECKS = {
    "obs_only_first": "SELECT obs_id AS item FROM a WHERE obs_id NOT IN (SELECT obs_id FROM b)",
    "obs_only_second": "SELECT obs_id AS item FROM b WHERE obs_id NOT IN (SELECT obs_id FROM a)",
    "obs_order": "SELECT place AS item FROM a FULL JOIN b USING (place) WHERE a.obs_id IS DISTINCT FROM b.obs_id",
    "obs_repeated": "SELECT obs_id AS item FROM a GROUP BY 1 HAVING count(*) > 1",
    "gene_repeated": "SELECT name AS item FROM g GROUP BY 1 HAVING count(*) > 1",
    "gene_placeholder": "SELECT name AS item FROM g WHERE lower(trim(name)) IN ('', 'nan', 'none', 'null', 'na')",
    "gene_padded": "SELECT name AS item FROM g WHERE name <> trim(name)",
    "region_repeated": "SELECT name AS item FROM r GROUP BY 1 HAVING count(*) > 1",
    "region_no_colon": "SELECT name AS item FROM r WHERE NOT contains(name, ':')",
    "region_unparsed": f"SELECT name AS item FROM r WHERE contains(name, ':') AND NOT regexp_matches(name, {_RE})",
    "region_negative": "SELECT name AS item FROM p WHERE s < 0 OR e < 0",
    "region_inverted": "SELECT name AS item FROM p WHERE e <= s",
    "region_no_chr": "SELECT name AS item FROM p WHERE NOT starts_with(chrom, 'chr')",
    "value_not_finite": "SELECT obs_id AS item FROM v WHERE NOT isfinite(value)",
    "obs_without_value": "SELECT obs_id AS item FROM v GROUP BY 1 HAVING count(*) FILTER (WHERE isfinite(value)) = 0",
}


@query(f"WITH a AS ({_OBS_A}), b AS ({_OBS_B}), g AS ({_GENE}), r AS ({_REGION}), v AS ({_VALUE}), p AS (SELECT name, regexp_extract(name, {_RE}, 1) AS chrom, TRY_CAST(regexp_extract(name, {_RE}, 2) AS BIGINT) AS s, TRY_CAST(regexp_extract(name, {_RE}, 3) AS BIGINT) AS e FROM r WHERE regexp_matches(name, {_RE})) " + " UNION ALL ".join(_ONE(*x) for x in _CHECKS.items()))
def paired_checks(spark, sf_dir):
    """Fifteen checks of a paired object made of customers, parts and orders with planted faults."""
    cust, part, orders = (c.table(spark, sf_dir, t) for t in ("customer", "part", "orders"))
    k, p = F.col("c_custkey"), F.col("p_partkey")
    a = cust.select(k.alias("place"), F.when(k % 211 == 7, k - 1).otherwise(k).alias("obs_id"))
    b = cust.select(k.alias("place"), F.when(k % 97 == 3, k + 1_000_000).otherwise(k).alias("obs_id"))
    genes = part.select(F.when(p % 50 == 0, "").when(p % 50 == 1, F.concat(F.lit(" "), "p_name")).when(p % 50 == 2, "NA").otherwise(F.concat("p_name", p.cast("string"))).alias("name"))
    n = p.cast("string")
    regions = part.select(F.when(p % 60 == 0, "chr1-5-9").when(p % 60 == 1, "chr1:x-9").when(p % 60 == 2, F.concat(F.lit("chr1:"), n, F.lit("-3"))).when(p % 60 == 3, F.concat(F.lit("chr1:-4-"), n)).when(p % 60 == 4, F.concat(F.lit("7:1-"), (p + 9).cast("string"))).otherwise(F.concat(F.lit("chr2:"), n, F.lit("-"), (p + 50).cast("string"))).alias("name"))
    o, key = F.col("o_custkey"), F.col("o_orderkey")
    values = orders.select(o.alias("obs_id"), F.when((o % 83 == 1) | (key % 401 == 2), float("nan")).when(key % 409 == 5, float("inf")).otherwise(F.col("o_totalprice")).alias("value"))
    return validate.paired_checks(a, b, genes, regions, values)


_NEAR = catalog._KNN.split(", p AS (")[0]
_SIDE = lambda m: f"p{m} AS (SELECT a.grp, a.obs_id AS anchor, z.obs_id, round(1 - list_dot_product(CAST(a.z AS DOUBLE[]), CAST(z.z AS DOUBLE[])) / sqrt(list_dot_product(CAST(a.z AS DOUBLE[]), CAST(a.z AS DOUBLE[])) * list_dot_product(CAST(z.z AS DOUBLE[]), CAST(z.z AS DOUBLE[]))), 9) AS dist FROM a JOIN z USING (grp) WHERE z.modality = {m}), m{m} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp, anchor ORDER BY dist, obs_id) AS rank FROM p{m}) WHERE rank <= 5), s{m} AS (SELECT grp, count(DISTINCT anchor) AS a, any_value(n) AS n, avg(dist) AS mean, max(dist) AS hi, count(*) / any_value(n) AS reuse, count(DISTINCT obs_id) / any_value(n) AS used FROM m{m} JOIN (SELECT grp, count(*) AS n FROM z WHERE modality = {m} GROUP BY 1) USING (grp) GROUP BY grp)"


@query(f"WITH {_NEAR}, {_SIDE(0)}, {_SIDE(1)}, g AS (SELECT grp, median(abs(y.dist - x.dist)) AS med, quantile_cont(abs(y.dist - x.dist), 0.95) AS p95 FROM m0 x JOIN m1 y USING (grp, anchor) WHERE x.rank = 1 AND y.rank = 1 GROUP BY grp) SELECT grp, s0.a AS n_metacells, s0.n AS n_0, round(s0.mean, 6) AS mean_0, round(s0.hi, 6) AS max_0, round(s0.reuse, 6) AS reuse_0, round(s0.used, 6) AS used_0, s1.n AS n_1, round(s1.mean, 6) AS mean_1, round(s1.hi, 6) AS max_1, round(s1.reuse, 6) AS reuse_1, round(s1.used, 6) AS used_1, round(med, 6) AS median_gap, round(p95, 6) AS p95_gap FROM s0 JOIN s1 USING (grp) JOIN g USING (grp)")
def cross_modal_gap(spark, sf_dir):
    """Anchors against both modalities of their group."""
    z, a = catalog._anchors(spark, sf_dir)
    g = pairing.cross_modal(a, c.latents(spark, sf_dir), 5)
    return g.select(*(F.round(k, 6).alias(k) if t == "double" else F.col(k) for k, t in g.dtypes))


@query(f"WITH l AS ({c.LINKS_SQL}) SELECT target, region, importance, rho FROM l WHERE importance >= 8 AND abs(rho) >= 0.3 AND TRY_CAST(trim(distance, '[]') AS BIGINT) IS NOT NULL")
def strong_links(spark, sf_dir):
    return links.specific(c.links(spark, sf_dir), "importance", "rho", "distance", 8, 0.3).select("target", "region", "importance", "rho")


@query(f"WITH l AS ({c.LINKS_SQL}) SELECT target, count(*) AS n FROM l WHERE region IN (SELECT 'chr' || (p_partkey % 22 + 1) || ':' || (p_partkey * 1000) || '-' || (p_partkey * 1000 + 501) FROM part WHERE p_size > 10) AND target IN (SELECT printf('gene%02d', s_suppkey) FROM supplier) GROUP BY target")
def present_links(spark, sf_dir):
    """Links by target whose region is a part's and whose target is a supplier's."""
    k = F.col("p_partkey")
    regions = c.table(spark, sf_dir, "part").where("p_size > 10").select(F.format_string("chr%d:%d-%d", k % 22 + 1, k * 1000, k * 1000 + 501).alias("region"))
    targets = c.table(spark, sf_dir, "supplier").select(F.format_string("gene%02d", "s_suppkey").alias("target"))
    return links.present(c.links(spark, sf_dir), regions, targets).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH l AS ({c.LINKS_SQL}), q AS (SELECT target, quantile_cont(importance, [0.9]) AS q FROM l GROUP BY 1), k AS (SELECT l.*, q, row_number() OVER (PARTITION BY target ORDER BY importance DESC, region) AS k, row_number() OVER (PARTITION BY region ORDER BY importance DESC, target) AS kr FROM l JOIN q USING (target)), s AS (SELECT target, region, CASE WHEN rho >= 0.05 THEN '+' WHEN rho <= -0.05 THEN '-' END AS sign, (importance >= q[1])::INT + (k <= 10)::INT + (kr <= 1)::INT + (kr <= 3)::INT AS n_methods FROM k) SELECT * FROM (SELECT target, region, sign, n_methods FROM s WHERE n_methods > 0 AND sign IS NOT NULL) QUALIFY count(*) OVER (PARTITION BY target) >= 20")
def link_sets_per_region(spark, sf_dir):
    """Link sets with tops per region beside those per target, of targets with twenty regions or more."""
    return regulons.link_sets(c.links(spark, sf_dir), (0.9,), (10,), tops_region=(1, 3), least_regions=20)
