"""Queries over guarded joins, verdicts, structure, export rows and differential enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import catalog as base
from .operators import guards, links, matrix, regulons, topics
from .plans import canonical as c
from .registered import oracle_sql, query
from .sources import tables


@query("SELECT l_linenumber AS grp, CAST(sum(l_partkey) AS BIGINT) AS starts FROM lineitem GROUP BY 1")
def zero_based_starts(spark, sf_dir):
    l = c.table(spark, sf_dir, "lineitem")
    return l.groupBy(F.col("l_linenumber").alias("grp")).agg(F.sum(guards.zero_based(F.col("l_partkey") + 1)).alias("starts"))


@query("SELECT count(*) AS n_probed, count(*) FILTER (WHERE p_partkey % 9 = 0) AS n_ensembl, CASE WHEN count(*) FILTER (WHERE p_partkey % 9 = 0) > 100 THEN 'ensembl' ELSE 'symbol' END AS kind FROM (SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 2000)")
def id_spelling(spark, sf_dir):
    """Whether ids are of one spelling, by a probe of the first 2000 (the feature's own number)."""
    p = c.table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 9 == 0, F.concat(F.lit("ENSG"), F.col("p_partkey").cast("string"))).otherwise(F.col("p_name")).alias("name"))
    return guards.id_kind(p, "name", "p_partkey")


@query("WITH g AS (SELECT c_nationkey AS grp, count(*) // 7 AS indep FROM customer GROUP BY 1) SELECT CASE WHEN indep > 20 THEN 'strong' WHEN indep >= 6 THEN 'moderate' WHEN indep >= 3 THEN 'weak' ELSE 'very weak' END AS support, count(*) AS n FROM g GROUP BY 1")
def support_ladder(spark, sf_dir):
    g = c.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.floor(F.count(F.lit(1)) / 7).alias("indep"))
    return g.groupBy(guards.support(F.col("indep")).alias("support")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN (p_partkey % 41 - 20) / 100.0 > 0.1 THEN 'custom' WHEN (p_size - 25) / 50.0 < -0.1 AND (p_partkey % 41 - 20) / 100.0 < 0.05 THEN 'precomputed' ELSE 'borderline' END AS verdict, count(*) AS n FROM part GROUP BY 1")
def database_verdicts(spark, sf_dir):
    v = guards.database_verdict((F.col("p_partkey") % 41 - 20) / 100.0, (F.col("p_size") - 25) / 50.0)
    return c.table(spark, sf_dir, "part").groupBy(v.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


_RUNS = "SELECT s_suppkey AS k, s_suppkey % 17 <> 0 AS same, CASE WHEN s_suppkey % 19 = 0 THEN 3 ELSE 0 END AS n_nan, CASE WHEN s_suppkey % 23 = 0 THEN 1 ELSE 0 END AS n_junk, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey % 11 / 10.0 END AS within, s_suppkey % 13 AS beats, 40 AS tested, s_suppkey % 7 / 50.0 * (s_suppkey % 3) / 100 AS p FROM supplier"


@query(f"WITH r AS ({_RUNS}) SELECT CASE WHEN NOT same OR n_nan > 0 OR n_junk > 0 OR coalesce(within < 0.5, false) THEN 'FAIL' WHEN p < 1e-4 AND beats / tested >= 0.15 THEN 'PASS' WHEN p < 0.05 THEN 'WARN' ELSE 'FAIL' END AS verdict, count(*) AS n FROM r GROUP BY 1")
def pairing_verdicts(spark, sf_dir):
    k = F.col("s_suppkey")
    r = c.table(spark, sf_dir, "supplier").select((k % 17 != 0).alias("same"), F.when(k % 19 == 0, 3).otherwise(0).alias("n_nan"), F.when(k % 23 == 0, 1).otherwise(0).alias("n_junk"), F.when(k % 5 != 0, k % 11 / 10.0).alias("within"), (k % 13).alias("beats"), F.lit(40).alias("tested"), (k % 7 / 50.0 * (k % 3) / 100).alias("p"))
    v = guards.pairing_verdict(*(F.col(x) for x in r.columns))
    return r.groupBy(v.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


_ODD = "SELECT user_id AS obs_id, event_type AS var_id, CASE WHEN event_id % 211 = 0 THEN 'NaN'::DOUBLE WHEN user_id % 9 = 0 THEN 0 ELSE abs(value) END AS value FROM events"


@query(f"WITH e AS ({_ODD}), o AS (SELECT DISTINCT user_id AS obs_id, CASE user_id % 6 WHEN 0 THEN 'nan' WHEN 1 THEN ' Unknown' ELSE 'g' || user_id % 6 END AS grp FROM events), p AS (SELECT obs_id, count(*) FILTER (WHERE isnan(value)) AS nan, sum(value) FILTER (WHERE NOT isnan(value)) AS s FROM e GROUP BY 1) SELECT count(*) AS n_obs, CAST(sum(nan) AS BIGINT) AS n_nan, count(*) FILTER (WHERE coalesce(s, 0) = 0 AND coalesce(nan, 0) = 0) AS n_empty, count(DISTINCT grp) AS n_groups, count(DISTINCT grp) FILTER (WHERE lower(trim(grp)) IN ('nan', 'unknown')) AS n_junk, (SELECT count(DISTINCT var_id) FROM e) AS n_vars FROM o LEFT JOIN p USING (obs_id)")
def structure_counts(spark, sf_dir):
    e = c.table(spark, sf_dir, "events")
    u = F.col("user_id")
    value = F.when(F.col("event_id") % 211 == 0, F.lit(float("nan"))).when(u % 9 == 0, 0.0).otherwise(F.abs("value"))
    grp = F.when(u % 6 == 0, "nan").when(u % 6 == 1, " Unknown").otherwise(F.concat(F.lit("g"), (u % 6).cast("string")))
    return guards.structure(e.select(u.alias("obs_id"), F.col("event_type").alias("var_id"), value.alias("value")), e.select(u.alias("obs_id"), grp.alias("grp")).distinct())


@query("SELECT DISTINCT o_custkey AS id, c_nationkey, c_acctbal FROM orders JOIN customer ON c_custkey = o_custkey")
def latent_selection(spark, sf_dir):
    t = c.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id")
    return guards.latents_for(c.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), t, "id")


@query("SELECT p_partkey AS row_idx, p_name, p_brand, p_size, p_retailprice, p_size * 2 AS label FROM part")
def positional_labels(spark, sf_dir):
    """Labels that carry no id, put to rows by place once four columns have proved the order."""
    p = c.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_idx"), "p_name", "p_brand", "p_size", "p_retailprice")
    side = p.select("row_idx", "p_name", F.col("p_size").cast("string").alias("p_size"), (F.col("p_retailprice") * 1.000001).alias("p_retailprice"), "p_brand", (F.col("p_size") * 2).alias("label"))
    return guards.positional_merge(p, side)


@query("SELECT d.source, count(*) AS n, count(*) FILTER (WHERE coalesce(toxic = 1, false)) AS n_toxic, count(*) FILTER (WHERE l.doc_id IS NULL) AS n_absent FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1")
def flag_lookup(spark, sf_dir):
    f = guards.flags_of(c.table(spark, sf_dir, "documents").select("doc_id", "source"), c.table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("toxic")), "doc_id", "toxic")
    return f.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if("toxic").alias("n_toxic"), F.count_if("absent").alias("n_absent"))


@query("SELECT c_nationkey AS grp FROM customer GROUP BY 1 HAVING count(*) >= 5")
def usable_nations(spark, sf_dir):
    s = c.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    return guards.usable_groups(s, c.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("grp")), 5)


@query("SELECT source, p_brand, count(*) AS n FROM (SELECT 'direct' AS source, p_brand FROM part WHERE p_size < 20 UNION ALL SELECT 'extended', p_brand FROM part WHERE p_size >= 10) GROUP BY ALL")
def tagged_sources(spark, sf_dir):
    p = c.table(spark, sf_dir, "part").select("p_brand", "p_size")
    return guards.tagged({"direct": p.where("p_size < 20"), "extended": p.where("p_size >= 10").drop("p_size")}).groupBy("source", "p_brand").agg(F.count(F.lit(1)).alias("n"))


_EFF = oracle_sql()["fold_change"].split(" SELECT var_id, grp, round(log2")[0]


@query(f"{_EFF}, f AS (SELECT var_id, grp, log2(t / n + 1e-6) - log2((sum(t) OVER w - t) / (sum(n) OVER w - n) + 1e-6) AS eff FROM g WINDOW w AS (PARTITION BY var_id)), k AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY eff DESC, var_id) AS k, count(*) OVER (PARTITION BY grp) AS m FROM f WHERE eff > 0), h AS (SELECT unnest([2, 5, 10, 20, 40]) AS top_n), x AS (SELECT top_n, grp, m, eff FROM h, k WHERE k = least(top_n, m)) SELECT top_n, count(*) FILTER (WHERE m < top_n) AS n_short, round(min(eff), 5) AS cutoff_lo, round(max(eff), 5) AS cutoff_hi, round(2 ** min(eff), 4) AS fold_lo, round(2 ** max(eff), 4) AS fold_hi, top_n * 0.005::DOUBLE AS expected, count(*) * top_n AS n_lines FROM x GROUP BY top_n")
def topn_report(spark, sf_dir):
    f = matrix.fold_change(c.entries(spark, sf_dir), c.obs(spark, sf_dir)).where("eff > 0")
    r = links.topn_report(f, [2, 5, 10, 20, 40])
    return r.select("top_n", "n_short", *(F.round(k, 5).alias(k) for k in ("cutoff_lo", "cutoff_hi")), *(F.round(k, 4).alias(k) for k in ("fold_lo", "fold_hi")), "expected", "n_lines")


_MARKERS = "SELECT DISTINCT var_id, length(var_id) % 5 AS grp FROM v UNION SELECT DISTINCT var_id, (ascii(right(var_id, 1)) + 2) % 5 FROM v"


@query(f"WITH {c.DENSE_SQL}, g AS (SELECT var_id, grp, avg(value) AS m FROM d GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY var_id ORDER BY round(m, 9) DESC, grp) AS k FROM g), mk AS ({_MARKERS}), n AS (SELECT var_id, count(*) AS n FROM mk GROUP BY 1), x AS (SELECT k, n FROM mk JOIN r USING (var_id, grp) JOIN n USING (var_id)) SELECT count(*) AS n_tested, round(avg(CASE WHEN k = 1 THEN 1.0 ELSE 0.0 END), 6) AS frac_top1, round(avg(CASE WHEN k <= 3 THEN 1.0 ELSE 0.0 END), 6) AS frac_top3, round(avg(CASE WHEN k <= n THEN 1.0 ELSE 0.0 END), 6) AS frac_within_listed, median(k) AS median_rank FROM x")
def marker_success(spark, sf_dir):
    e, o = c.entries(spark, sf_dir), c.obs(spark, sf_dir)
    v = e.select("var_id").distinct()
    mk = v.select("var_id", (F.length("var_id") % 5).cast("bigint").alias("grp")).union(v.select("var_id", ((F.ascii(F.right("var_id", F.lit(1))) + 2) % 5).cast("bigint"))).distinct()
    s = matrix.marker_success(mk, matrix.group_means(e, o))
    return s.select("n_tested", *(F.round(k, 6).alias(k) for k in ("frac_top1", "frac_top3", "frac_within_listed")), "median_rank")


_WEIGHTS = "SELECT p_brand AS topic, p_partkey AS region, CAST(p_size AS DOUBLE) AS weight FROM part"


def _weights(spark, sf_dir):
    return c.table(spark, sf_dir, "part").select(F.col("p_brand").alias("topic"), F.col("p_partkey").alias("region"), F.col("p_size").cast("double").alias("weight"))


@query(f"WITH t AS ({_WEIGHTS}), f AS (SELECT *, weight / sum(weight) OVER (PARTITION BY topic) AS f FROM t WHERE weight > 0) SELECT topic, count(*) AS n_regions, sum(weight) AS total, max(weight) AS top, round(max(f), 8) AS share_top, round(-sum(f * ln(f)), 6) AS entropy FROM f GROUP BY topic")
def topic_quality(spark, sf_dir):
    return topics.topic_quality(_weights(spark, sf_dir)).withColumns({"share_top": F.round("share_top", 8), "entropy": F.round("entropy", 6)})


@query(f"""WITH t AS ({_WEIGHTS}), r AS (SELECT topic, min(weight) AS low, max(weight) AS high FROM t GROUP BY 1 HAVING max(weight) > min(weight)),
h AS (SELECT topic, low, high, CAST(least(floor((weight - low) / (high - low) * 64), 63) AS BIGINT) AS bin, count(*) AS n FROM t JOIN r USING (topic) GROUP BY ALL),
f AS (SELECT *, n / sum(n) OVER (PARTITION BY topic) AS f FROM h), x AS (SELECT *, sum(f) OVER u AS p, sum(f * f) OVER u AS p2, sum(f * f) OVER a AS q2 FROM f WINDOW u AS (PARTITION BY topic ORDER BY bin ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY topic ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
b AS (SELECT topic, arg_min((bin, low, high), (-round(ln((p * (1 - p)) ** 2 / (p2 * q2)), 9), bin)) AS b FROM x WHERE q2 IS NOT NULL GROUP BY 1)
SELECT topic, b[1] AS bin, round(b[2] + (b[1] + 0.5) * (b[3] - b[2]) / 64, 6) AS threshold FROM b""")
def topic_yen(spark, sf_dir):
    return topics.yen(_weights(spark, sf_dir)).withColumn("threshold", F.round("threshold", 6))


_NAMES = "SELECT CASE l_linenumber % 4 WHEN 0 THEN 'chr' || l_suppkey || ':' || l_partkey || '-' || (l_partkey + 9) WHEN 1 THEN 'chr-' || l_suppkey || '-' || l_partkey || '-' || (l_partkey + 9) WHEN 2 THEN 'chr' || l_suppkey || ':' || l_partkey || ':' || (l_partkey + 9) ELSE 'gene' || l_partkey END AS name FROM lineitem"


@query(f"WITH n AS ({_NAMES}), p AS (SELECT CASE WHEN contains(name, ':') THEN regexp_extract(name, '^([^:]+):', 1) ELSE regexp_extract(name, '^(.+)-[0-9]+-[0-9]+$', 1) END AS chrom, TRY_CAST(regexp_extract(name, '([0-9]+)[-:][0-9]+$', 1) AS BIGINT) AS start, TRY_CAST(regexp_extract(name, '[-:]([0-9]+)$', 1) AS BIGINT) AS \"end\" FROM n) SELECT DISTINCT chrom, start, \"end\" FROM p WHERE \"end\" > start")
def catalog_of_names(spark, sf_dir):
    return tables.catalog_of_names(c.table(spark, sf_dir, "lineitem").select(F.expr(_NAMES.removeprefix("SELECT ").removesuffix(" AS name FROM lineitem")).alias("name")), "name")


@query("SELECT 'chr' || (s_suppkey % 24 + 1) AS \"Chromosome\", CAST(0 AS BIGINT) AS \"Start\", max(s_suppkey) * 1000 AS \"End\" FROM supplier WHERE s_suppkey % 24 < 5 GROUP BY 1")
def chromosome_sizes(spark, sf_dir):
    s = c.table(spark, sf_dir, "supplier").groupBy(F.concat(F.lit("chr"), (F.col("s_suppkey") % 24 + 1).cast("string")).alias("chrom")).agg((F.max("s_suppkey") * 1000).alias("length"))
    return tables.chromsizes(s, [f"chr{i}" for i in range(1, 6)])


_AUDIT = oracle_sql()["overlap_audit"].split(" SELECT chrom, start,")[0]


@query(f"""{_AUDIT} SELECT chrom || ':' || start || '-' || "end" AS peak_id, chrom, start, "end", "end" - start AS width, best_ov AS best_overlap_bp, printf('%.6f', best_frac_peak) AS best_frac_of_peak, printf('%.6f', best_frac_region) AS best_frac_of_db_region, printf('%.6f', greatest(best_frac_peak, best_frac_region)) AS best_frac_either, n_overlapping AS n_db_regions_overlapping, n_passing AS n_db_regions_passing, coalesce(best_region, 'NA') AS best_db_region, CASE WHEN chrom_in_db THEN '1' ELSE '0' END AS chrom_in_db, CASE WHEN representable THEN '1' ELSE '0' END AS representable FROM a""")
def audit_export(spark, sf_dir):
    return tables.audit_rows(base._audit(spark, sf_dir))


_ANCHORED = oracle_sql()["tss_anchor"]


def _arcs(spark, sf_dir):
    l = c.links(spark, sf_dir).withColumn("grp", F.concat(F.lit("a b/"), (F.col("importance") % 3).cast("int").cast("string")))
    first = links.top_per(links.placed(l), "grp", [F.desc("importance"), F.asc("region"), F.asc("target")], 200)  # all placed links have an anchor
    return tables.interact_rows(links.anchors(first, base._tss(spark, sf_dir).select("target", "row_idx", "tss"), ("grp", "importance", "rho")), None, "grp", "importance", 200)


_ARCS = f"""WITH a AS ({_ANCHORED}), l AS ({c.LINKS_SQL}), j AS (SELECT l.*, anchor, 'a_b-' || CAST(importance % 3 AS INTEGER) AS exp, regexp_extract(region, '^(.*):', 1) AS ch, CAST(regexp_extract(region, ':([0-9]+)-', 1) AS BIGINT) AS s, CAST(regexp_extract(region, '-([0-9]+)$', 1) AS BIGINT) AS e FROM l JOIN a USING (target, region)), k AS (SELECT *, row_number() OVER (PARTITION BY exp ORDER BY importance DESC, region, target) AS k FROM j), x AS (SELECT *, CAST(round_even(importance / max(importance) OVER (PARTITION BY exp) * 1000, 0) AS INTEGER) AS score, (s + e) // 2 AS mid FROM k WHERE k <= 200)"""


@query(f"""{_ARCS} SELECT ch AS chrom, least(mid, anchor) AS "chromStart", greatest(mid, anchor) + 1 AS "chromEnd", target || printf('|z=%.1f', importance) || coalesce(printf('|rho=%+.2f', CAST(round(CAST(rho AS DECIMAL(12, 6)), 2) AS DOUBLE)), '|rho=nan') AS name, score, importance AS value, exp, CASE WHEN rho > 0 THEN '31,111,180' ELSE '201,97,31' END AS color, ch AS "sourceChrom", s AS "sourceStart", e AS "sourceEnd", region AS "sourceName", '.' AS "sourceStrand", ch AS "targetChrom", anchor AS "targetStart", anchor + 1 AS "targetEnd", target AS "targetName", '.' AS "targetStrand" FROM x""")
def interact_export(spark, sf_dir):
    return _arcs(spark, sf_dir)


@query(f"{_ARCS} SELECT exp, ch AS chrom, s AS start, e AS \"end\", min(region) AS name, max(score) AS score, '.' AS strand FROM x GROUP BY exp, ch, s, e")
def interact_peaks(spark, sf_dir):
    return tables.peak_rows(_arcs(spark, sf_dir))


_DEM = """WITH s AS (SELECT 'm' || (l_suppkey % 8) AS motif, l_partkey % 997 AS region, CAST(max(l_quantity) AS DOUBLE) AS score FROM lineitem WHERE l_quantity > 20 GROUP BY ALL),
t AS (SELECT DISTINCT l_suppkey % 4 AS set, l_partkey % 997 AS region FROM lineitem WHERE l_partkey % 997 % 5 = l_suppkey % 4), r AS (SELECT DISTINCT l_partkey % 997 AS region, l_partkey % 997 % 3 = 0 AS is_promoter FROM lineitem)"""


@query(f"""{_DEM}, z AS (SELECT set, count(*) AS n_fg, avg(CASE WHEN is_promoter THEN 1.0 ELSE 0.0 END) AS share FROM t JOIN r USING (region) GROUP BY 1),
b AS (SELECT z.set, region, share, is_promoter, row_number() OVER (PARTITION BY z.set, is_promoter ORDER BY md5(z.set || '_' || region), region) AS k FROM z CROSS JOIN r WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.set = z.set AND t.region = r.region)),
ch AS (SELECT set, region, true AS fg FROM t UNION ALL SELECT set, region, false FROM b WHERE k <= round_even(100 * CASE WHEN is_promoter THEN share ELSE 1 - share END, 0)),
d AS (SELECT ch.set, m.motif, ch.region, fg, coalesce(s.score, 0) AS x FROM ch CROSS JOIN (SELECT DISTINCT motif FROM s) m LEFT JOIN s ON s.motif = m.motif AND s.region = ch.region),
k AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY set, motif, x) - 1) / 2 AS r FROM d WINDOW w AS (PARTITION BY set, motif ORDER BY x)),
ti AS (SELECT set, motif, sum(m * m * m - m) AS ties FROM (SELECT set, motif, x, CAST(count(*) AS DOUBLE) AS m FROM d GROUP BY ALL) GROUP BY ALL),
g AS (SELECT set, motif, count(*) FILTER (WHERE fg) AS n_fg, count(*) FILTER (WHERE NOT fg) AS n_bg, sum(r) FILTER (WHERE fg) AS rs, avg(x) FILTER (WHERE fg) AS mean_fg, avg(x) FILTER (WHERE NOT fg) AS mean_bg, count(*) FILTER (WHERE fg AND x >= 30) AS hits FROM k GROUP BY ALL),
u AS (SELECT *, (rs - n_fg * (n_fg + 1) / 2 - n_fg * n_bg / 2) / sqrt(n_fg * n_bg / 12 * (n_fg + n_bg + 1 - ties / ((n_fg + n_bg) * (n_fg + n_bg - 1.0)))) AS z FROM g JOIN ti USING (set, motif)),
pv AS (SELECT *, 2 * {c.norm_sf_sql('abs(z)')} AS p FROM u), rk AS (SELECT *, rank() OVER (PARTITION BY set ORDER BY p) + count(*) OVER (PARTITION BY set, p) - 1 AS upto, count(*) OVER (PARTITION BY set) AS m FROM pv)
SELECT set, motif, n_fg, n_bg, round(mean_fg, 6) AS mean_fg, round(log2((mean_fg + 1e-6) / (mean_bg + 1e-6)), 5) AS log2fc, hits, round(z, 5) AS z, round(p, 8) AS p, round(least(min(p * m / upto) OVER (PARTITION BY set ORDER BY p DESC), 1), 7) AS q FROM rk""")
def differential_motifs(spark, sf_dir):
    l = c.table(spark, sf_dir, "lineitem")
    region = F.col("l_partkey") % 997
    s = l.where("l_quantity > 20").groupBy(F.concat(F.lit("m"), (F.col("l_suppkey") % 8).cast("string")).alias("motif"), region.alias("region")).agg(F.max("l_quantity").cast("double").alias("score"))
    t = l.where(region % 5 == F.col("l_suppkey") % 4).select((F.col("l_suppkey") % 4).alias("set"), region.alias("region")).distinct()
    r = l.select(region.alias("region"), (region % 3 == 0).alias("is_promoter")).distinct()
    d = regulons.differential(s, t, r, background=100, hit=30.0)
    return d.select("set", "motif", "n_fg", "n_bg", F.round("mean_fg", 6).alias("mean_fg"), F.round("log2fc", 5).alias("log2fc"), "hits", F.round("z", 5).alias("z"), F.round("p", 8).alias("p"), F.round("q", 7).alias("q"))
