"""Queries over enrichment, regulons, topics, controls and thresholds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .functions import stats
from .operators import controls, links, matrix, regulons, topics
from .plans import canonical as c
from .registered import oracle_sql, queries, query

_SCORES = "SELECT 'm' || (l_suppkey * 7 + l_linenumber) % 20 AS motif, l_partkey AS region, sum(l_quantity) AS score FROM lineitem GROUP BY ALL"
_SETS = "SELECT DISTINCT l_partkey % 6 AS set, l_partkey AS region FROM lineitem"


def _scores(spark, sf_dir):
    l = c.table(spark, sf_dir, "lineitem")
    motif = F.concat(F.lit("m"), ((F.col("l_suppkey") * 7 + F.col("l_linenumber")) % 20).cast("string"))
    return l.groupBy(motif.alias("motif"), F.col("l_partkey").alias("region")).agg(F.sum("l_quantity").alias("score"))


@query(f"""WITH s AS ({_SCORES}), t AS ({_SETS}), p AS (SELECT CAST(greatest(round(count(DISTINCT region) * 0.05), 1) AS BIGINT) AS top FROM s),
k AS (SELECT s.*, row_number() OVER (PARTITION BY motif ORDER BY score DESC, region) AS k FROM s), n AS (SELECT set, count(*) AS n FROM t GROUP BY 1),
h AS (SELECT set, motif, sum(top - k + 1) AS area FROM k JOIN t USING (region), p WHERE k <= top GROUP BY ALL),
a AS (SELECT n.set, m.motif, coalesce(area, 0) / (top * n) AS auc FROM n CROSS JOIN (SELECT DISTINCT motif FROM s) m CROSS JOIN p LEFT JOIN h ON h.set = n.set AND h.motif = m.motif)
SELECT set, motif, round(auc, 6) AS auc, round(CASE WHEN stddev_pop(auc) OVER w > 0 THEN (auc - avg(auc) OVER w) / stddev_pop(auc) OVER w END, 5) AS nes FROM a WINDOW w AS (PARTITION BY set)""")
def motif_enrichment(spark, sf_dir):
    sets = c.table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 6).alias("set"), F.col("l_partkey").alias("region")).distinct()
    r = regulons.recovery(_scores(spark, sf_dir), sets, 0.05)
    return r.select("set", "motif", F.round("auc", 6).alias("auc"), F.round("nes", 5).alias("nes"))


_NAMED = "SELECT 'm' || p_partkey % 20 AS motif, 'gene' || printf('%02d', p_partkey % 37) AS tf, CASE WHEN p_size % 2 = 0 THEN 'direct' ELSE 'extended' END AS kind, p_size % 9 / 4000.0 AS fdr, p_size % 3 / 3.0 AS identity FROM part"
_CIS = f"s AS ({_SCORES}), a AS ({_NAMED}), l AS ({c.LINKS_SQL}), x AS (SELECT DISTINCT tf, kind, region FROM s JOIN a USING (motif) WHERE score >= 100 AND (kind = 'direct' OR (fdr <= 0.001 AND identity >= 0)) AND tf IN (SELECT target FROM l))"


def _cistromes(spark, sf_dir, along=None):
    k, size = F.col("p_partkey"), F.col("p_size")
    named = c.table(spark, sf_dir, "part").select(F.concat(F.lit("m"), (k % 20).cast("string")).alias("motif"), F.format_string("gene%02d", k % 37).alias("tf"), F.when(size % 2 == 0, "direct").otherwise("extended").alias("kind"), (size % 9 / 4000.0).alias("fdr"), (size % 3 / 3.0).alias("identity"))
    return regulons.cistromes(_scores(spark, sf_dir).where("score >= 100"), named, c.links(spark, sf_dir).select(F.col("target").alias("tf")), along=along)


@query(f"WITH {_CIS} SELECT tf, kind, count(*) AS n_regions, CAST(sum(region) AS BIGINT) AS regions FROM x GROUP BY ALL")
def cistromes(spark, sf_dir):
    return _cistromes(spark, sf_dir).groupBy("tf", "kind").agg(F.count(F.lit(1)).alias("n_regions"), F.sum("region").alias("regions"))


_LINKED = "q AS (SELECT target, quantile_cont(importance, [0.85, 0.9, 0.95]) AS q FROM l GROUP BY 1), k AS (SELECT l.*, q, row_number() OVER (PARTITION BY target ORDER BY importance DESC, region) AS k FROM l JOIN q USING (target)), ls AS (SELECT target, region, CASE WHEN rho >= 0.05 THEN '+' WHEN rho <= -0.05 THEN '-' END AS sign, (importance >= q[1])::INT + (importance >= q[2])::INT + (importance >= q[3])::INT + (k <= 5)::INT + (k <= 10)::INT + (k <= 15)::INT AS n_methods FROM k)"


@query(f"WITH l AS ({c.LINKS_SQL}), {_LINKED} SELECT target, region, sign, n_methods FROM ls WHERE n_methods > 0 AND sign IS NOT NULL")
def link_sets(spark, sf_dir):
    return regulons.link_sets(c.links(spark, sf_dir))


@query(f"WITH {_CIS}, {_LINKED}, j AS (SELECT tf, kind, sign, x.region, target FROM x JOIN ls ON CAST(regexp_extract(ls.region, ':([0-9]+)-', 1) AS BIGINT) = x.region * 1000 WHERE n_methods > 0 AND sign IS NOT NULL) SELECT tf, kind, sign, count(DISTINCT region) AS n_regions, count(DISTINCT target) AS n_targets FROM j GROUP BY ALL HAVING count(DISTINCT target) >= 10")
def regulon_assembly(spark, sf_dir):
    l = regulons.link_sets(c.links(spark, sf_dir)).withColumn("region", (F.regexp_extract("region", r":([0-9]+)-", 1).cast("bigint") / 1000).cast("bigint"))
    return regulons.assemble(_cistromes(spark, sf_dir, regulons.targets_of(l)), least=10)


_LIST = "SELECT o_orderkey AS item, o_totalprice AS weight FROM orders"


@query(f"""WITH r AS ({_LIST}), t AS (SELECT o_custkey % 8 AS set, o_orderkey AS item FROM orders),
x AS (SELECT s.set, r.item, abs(weight) AS w, row_number() OVER (PARTITION BY s.set ORDER BY weight DESC, r.item) AS p, t.item IS NOT NULL AS hit FROM (SELECT DISTINCT set FROM t) s CROSS JOIN r LEFT JOIN t ON t.set = s.set AND t.item = r.item),
c AS (SELECT set, p, hit, sum(CASE WHEN hit THEN w ELSE 0 END) OVER (PARTITION BY set ORDER BY p) / sum(CASE WHEN hit THEN w ELSE 0 END) OVER (PARTITION BY set) - count(*) FILTER (WHERE NOT hit) OVER (PARTITION BY set ORDER BY p) / count(*) FILTER (WHERE NOT hit) OVER (PARTITION BY set) AS v FROM x)
SELECT set, count(*) FILTER (WHERE hit) AS n_hits, round(CASE WHEN max(v) >= -min(v) THEN max(v) ELSE min(v) END, 6) AS score FROM c GROUP BY set""")
def running_enrichment(spark, sf_dir):
    o = c.table(spark, sf_dir, "orders")
    sets = o.select((F.col("o_custkey") % 8).alias("set"), F.col("o_orderkey").alias("item"))
    return regulons.running_enrichment(o.select(F.col("o_orderkey").alias("item"), F.col("o_totalprice").alias("weight")), sets).withColumn("score", F.round("score", 6))


@query("SELECT p_type AS family, count(DISTINCT p_brand) AS n, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS members FROM part WHERE p_size < 15 GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def motif_families(spark, sf_dir):
    return regulons.families(c.table(spark, sf_dir, "part").where("p_size < 15").select(F.col("p_type").alias("family"), F.col("p_brand").alias("member")))


# --- topics and variable features --------------------------------------------------------------------------------


@query(f"WITH e AS (SELECT obs_id, var_id FROM ({c.ENTRIES_SQL}) WHERE value >= 10), v AS (SELECT *, count(*) OVER (PARTITION BY var_id) AS m FROM e), o AS (SELECT *, count(*) OVER (PARTITION BY obs_id) AS k FROM v WHERE m >= 3) SELECT var_id, count(*) AS n FROM o WHERE k >= 2 GROUP BY 1")
def accessible_counts(spark, sf_dir):
    return topics.accessible(c.entries(spark, sf_dir), 10, 3, 2).groupBy("var_id").agg(F.count(F.lit(1)).alias("n"))


_WEIGHTS = "SELECT p_brand AS topic, p_partkey AS region, CAST(p_size AS DOUBLE) AS weight FROM part"


def _weights(spark, sf_dir):
    return c.table(spark, sf_dir, "part").select(F.col("p_brand").alias("topic"), F.col("p_partkey").alias("region"), F.col("p_size").cast("double").alias("weight"))


@query(f"SELECT topic, region, weight FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, region) AS k FROM ({_WEIGHTS})) WHERE k <= 4")
def topic_top_regions(spark, sf_dir):
    return topics.top_regions(_weights(spark, sf_dir), 4)


@query(f"""WITH t AS ({_WEIGHTS}), r AS (SELECT topic, min(weight) AS low, max(weight) AS high FROM t GROUP BY 1 HAVING max(weight) > min(weight)),
h AS (SELECT topic, low, high, CAST(least(floor((weight - low) / (high - low) * 64), 63) AS BIGINT) AS bin, count(*) AS n FROM t JOIN r USING (topic) GROUP BY ALL),
x AS (SELECT *, CAST(sum(n) OVER u AS DOUBLE) AS w0, CAST(sum(n * bin) OVER u AS DOUBLE) AS s0, CAST(sum(n) OVER a AS DOUBLE) AS w, CAST(sum(n * bin) OVER a AS DOUBLE) AS s FROM h WINDOW u AS (PARTITION BY topic ORDER BY bin), a AS (PARTITION BY topic)),
b AS (SELECT topic, arg_min((bin, low, high), (-((s0 * w - s * w0) * (s0 * w - s * w0) / (w0 * (w - w0))), bin)) AS b FROM x WHERE w0 < w GROUP BY 1)
SELECT topic, b[1] AS bin, round(b[2] + (b[1] + 1) * (b[3] - b[2]) / 64, 6) AS threshold FROM b""")
def topic_otsu(spark, sf_dir):
    return topics.otsu(_weights(spark, sf_dir)).withColumn("threshold", F.round("threshold", 6))


@query(f"""WITH {c.DENSE_SQL}, i AS (SELECT var_id, avg(value) AS mean, var_samp(value) / avg(value) AS dispersion FROM d GROUP BY 1), r AS (SELECT min(mean) AS low, max(mean) AS high FROM i),
b AS (SELECT i.*, CASE WHEN high > low THEN least(floor((mean - low) / (high - low) * 20), 19) ELSE 0 END AS b FROM i, r)
SELECT var_id, round(mean, 5) AS mean, round(dispersion, 5) AS dispersion, round(CASE WHEN count(*) OVER w = 1 THEN 1.0 ELSE (dispersion - avg(dispersion) OVER w) / nullif(stddev_samp(dispersion) OVER w, 0) END, 4) AS score FROM b WINDOW w AS (PARTITION BY b)""")
def variable_features(spark, sf_dir):
    v = topics.variable_features(c.entries(spark, sf_dir), c.obs(spark, sf_dir))
    return v.select("var_id", F.round("mean", 5).alias("mean"), F.round("dispersion", 5).alias("dispersion"), F.round("score", 4).alias("score"))


@query()
def topic_model(spark, sf_dir):
    """Topics of the accessible matrix: each topic's five heaviest variables."""
    words, model, _ = topics.fit_topics(topics.accessible(c.entries(spark, sf_dir), 5), 3)
    return topics.heaviest(model, words, 5)


# --- controls and thresholds -------------------------------------------------------------------------------------


@query("""WITH t AS (SELECT p_size % 4 AS stratum, p_retailprice AS x, p_partkey % 3 = 0 AS d FROM part), r AS (SELECT *, rank() OVER (PARTITION BY stratum ORDER BY x) + (count(*) OVER (PARTITION BY stratum, x) - 1) / 2 AS r FROM t),
m AS (SELECT stratum, sum(m * m * m - m) AS ties FROM (SELECT stratum, x, CAST(count(*) AS DOUBLE) AS m FROM t GROUP BY ALL) GROUP BY 1), g AS (SELECT stratum, count(*) FILTER (WHERE d) AS n1, count(*) FILTER (WHERE NOT d) AS n2, sum(r) FILTER (WHERE d) AS s FROM r GROUP BY 1), u AS (SELECT *, s - n1 * (n1 + 1) / 2 AS u, n1 + n2 AS n, CAST(n1 * n2 AS DOUBLE) AS p FROM g JOIN m USING (stratum))
SELECT stratum, n1, n2, round(2 * u / p - 1, 6) AS effect, round((u - p / 2) / sqrt(p / 12 * (n + 1 - ties / (n * (n - 1)))), 5) AS z FROM u""")
def rank_biserial(spark, sf_dir):
    p = c.table(spark, sf_dir, "part").select((F.col("p_size") % 4).alias("stratum"), F.col("p_retailprice").alias("x"), (F.col("p_partkey") % 3 == 0).alias("is_dropped"))
    return controls.rank_biserial(p).withColumns({"effect": F.round("effect", 6), "z": F.round("z", 5)})


_EFF = f"{c.DENSE_SQL}, g AS (SELECT var_id, grp, sum(value) AS t, count(*) AS n FROM d GROUP BY ALL), f AS (SELECT var_id, grp, log2(t / n + 1e-6) - log2((sum(t) OVER w - t) / (sum(n) OVER w - n) + 1e-6) AS eff FROM g WINDOW w AS (PARTITION BY var_id))"


@query(f"WITH {_EFF}, h AS (SELECT unnest(range(0, 301)) AS t100 UNION SELECT unnest(range(350, 2401, 50))), s AS (SELECT t100, grp, count(*) FILTER (WHERE eff >= t100 / 100) AS n FROM h CROSS JOIN f GROUP BY ALL), m AS (SELECT t100, max(n) AS hi FROM s GROUP BY 1) SELECT min(t100) FILTER (WHERE hi <= 1) AS t100, count(*) AS n_tried FROM m")
def threshold_extend(spark, sf_dir):
    """The least threshold that no group passes more than once: hundredths to 3, then steps of a half to 24."""
    grid = spark.range(0, 301).union(spark.range(350, 2401, 50)).select(F.col("id").alias("t100"))  # 343 thresholds
    x = matrix.fold_change(c.entries(spark, sf_dir), c.obs(spark, sf_dir)).join(F.broadcast(grid))
    s = x.groupBy("t100", "grp").agg(F.count_if(F.col("eff") >= F.col("t100") / 100).alias("n")).groupBy("t100").agg(F.max("n").alias("hi"))
    return s.agg(F.min(F.when(F.col("hi") <= 1, F.col("t100"))).alias("t100"), F.count(F.lit(1)).alias("n_tried"))


@query()
def linkage_verdict(spark, sf_dir):
    """How many markers beat their own null, against the binomial tail of 5 % chance."""
    return controls.linkage_verdict(queries()["decoy_null"](spark, sf_dir))


_T = "(rho * sqrt((n - 2) / greatest(1 - rho * rho, 1e-12)))"


@query(f"WITH s AS ({oracle_sql()['spearman_by_group']}), p AS (SELECT grp, {c.student_p_sql(_T, '(n - 2)')} AS p FROM s WHERE rho IS NOT NULL AND n > 3) SELECT grp, count(*) AS n_tests, round(avg(CASE WHEN p < 0.05 THEN 1.0 ELSE 0.0 END), 6) AS below_05, round(avg(CASE WHEN p < 0.001 THEN 1.0 ELSE 0.0 END), 6) AS below_001 FROM p GROUP BY grp")
def naive_calibration(spark, sf_dir):
    """Shares of naive correlation tests (Student's t) below 0.05 and 0.001, by group: what they would claim without a null."""
    r = queries()["spearman_by_group"](spark, sf_dir).where("rho is not null and n > 3")
    t = F.col("rho") * F.sqrt((F.col("n") - 2) / F.greatest(1 - F.col("rho") * F.col("rho"), F.lit(1e-12)))
    p = r.withColumn("t", t).withColumn("p", stats.student_p(F.col("t"), F.col("n") - 2))
    share = lambda a: F.round(F.avg((F.col("p") < a).cast("double")), 6)
    return p.groupBy("grp").agg(F.count(F.lit(1)).alias("n_tests"), share(0.05).alias("below_05"), share(0.001).alias("below_001"))
