"""Queries over permutation nulls, topic metrics and thresholds, reduced products and signed search spaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import nulls, products, search_space, topic_metrics
from .plans import canonical as c
from .registered import query

_DRAWS = 50


@query(f"""WITH r AS (SELECT o_orderkey AS item, o_totalprice AS weight, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders), n AS (SELECT count(*) AS n FROM r),
t AS (SELECT o_custkey % 100 AS set, o_orderkey AS item FROM orders), sizes AS (SELECT DISTINCT count(*) AS size FROM t GROUP BY set),
d AS (SELECT draw, item, row_number() OVER (PARTITION BY draw ORDER BY md5(draw || '_' || item), item) AS k FROM r, range({_DRAWS}) g(draw)),
x AS (SELECT 'drawn' AS kind, size AS a, draw AS b, abs(weight) AS w, place FROM d JOIN sizes ON k <= size JOIN r USING (item) UNION ALL SELECT 'set', set, 0, abs(weight), place FROM t JOIN r USING (item)),
y AS (SELECT *, row_number() OVER o AS i, count(*) OVER g AS h, sum(w) OVER g AS total, sum(w) OVER o AS s FROM x WINDOW g AS (PARTITION BY kind, a, b), o AS (PARTITION BY kind, a, b ORDER BY place)),
z AS (SELECT kind, a, b, any_value(h) AS h, max(s / total - (place - i) / (n - h)) AS hi, min((s - w) / total - (place - i) / (n - h)) AS lo FROM y, n GROUP BY ALL),
e AS (SELECT kind, a, b, h, CASE WHEN hi >= -lo THEN hi ELSE lo END AS score FROM z)
SELECT s.a AS set, s.h AS n_hits, round(s.score, 6) AS score, count(q.score) AS n_null, count(q.score) FILTER (WHERE abs(q.score) >= abs(s.score) - 1e-12) AS n_beyond,
 round(count(q.score) FILTER (WHERE abs(q.score) >= abs(s.score) - 1e-12) / nullif(count(q.score), 0), 6) AS p, round(s.score / avg(abs(q.score)), 5) AS normalised
FROM e s LEFT JOIN e q ON q.kind = 'drawn' AND q.a = s.h AND (q.score >= 0) = (s.score >= 0) WHERE s.kind = 'set' GROUP BY s.a, s.h, s.score""")
def enrichment_null(spark, sf_dir):
    """Running enrichment of a hundred sets of orders, with the null of drawn sets of the same sizes."""
    o = c.table(spark, sf_dir, "orders")
    sets = o.select((F.col("o_custkey") % 100).alias("set"), F.col("o_orderkey").alias("item"))
    g = nulls.enrichment_null(o.select(F.col("o_orderkey").alias("item"), F.col("o_totalprice").alias("weight")), sets, _DRAWS)
    return g.withColumns({"score": F.round("score", 6), "p": F.round("p", 6), "normalised": F.round("normalised", 5)})


_TW = "SELECT l_suppkey % 8 AS topic, l_partkey % 300 AS region, CAST(sum(l_quantity) AS DOUBLE) AS weight FROM lineitem GROUP BY ALL"
_CELLS = "SELECT DISTINCT l_orderkey % 997 AS obs_id, l_partkey % 300 AS var_id FROM lineitem"


def _topic_weights(spark, sf_dir):
    l = c.table(spark, sf_dir, "lineitem")
    return l.groupBy((F.col("l_suppkey") % 8).alias("topic"), (F.col("l_partkey") % 300).alias("region")).agg(F.sum("l_quantity").cast("double").alias("weight"))


def _cells(spark, sf_dir):
    return c.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 997).alias("obs_id"), (F.col("l_partkey") % 300).alias("var_id")).distinct()


@query(f"""WITH t AS ({_TW}), c AS ({_CELLS}), k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, region) AS k FROM t) WHERE k <= 20),
m AS (SELECT obs_id, topic, k FROM c JOIN k ON region = var_id), d AS (SELECT topic, a.k AS i, b.k AS j, count(*) AS d FROM m a JOIN m b USING (obs_id, topic) WHERE a.k <= b.k GROUP BY ALL),
g AS (SELECT topic, a.k AS i, b.k AS j FROM k a JOIN k b USING (topic) WHERE a.k < b.k)
SELECT g.topic, count(*) AS n_pairs, round(avg(ln((coalesce(p.d, 0) + 1) / s.d)), 6) AS coherence FROM g JOIN d s ON s.topic = g.topic AND s.i = g.i AND s.j = g.i LEFT JOIN d p ON p.topic = g.topic AND p.i = g.i AND p.j = g.j GROUP BY g.topic""")
def topic_coherence(spark, sf_dir):
    return topic_metrics.coherence(_topic_weights(spark, sf_dir), _cells(spark, sf_dir)).withColumn("coherence", F.round("coherence", 6))


@query(f"WITH t AS ({_TW}), g AS (SELECT a.topic AS i, b.topic AS j, sum(a.weight * b.weight) AS v FROM t a JOIN t b USING (region) GROUP BY ALL) SELECT (SELECT count(DISTINCT topic) FROM t) AS n_topics, round(avg(g.v / sqrt(a.v * b.v)), 8) AS density FROM g JOIN g a ON a.i = g.i AND a.j = g.i JOIN g b ON b.i = g.j AND b.j = g.j WHERE g.i < g.j")
def topic_density(spark, sf_dir):
    return topic_metrics.density(topic_metrics.gram(_topic_weights(spark, sf_dir))).withColumn("density", F.round("density", 8))


@query()
def topic_choice(spark, sf_dir):
    """Models of 3 and of 6 topics of the accessible matrix, their metrics, and the one that they choose."""
    cells = c.entries(spark, sf_dir).where("value >= 5").select("obs_id", "var_id")
    quality = topic_metrics.model_metrics(cells, [3, 6])
    best = topic_metrics.select_topics(quality)
    return spark.createDataFrame([(k, *(float(q[m]) for m in sorted(q)), k == best) for k, q in quality.items()], "n_topics int, coherence double, density double, divergence double, perplexity double, chosen boolean")


_HIST = f"t AS ({_TW}), r AS (SELECT topic, min(weight) AS low, max(weight) AS high FROM t GROUP BY 1 HAVING max(weight) > min(weight)), h AS (SELECT topic, low, (high - low) / 100 AS width, CAST(least(floor((weight - low) / (high - low) * 100), 99) AS DOUBLE) + 0.5 AS x, CAST(count(*) AS DOUBLE) AS n FROM t JOIN r USING (topic) GROUP BY ALL)"


@query(f"""WITH RECURSIVE {_HIST}, it AS (SELECT topic, 0 AS k, sum(n * x) / sum(n) AS t FROM h GROUP BY topic UNION ALL
SELECT topic, k + 1, coalesce((p / nullif(m, 0) - q / nullif(o, 0)) / nullif(ln(p / nullif(m, 0)) - ln(q / nullif(o, 0)), 0), t) FROM (
 SELECT it.topic, it.k, it.t, sum(CASE WHEN x <= t THEN n ELSE 0 END) AS m, sum(CASE WHEN x <= t THEN n * x ELSE 0 END) AS p, sum(CASE WHEN x > t THEN n ELSE 0 END) AS o, sum(CASE WHEN x > t THEN n * x ELSE 0 END) AS q FROM it JOIN h USING (topic) WHERE k < 60 GROUP BY it.topic, it.k, it.t))
SELECT DISTINCT topic, CAST(floor(t) AS BIGINT) AS bin, round(low + t * width, 6) AS threshold FROM it JOIN h USING (topic) WHERE k = 60""")
def topic_li(spark, sf_dir):
    return topic_metrics.li(_topic_weights(spark, sf_dir)).withColumn("threshold", F.round("threshold", 6))


_PDF = lambda x, m, v: f"(exp(-({x} - {m}) * ({x} - {m}) / (2 * {v})) / sqrt(2 * pi() * {v}))"
_LOW, _HIGH = f"((1 - w) * {_PDF('x', 'm1', 'v1')})", f"(w * {_PDF('x', 'm2', 'v2')})"
_FIT = "n2 / a.n AS w, coalesce((sx - x2) / nullif(a.n - n2, 0), mean) AS m1, greatest(coalesce((sq - q2) / nullif(a.n - n2, 0) - pow((sx - x2) / nullif(a.n - n2, 0), 2), var), 1 / 12.0::DOUBLE) AS v1, coalesce(x2 / nullif(n2, 0), mean) AS m2, greatest(coalesce(q2 / nullif(n2, 0) - pow(x2 / nullif(n2, 0), 2), var), 1 / 12.0::DOUBLE) AS v2"


@query(f"""WITH RECURSIVE {_HIST}, a AS (SELECT topic, low, width, sum(n) AS n, sum(n * x) AS sx, sum(n * x * x) AS sq, sum(n * x) / sum(n) AS mean, greatest(sum(n * x * x) / sum(n) - pow(sum(n * x) / sum(n), 2), 1 / 12.0::DOUBLE) AS var FROM h GROUP BY topic, low, width),
it AS (SELECT topic, 0 AS k, {_FIT} FROM (SELECT topic, sum(n) FILTER (WHERE x > mean) AS n2, sum(n * x) FILTER (WHERE x > mean) AS x2, sum(n * x * x) FILTER (WHERE x > mean) AS q2 FROM h JOIN (SELECT topic, mean FROM a) USING (topic) GROUP BY topic) JOIN a USING (topic) UNION ALL
SELECT topic, k + 1, {_FIT} FROM (SELECT topic, k, sum(n * r) AS n2, sum(n * r * x) AS x2, sum(n * r * x * x) AS q2 FROM (
 SELECT it.topic, it.k, x, n, coalesce({_HIGH} / nullif({_LOW} + {_HIGH}, 0), 0.5) AS r FROM it JOIN h USING (topic) WHERE k < 40) GROUP BY topic, k) JOIN a USING (topic)),
f AS (SELECT * FROM it WHERE k = 40), s AS (SELECT h.topic, any_value(a.n) AS n, sum(h.n * ln(greatest({_PDF('x', 'mean', 'var')}, 1e-300))) AS one, sum(h.n * ln(greatest({_LOW} + {_HIGH}, 1e-300))) AS two FROM h JOIN a USING (topic) JOIN f USING (topic) GROUP BY h.topic),
v AS (SELECT topic, arg_min(x, (round({_LOW} + {_HIGH}, 12), x)) AS valley FROM f, (SELECT unnest(range(100)) + 0.5::DOUBLE AS x) WHERE x > least(m1, m2) AND x < greatest(m1, m2) GROUP BY topic),
u AS (SELECT topic, low, width, -2 * two + 5 * ln(s.n) < -2 * one + 2 * ln(s.n) AS two, CASE WHEN -2 * two + 5 * ln(s.n) < -2 * one + 2 * ln(s.n) THEN coalesce(valley, (m1 + m2) / 2) ELSE mean + 2 * sqrt(var) END AS t FROM a JOIN f USING (topic) JOIN s USING (topic) LEFT JOIN v USING (topic))
SELECT topic, two, CAST(floor(t) AS BIGINT) AS bin, round(low + t * width, 5) AS threshold FROM u""")
def topic_mixture(spark, sf_dir):
    return topic_metrics.mixture(_topic_weights(spark, sf_dir)).withColumn("threshold", F.round("threshold", 5))


_FACTORS = "e AS (SELECT user_id AS obs_id, event_type AS topic, CAST(sum(floor(abs(value)) + 1) AS DOUBLE) AS weight FROM events GROUP BY ALL), f AS (SELECT hour(ts) * 31 + day(ts) AS var_id, event_type AS topic, CAST(count(*) AS DOUBLE) AS weight FROM events GROUP BY ALL)"


@query(f"WITH {_FACTORS}, p AS (SELECT obs_id, var_id, sum(e.weight * f.weight) AS value FROM e JOIN f USING (topic) GROUP BY ALL) SELECT obs_id, var_id, value FROM (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY value DESC, var_id) AS k FROM p WHERE value > 0) WHERE k <= 12")
def reduced_product(spark, sf_dir):
    """The twelve largest entries of each user's row of users x event types by event types x hours."""
    e = c.table(spark, sf_dir, "events")
    cells = e.groupBy(F.col("user_id").alias("obs_id"), F.col("event_type").alias("topic")).agg(F.sum(F.floor(F.abs("value")) + 1).cast("double").alias("weight"))
    slots = e.groupBy((F.hour("ts") * 31 + F.dayofmonth("ts")).cast("bigint").alias("var_id"), F.col("event_type").alias("topic")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return products.reduced_product(cells, slots, 12, scale=1.0)


_GENES = "SELECT p_partkey AS gene, 'chr' || (p_size % 24 + 1) AS chrom, p_partkey * 1000 + p_size * 137 % 700 AS s, p_partkey * 1000 + p_size * 137 % 700 + 500 + p_partkey % 50 * 997 AS e, p_partkey % 2 = 0 AS plus FROM part"


@query(f"""WITH p AS ({c.PEAKS_SQL}), g AS ({_GENES}),
b AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e, gene ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end, lead(s) OVER (PARTITION BY chrom ORDER BY s, e, gene) AS next_start FROM g),
r AS (SELECT *, CASE WHEN prev_end IS NULL THEN 99999999 ELSE greatest(s - prev_end, 0) END AS room_l, CASE WHEN prev_end > e THEN 0 WHEN next_start IS NULL THEN 99999999 ELSE greatest(next_start - e, 0) END AS room_r, CASE WHEN plus THEN 20000 ELSE 10000 END AS most_l, CASE WHEN plus THEN 10000 ELSE 20000 END AS most_r FROM b),
x AS (SELECT *, s - greatest(1000, least(most_l, room_l)) AS lo, e + greatest(1000, least(most_r, room_r)) AS hi FROM r),
j AS (SELECT gene, x.chrom, p.s AS start, p.e AS "end", (p.s + p.e) // 2 AS mid, x.s AS bs, x.e AS be, plus FROM x JOIN p ON p.chrom = x.chrom AND p.s < hi AND lo < p.e)
SELECT gene, chrom, start, "end", CAST((CASE WHEN mid < bs THEN mid - bs WHEN mid > be THEN mid - be ELSE 0 END) * (CASE WHEN plus THEN 1 ELSE -1 END) AS BIGINT) AS distance,
 CASE WHEN plus THEN start < bs + 10 AND bs - 10 < "end" ELSE start < be + 10 AND be - 10 < "end" END AS promoter FROM j""")
def search_space_signed(spark, sf_dir):
    """Peaks of each gene's space, up to the neighbouring genes, 20 kb upstream and 10 kb downstream at most, 1 kb at least."""
    p, k, size = c.table(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_size")
    start = k * 1000 + size * 137 % 700
    genes = p.select(k.alias("gene"), F.concat(F.lit("chr"), (size % 24 + 1).cast("string")).alias("chrom"), start.alias("start"), (start + 500 + k % 50 * 997).alias("end"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"))
    return search_space.search_space(c.peaks(spark, sf_dir), genes, (1000, 20_000), (1000, 10_000), boundaries=True)
