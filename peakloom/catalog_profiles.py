"""Queries over profiles of sources, id spaces, sampling and plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import draws, labels, matrix, pairing, profiles
from .plans import canonical as c
from .registered import query

_REGION = "CASE WHEN l_linenumber % 4 = 3 AND l_orderkey % 5 = 0 THEN 'x' || l_partkey ELSE 'chr' || l_suppkey || CASE l_linenumber % 4 WHEN 0 THEN ':' WHEN 1 THEN '-' ELSE '_' END || l_partkey || CASE l_linenumber % 4 WHEN 2 THEN '_' WHEN 3 THEN '_' ELSE '-' END || (l_partkey + 5) END"


@query(f"""WITH t AS (SELECT l_linenumber AS grp, {_REGION} AS r FROM lineitem), g AS (SELECT grp, count(*) AS n, count(*) FILTER (WHERE regexp_full_match(r, '[^:]+:[0-9]+-[0-9]+')) AS a, count(*) FILTER (WHERE regexp_full_match(r, '[^-]+-[0-9]+-[0-9]+')) AS b, count(*) FILTER (WHERE regexp_full_match(r, '.+_[0-9]+_[0-9]+')) AS d FROM t GROUP BY 1)
SELECT grp, n, CASE WHEN a >= 0.9 * n THEN 'colon' WHEN b >= 0.9 * n THEN 'dash' WHEN d >= 0.9 * n THEN 'underscore' ELSE 'none' END AS format FROM g""")
def region_format(spark, sf_dir):
    return profiles.region_format(c.table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("grp"), F.expr(_REGION).alias("r")), "grp", "r")


@query(f"SELECT count(*) AS n, round(avg(CASE WHEN regexp_matches(r, '^[^:]+:[0-9]+-[0-9]+$|^[^-]+-[0-9]+-[0-9]+$|^.+_[0-9]+_[0-9]+$') THEN 1.0 ELSE 0.0 END), 6) AS share, CASE WHEN avg(CASE WHEN regexp_matches(r, '^[^:]+:[0-9]+-[0-9]+$|^[^-]+-[0-9]+-[0-9]+$|^.+_[0-9]+_[0-9]+$') THEN 1.0 ELSE 0.0 END) > 0.9 THEN 'PEAKS' ELSE 'GENES' END AS kind FROM (SELECT {_REGION} AS r FROM lineitem)")
def peak_likeness(spark, sf_dir):
    return profiles.is_peaks(c.table(spark, sf_dir, "lineitem").select(F.expr(_REGION).alias("r")), "r").withColumn("share", F.round("share", 6))


_VALUES = "CASE user_id % 3 WHEN 0 THEN floor(value) WHEN 1 THEN least(abs(value), 29.5) ELSE value * 100 + 31 END"


@query(f"WITH t AS (SELECT user_id % 3 AS grp, CAST({_VALUES} AS DOUBLE) AS v FROM events), g AS (SELECT grp, bool_and(v = floor(v)) AS whole, max(v) AS top FROM t GROUP BY 1) SELECT grp, CASE WHEN whole THEN 'raw_counts' WHEN top < 30 THEN 'log1p' WHEN top IS NOT NULL THEN 'normalized_nonlog' END AS kind FROM g")
def matrix_kind(spark, sf_dir):
    return profiles.matrix_kind(c.table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("grp"), F.expr(f"cast({_VALUES} as double)").alias("v")), "grp", "v")


@query(f"WITH g AS ({c.DB_SQL}), t AS (SELECT chrom, e - s AS w FROM g) SELECT chrom, count(*) AS n, min(w) AS least, max(w) AS most, round(avg(w), 6) AS mean, round(quantile_cont(w, 0.01), 6) AS p01, round(quantile_cont(w, 0.5), 6) AS p50, round(quantile_cont(w, 0.99), 6) AS p99, count(DISTINCT w) AS n_widths, count(DISTINCT w) = 1 AS fixed FROM t GROUP BY chrom")
def width_profile(spark, sf_dir):
    return profiles.width_profile(c.db_regions(spark, sf_dir), "chrom").withColumns({k: F.round(k, 6) for k in ("mean", "p01", "p50", "p99")})


@query("SELECT label AS grp, count(*) AS n, max(len(embedding)) AS dims, bool_or(len(list_filter(embedding, lambda x: isnan(x))) > 0) AS any_nan, round(median(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 6) AS median_norm FROM embeddings GROUP BY 1")
def latent_profile(spark, sf_dir):
    return profiles.latent_profile(c.latents(spark, sf_dir), "grp", "z").withColumn("median_norm", F.round("median_norm", 6))


@query("WITH l AS (SELECT DISTINCT o_orderpriority AS space, CASE WHEN o_orderpriority LIKE '1%' THEN o_custkey ELSE o_custkey + CAST(left(o_orderpriority, 1) AS BIGINT) * (SELECT max(c_custkey) FROM customer) // 5 END AS k FROM orders), j AS (SELECT space, k, c_custkey FROM l LEFT JOIN customer ON c_custkey = k) SELECT space, count(*) AS n_left, count(c_custkey) AS n_shared, round(count(c_custkey) / count(*), 6) AS share, CASE WHEN count(c_custkey) / count(*) >= 0.99 THEN 'match' WHEN count(c_custkey) = 0 THEN 'disjoint' ELSE 'partial' END AS verdict FROM j GROUP BY space")
def id_overlap(spark, sf_dir):
    customers = c.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    o = c.table(spark, sf_dir, "orders").join(F.broadcast(customers.agg(F.max("k").alias("top"))))  # one row
    moved = F.floor(F.left("o_orderpriority", F.lit(1)).cast("bigint") * F.col("top") / 5)
    own = o.select(F.col("o_orderpriority").alias("space"), F.when(F.startswith("o_orderpriority", F.lit("1")), F.col("o_custkey")).otherwise(F.col("o_custkey") + moved).alias("k"))
    return profiles.id_overlap(own, customers, "space", "k").withColumn("share", F.round("share", 6))


@query("SELECT 'status' AS key, o_orderstatus AS level, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2")
def level_counts(spark, sf_dir):
    return labels.level_counts(c.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")), ["status", "priority"])


@query("SELECT unnest(['barcode', 'cell_score', 'cell_type', 'cluster']) AS \"column\", unnest([count(DISTINCT c_name), count(DISTINCT c_custkey), count(DISTINCT c_mktsegment), count(DISTINCT c_nationkey)]) AS n_unique, unnest(['id', 'score', 'label', 'label']) AS role FROM customer")
def column_roles(spark, sf_dir):
    t = c.table(spark, sf_dir, "customer").select(F.col("c_name").alias("barcode"), F.col("c_custkey").alias("cell_score"), F.col("c_mktsegment").alias("cell_type"), F.col("c_nationkey").alias("cluster"), F.col("c_acctbal").alias("money"))
    return profiles.column_roles(t)


@query("WITH l AS (SELECT DISTINCT p_brand AS k FROM part WHERE p_size < 5), r AS (SELECT DISTINCT p_brand AS k FROM part WHERE p_size > 45) SELECT coalesce(l.k, r.k) AS p_brand, CASE WHEN l.k IS NULL THEN 'right' WHEN r.k IS NULL THEN 'left' ELSE 'both' END AS side FROM l FULL JOIN r ON l.k = r.k")
def one_sided_groups(spark, sf_dir):
    p = c.table(spark, sf_dir, "part")
    return profiles.one_sided(p.where("p_size < 5"), p.where("p_size > 45"), "p_brand")


@query("SELECT n_name AS name, CASE WHEN n_nationkey % 5 = 0 THEN 'MISSING' ELSE 'DIFFERS' END AS status FROM nation WHERE n_nationkey % 5 = 0 OR n_nationkey % 3 = 0")
def version_drift(spark, sf_dir):
    n = c.table(spark, sf_dir, "nation").withColumn("name", F.col("n_name"))
    have = n.where("n_nationkey % 5 <> 0").select("name", (F.col("n_regionkey") + F.when(F.col("n_nationkey") % 3 == 0, 1).otherwise(0)).alias("version"))
    return profiles.drift(n.select("name", F.col("n_regionkey").alias("version")), have)


_FAULTY = "SELECT CASE WHEN l_orderkey % 50 = 0 THEN '' ELSE 'chr' END || (l_suppkey % 24 + 1) AS chrom, l_partkey * 10 AS s, l_partkey * 10 + l_linenumber * 100 - 150 AS e FROM lineitem"


@query(f"WITH t AS ({_FAULTY}) SELECT 'duplicated' AS \"check\", count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS n FROM t UNION ALL SELECT 'inverted', count(*) FROM t WHERE e <= s UNION ALL SELECT 'unprefixed', count(*) FROM t WHERE chrom NOT LIKE 'chr%'")
def interval_faults(spark, sf_dir):
    l = c.table(spark, sf_dir, "lineitem")
    chrom = F.concat(F.when(F.col("l_orderkey") % 50 == 0, "").otherwise("chr"), (F.col("l_suppkey") % 24 + 1).cast("string"))
    return profiles.interval_faults(l.select(chrom.alias("chrom"), (F.col("l_partkey") * 10).alias("start"), (F.col("l_partkey") * 10 + F.col("l_linenumber") * 100 - 150).alias("end")))


_ANNOTATION = "SELECT CASE WHEN p_partkey % 11 = 0 THEN 'none' ELSE p_brand END AS gene, CASE WHEN p_partkey % 4 = 0 THEN 'lncRNA' ELSE 'protein_coding' END AS biotype, 'chr' || (p_partkey % 22 + 1) AS chrom, CASE p_partkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE CASE WHEN p_partkey % 7 = 0 THEN '.' ELSE '+' END END AS strand, p_partkey * 100 AS s, p_partkey * 100 + p_size AS e FROM part"


@query(f"WITH a AS ({_ANNOTATION}) SELECT gene, chrom, strand, CASE WHEN strand = '+' THEN s ELSE e END AS tss FROM a WHERE biotype = 'protein_coding' AND gene <> 'none' AND strand <> '.'")
def annotation_sites(spark, sf_dir):
    k = F.col("p_partkey")
    strand = F.when(k % 3 == 0, "+").when(k % 3 == 1, "-").when(k % 7 == 0, ".").otherwise("+")
    a = c.table(spark, sf_dir, "part").select(F.when(k % 11 == 0, "none").otherwise(F.col("p_brand")).alias("gene"), F.when(k % 4 == 0, "lncRNA").otherwise("protein_coding").alias("biotype"), F.concat(F.lit("chr"), (k % 22 + 1).cast("string")).alias("chrom"), strand.alias("strand"), (k * 100).alias("start"), (k * 100 + F.col("p_size")).alias("end"))
    return profiles.sites(a)


@query(f"WITH {c.DENSE_SQL}, t AS (SELECT var_id, value, CAST(count(*) AS DOUBLE) AS m FROM d GROUP BY ALL) SELECT var_id, sum(m * m * m - m) AS ties FROM t GROUP BY 1")
def rank_ties(spark, sf_dir):
    return matrix.tie_terms(c.entries(spark, sf_dir), c.obs(spark, sf_dir))


@query(f"WITH {c.DENSE_SQL}, g AS (SELECT grp, count(*) AS n FROM o GROUP BY 1) SELECT grp, var_id, round(avg(value), 6) AS value FROM d JOIN g USING (grp) WHERE n >= 3 GROUP BY ALL HAVING sum(value) > 0")
def group_tracks(spark, sf_dir):
    return matrix.group_tracks(c.entries(spark, sf_dir), c.obs(spark, sf_dir), 3).withColumn("value", F.round("value", 6))


@query("SELECT c_custkey, c_mktsegment FROM customer ORDER BY md5('7_' || c_custkey), c_custkey LIMIT 50")
def hash_sample(spark, sf_dir):
    """A sampling operator: 50 rows without replacement."""
    return draws.sample(c.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey", 50, 7)


_RING = f"""z AS ({c.LATENTS_SQL}), r AS (SELECT grp, modality, obs_id, row_number() OVER (PARTITION BY grp, modality ORDER BY md5('3_' || obs_id), obs_id) - 1 AS place, count(*) OVER (PARTITION BY grp, modality) AS n FROM z), m AS (SELECT DISTINCT grp, unnest(range(0, 4)) AS metacell FROM z)"""


@query(f"WITH {_RING} SELECT m.grp, metacell, modality, obs_id FROM m JOIN r ON m.grp = r.grp AND (place - CAST('0x' || left(md5('3_' || m.grp || '_' || metacell || '_' || modality), 8) AS BIGINT) % n + n) % n < least(5, n)")
def label_random_pairs(spark, sf_dir):
    z = c.latents(spark, sf_dir)
    cells = z.select("grp", "modality", "obs_id")
    metacells = z.select("grp").distinct().select("grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(3).cast("bigint"))).alias("metacell"))
    return draws.label_random(cells, metacells, 5, 3)


@query("WITH g AS (SELECT label AS grp, count(*) FILTER (WHERE vec_id % 2 = 0) * 7 AS n0, count(*) FILTER (WHERE vec_id % 2 = 1) * 9 AS n1 FROM embeddings GROUP BY 1) SELECT grp, n0, n1, CAST(greatest(1, round_even(least(n0, n1) / 25, 0) * 2) AS BIGINT) AS metacells, CAST(greatest(1, round_even(least(n0, n1) / 25, 0) * 2) AS BIGINT) * 1000 * 8 AS bytes, least(n0, n1) < 150 AS dropped FROM g")
def pairing_plan(spark, sf_dir):
    """A dry run: what pairing would make of each group, from counts only."""
    m = lambda k: F.count_if(F.col("modality") == k)
    g = c.latents(spark, sf_dir).groupBy("grp").agg((m(0) * 7).alias("n0"), (m(1) * 9).alias("n1"))
    return pairing.plan(g, n_vars=1000, k=25, least=150)


_GAPS = f"z AS ({c.LATENTS_SQL}), a AS (SELECT * FROM z WHERE obs_id % 100 = 0), p AS (SELECT a.grp, a.obs_id AS anchor, z.obs_id, round(1 - list_dot_product(CAST(a.z AS DOUBLE[]), CAST(z.z AS DOUBLE[])) / sqrt(list_dot_product(CAST(a.z AS DOUBLE[]), CAST(a.z AS DOUBLE[])) * list_dot_product(CAST(z.z AS DOUBLE[]), CAST(z.z AS DOUBLE[]))), 9) AS dist FROM a JOIN z USING (grp)), n AS (SELECT *, row_number() OVER (PARTITION BY grp, anchor ORDER BY dist, obs_id) AS rank FROM p), w AS (SELECT grp, round(quantile_cont(dist, 0.95), 6) AS gap, count(DISTINCT anchor) AS n FROM n WHERE rank <= 5 GROUP BY 1)"


@query(f"WITH {_GAPS} SELECT grp, gap, n AS n_metacells, CAST(sum(n) OVER () AS BIGINT) AS total FROM w ORDER BY gap DESC, grp LIMIT 8")
def worst_groups(spark, sf_dir):
    """The 8 groups of the largest 95th percentile of distances (a top-k report), and the number of all metacells."""
    z = c.latents(spark, sf_dir)
    d = pairing.diagnostics(pairing.nearest(z.where("obs_id % 100 = 0"), z, 5))
    return pairing.worst(d.select("grp", F.col("p95_dist").alias("gap"), "n_metacells"), "gap", 8)
