"""Queries over fitted importances, generated matrices, assembled layers and the shapes of tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import guards, importance, regulons, synthetic
from .plans import canonical as c
from .registered import query


@query()
def feature_importance(spark, sf_dir):
    """Importance of every other event's variables for the variables of purchases (fitted, so without SQL)."""
    e = c.entries(spark, sf_dir)
    names = e.select("var_id").distinct()
    mine = F.startswith("var_id", F.lit("purchase"))
    pairs = names.where(mine).select(F.col("var_id").alias("target")).join(names.where(~mine).select(F.col("var_id").alias("feature")))  # every feature is a candidate of every target
    return importance.importances(pairs, e.where(mine).withColumnRenamed("var_id", "target"), e.where(~mine).withColumnRenamed("var_id", "feature"), c.obs(spark, sf_dir), blocks=8, trees=60, rate=0.1)


@query()
def synthetic_agreement(spark, sf_dir):
    """Correlation of a gene with a region of its program, in linked and in unlinked matrices as many as there are nations."""
    n = c.table(spark, sf_dir, "nation").count()
    out = None
    for linked in (True, False):
        s = synthetic.paired(spark, 40 * n, 5, 8, 2, 0.5, linked=linked)
        one = s.where("modality = 0").join(s.where("modality = 1").select("obs_id", "program", F.col("value").alias("other")), ["obs_id", "program"])
        one = one.groupBy("program").agg(F.corr("value", "other").alias("r")).select(F.lit(linked).alias("linked"), "program", F.round("r", 6).alias("r"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH e AS ({c.ENTRIES_SQL}), t AS (SELECT 'counts' AS layer, obs_id, var_id AS feature, value FROM e UNION ALL SELECT 'totals', obs_id, 'g' || obs_id % 5, sum(value) FROM e GROUP BY obs_id) SELECT layer, feature, count(*) AS n, sum(value) AS total FROM t GROUP BY ALL")
def assembled_layers(spark, sf_dir):
    e = c.entries(spark, sf_dir).withColumnRenamed("var_id", "feature")
    totals = e.groupBy("obs_id").agg(F.sum("value").alias("value")).withColumn("feature", F.concat(F.lit("g"), (F.col("obs_id") % 5).cast("string")))
    return regulons.layers({"counts": e, "totals": totals}).groupBy("layer", "feature").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(f"WITH e AS ({c.ENTRIES_SQL}), o AS ({c.OBS_SQL}) SELECT (SELECT count(*) FROM o) AS n_obs, (SELECT count(DISTINCT obs_id) FROM e) AS n_rows, (SELECT count(DISTINCT var_id) FROM e) AS n_vars, (SELECT count(*) FROM e) AS n_stored, (SELECT min(obs_id) FROM o) = (SELECT min(obs_id) FROM e) AS first_equal")
def matrix_peek(spark, sf_dir):
    return guards.peek(c.entries(spark, sf_dir), c.obs(spark, sf_dir))
