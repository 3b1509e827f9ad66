"""Matrices with planted structure, to hold operators against: programs shared by two modalities, and their null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _normal(seed: int, *keys) -> Column:
    """A standard normal number of the keys: the same wherever and however often it is computed."""
    u = [(F.pmod(F.xxhash64(F.lit(seed), F.lit(k), *keys), F.lit(1 << 30)) + 0.5) / float(1 << 30) for k in (0, 1)]
    return F.sqrt(-2 * F.log(u[0])) * F.cos(2 * F.pi() * u[1])


def paired(spark: SparkSession, n_obs: int, n_groups: int, n_programs: int, per_program: int, noise: float, seed: int = 11, linked: bool = True) -> DataFrame:
    """(modality, obs_id, grp, program, feature, value): each observation has its group's activity of a program, plus its own.

    Both modalities of an observation show the same activities, each feature with noise of its own; where not `linked`,
    modality 1 takes for each program the activity of the next one, so that features of one program no longer agree.
    """
    obs = spark.range(n_obs).select(F.col("id").alias("obs_id"), (F.col("id") % n_groups).alias("grp"))
    grid = obs.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_programs - 1))).alias("program")).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("modality"))
    source = F.col("program") if linked else F.pmod(F.col("program") + F.col("modality"), F.lit(n_programs))
    grid = grid.withColumn("activity", _normal(seed, F.lit("group"), "grp", source) + 0.5 * _normal(seed, F.lit("own"), "obs_id", source))
    cells = grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(per_program - 1))).alias("k"))
    feature = F.concat_ws("_", F.when(F.col("modality") == 0, "gene").otherwise("region"), F.col("program").cast("string"), F.col("k").cast("string"))
    return cells.select("modality", "obs_id", "grp", "program", feature.alias("feature"), (F.col("activity") + noise * _normal(seed, F.lit("noise"), "modality", "obs_id", "program", "k")).alias("value"))
