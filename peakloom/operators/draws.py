"""Random choices as orders of md5 hashes: repeatable, and the same in any engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_of(seed: int, *columns: str) -> Column:
    return F.md5(F.concat_ws("_", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns)))


def sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement (a sampling operator), ties by key. Spark keeps n rows a task, then merges."""
    return df.orderBy(order_of(seed, key), key).limit(n)


def label_random(cells: DataFrame, metacells: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """(grp, metacell, modality, obs_id): the baseline that pairs by label alone, k distinct cells a metacell and modality.

    cells: (grp, modality, obs_id); metacells: (grp, metacell). Cells of a pool stand in hash order on a ring; a metacell
    takes k neighbours from a place of its own hash, by an equi-join on places: a pool never meets all metacells.
    Pools smaller than k give all their cells.
    """
    pool = Window.partitionBy("grp", "modality")
    ring = cells.withColumns({"place": F.row_number().over(pool.orderBy(order_of(seed, "obs_id"), "obs_id")) - 1}).select("grp", "modality", "obs_id", F.col("place").cast("bigint").alias("place"))
    size = ring.groupBy("grp", "modality").agg(F.count(F.lit(1)).alias("n"))
    first = F.pmod(F.conv(F.substring(order_of(seed, "grp", "metacell", "modality"), 1, 8), 16, 10).cast("bigint"), F.col("n"))
    wanted = metacells.join(size, "grp").select("grp", "metacell", "modality", F.explode(F.transform(F.sequence(F.lit(0), F.least(F.lit(k), F.col("n")) - 1), lambda i: (first + i) % F.col("n"))).alias("place"))
    return wanted.join(ring, ["grp", "modality", "place"]).select("grp", "metacell", "modality", "obs_id")
