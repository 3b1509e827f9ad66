"""Sidecar labels: guarded merges, positional agreement, modal mapping, vocabularies, profiles, gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spellings of a missing label.
MISSING = ("nan", "NaN", "NA", "None", "none", "null", "", "unassigned", "Unassigned", "unknown", "Unknown", "NULL", "<NA>")


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    lack = [n for n in names if n not in df.columns]
    if lack:
        raise ValueError(f"columns {lack} are missing; present: {df.columns}")
    return df


def is_missing(label: Column) -> Column:
    return label.isNull() | F.btrim(label).isin(*MISSING)


def merge_left(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Adds the side's columns, never overwriting one that is there."""
    return df.join(side.select(key, *(c for c in side.columns if c not in df.columns)), key, "left")


def merge_strict(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Like merge_left, but an id of df that the side lacks, or has twice, fails the query."""
    once = side.groupBy(key).agg(*(F.first(c).alias(c) for c in side.columns if c != key and c not in df.columns), F.count(F.lit(1)).alias("_n"))
    j = df.join(once, key, "left")
    return j.where(F.when(F.col("_n") == 1, True).otherwise(F.raise_error(F.concat(F.lit("no single label for id "), F.col(key).cast("string"))).cast("boolean"))).drop("_n")


def agree(a: Column, b: Column) -> Column:
    """Equal as strings, or as numbers within 1e-4 relative or absolute."""
    x, y = a.try_cast("double"), b.try_cast("double")
    return F.coalesce(a == b, F.lit(False)) | F.coalesce(F.abs(x - y) <= 1e-4 * F.greatest(F.lit(1.0), F.abs(x), F.abs(y)), F.lit(False))


def positional_agreement(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(column, n_rows, n_mismatch) of rows paired by `key`, their place; all columns in one pass of one join."""
    j = left.join(right.select(key, *(F.col(c).alias(f"_r_{c}") for c in columns)), key)
    wrong = [F.count_if(~agree(F.col(c).cast("string"), F.col(f"_r_{c}").cast("string"))).alias(f"_w_{c}") for c in columns]
    one = j.agg(F.count(F.lit(1)).alias("_n"), *wrong)
    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col("_n").alias("n_rows"), F.col(f"_w_{c}").alias("n_mismatch")) for c in columns))))


def modal_map(df: DataFrame, fine: str, broad: str) -> DataFrame:
    """(fine, broad, purity): the most frequent broad label of each fine one; ties by name."""
    c = df.where(~is_missing(F.col(broad).cast("string"))).groupBy(fine, broad).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(fine)
    c = c.withColumns({"k": F.row_number().over(w.orderBy(F.desc("n"), broad)), "all": F.sum("n").over(w)})
    return c.where("k = 1").select(fine, broad, (F.col("n") / F.col("all")).alias("purity"))


def jaccard(vocab: DataFrame) -> DataFrame:
    """vocab: (source, level). (a, b, shared, either, jaccard, only_a, only_b) of all pairs of sources; sources are few.

    Sources meet on their common levels, so only counts are joined with the pairs.
    """
    v = vocab.select("source", "level").distinct()
    size = v.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    both = v.withColumnRenamed("source", "a").join(v.withColumnRenamed("source", "b"), "level").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("s"))
    pairs = size.toDF("a", "na").join(F.broadcast(size.toDF("b", "nb")), F.col("a") < F.col("b"))
    j = pairs.join(both, ["a", "b"], "left").withColumn("s", F.coalesce("s", F.lit(0)))
    either = F.col("na") + F.col("nb") - F.col("s")
    return j.select("a", "b", F.col("s").cast("bigint").alias("shared"), either.cast("bigint").alias("either"), (F.col("s") / F.greatest(either, F.lit(1))).alias("jaccard"), (F.col("na") - F.col("s")).cast("bigint").alias("only_a"), (F.col("nb") - F.col("s")).cast("bigint").alias("only_b"))


def level_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(key, level, n) of several columns in one pass; missing labels are left out."""
    pairs = F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("level")) for c in columns))
    return df.select(F.inline(pairs)).where(~is_missing(F.col("level"))).groupBy("key", "level").agg(F.count(F.lit(1)).alias("n"))


def shared_keys(left: DataFrame, right: DataFrame, few: int = 50) -> DataFrame:
    """Grouping keys of two sources ranked by the share, then the number, of their common levels.

    left, right: (key, level, n). Keys that only one source has are left out. Lists are sorted: levels of one side only
    (12 at most) and common levels of fewer than `few` rows on a side (20 at most).
    """
    j = left.withColumnRenamed("n", "l").join(right.withColumnRenamed("n", "r"), ["key", "level"], "full")
    least = F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), F.least("l", "r"))
    levels = lambda when: F.array_join(F.slice(F.array_sort(F.collect_set(F.when(when, F.col("level")))), 1, 12), ",")
    g = j.groupBy("key").agg(
        F.count("l").alias("n_left"),
        F.count("r").alias("n_right"),
        F.count(least).alias("n_shared"),
        F.round(F.count(least) / F.count(F.lit(1)), 3).alias("frac_shared"),
        F.coalesce(F.min(least), F.lit(0)).alias("min_rows"),
        levels(F.col("r").isNull()).alias("only_left"),
        levels(F.col("l").isNull()).alias("only_right"),
        F.array_join(F.slice(F.array_sort(F.collect_set(F.when(least < few, F.col("level")))), 1, 20), ",").alias("few_rows"),
    )
    order = Window.orderBy(F.desc("frac_shared"), F.desc("n_shared"), "key")  # one row a key
    return g.where("n_left > 0 and n_right > 0").withColumn("rank", F.row_number().over(order))


def column_profile(df: DataFrame, columns: list[str], most: int = 60) -> DataFrame:
    """(column, n_unique, n_missing, candidate): a grouping key has 2 to `most` levels and none missing. One pass."""
    aggs = [a for c in columns for a in (F.countDistinct(c).alias(f"u_{c}"), F.count_if(is_missing(F.col(c).cast("string"))).alias(f"m_{c}"))]
    one = df.agg(*aggs)
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"u_{c}").alias("n_unique"), F.col(f"m_{c}").alias("n_missing")) for c in columns))
    return one.select(F.inline(rows)).withColumn("candidate", F.col("n_unique").between(2, most) & (F.col("n_missing") == 0))


def violations(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """(check, n) for named frames of violating rows."""
    return reduce(DataFrame.unionByName, (df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("n")) for name, df in checks))
