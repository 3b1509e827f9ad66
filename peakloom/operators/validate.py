"""Checks of a paired object before a run: what breaks them, how often, and examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# What stands for a name that is none.
PLACEHOLDERS = ("", "nan", "none", "null", "na")
REGION = r"^([^:]*):(-?[0-9]+)-(-?[0-9]+)$"


def violations(checks: list[tuple[str, DataFrame]], examples: int = 3) -> DataFrame:
    """(check, n, examples) of named frames (item) of violating rows: how many, and the least few of them, joined by ' | '.

    A check that nothing violates has a row too.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        some = df.select(F.coalesce(F.col("item").cast("string"), F.lit("null")).alias("item"))
        few = some.distinct().orderBy("item").limit(examples).agg(F.array_join(F.array_sort(F.collect_list("item")), " | ").alias("examples"))
        return some.agg(F.count(F.lit(1)).alias("n")).join(few).select(F.lit(name).alias("check"), "n", "examples")  # one row each

    return reduce(DataFrame.unionByName, (one(name, df) for name, df in checks))


def paired_checks(obs_a: DataFrame, obs_b: DataFrame, genes: DataFrame, regions: DataFrame, entries: DataFrame, examples: int = 3) -> DataFrame:
    """(check, n, examples) over a paired object: obs_a, obs_b (place, obs_id), genes, regions (name), entries (obs_id, value).

    Observations must be the same, in the same order, and unique; names unique, not empty, placeholders or padded;
    regions chrom:start-end on chr* with 0 <= start < end; values finite, and no observation without any finite one.
    """
    p = lambda i: F.regexp_extract("name", REGION, i)
    parsed = regions.where(F.col("name").rlike(REGION)).select("name", p(1).alias("chrom"), p(2).cast("bigint").alias("start"), p(3).cast("bigint").alias("end"))
    repeated = lambda df, c: df.groupBy(F.col(c).alias("item")).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("item")
    named = lambda df, test: df.where(test).select(F.col("name").alias("item"))
    text = F.coalesce(F.col("name"), F.lit(""))
    places = obs_a.select("place", F.col("obs_id").alias("a")).join(obs_b.select("place", F.col("obs_id").alias("b")), "place", "full")
    bad = F.isnan("value") | F.col("value").isin(float("inf"), float("-inf"))
    finite = entries.groupBy("obs_id").agg(F.count_if(~bad).alias("k"), F.count(F.lit(1)).alias("all"))
    return violations([
        ("obs_only_first", obs_a.join(obs_b, "obs_id", "left_anti").select(F.col("obs_id").alias("item"))),
        ("obs_only_second", obs_b.join(obs_a, "obs_id", "left_anti").select(F.col("obs_id").alias("item"))),
        ("obs_order", places.where(~F.col("a").eqNullSafe(F.col("b"))).select(F.col("place").alias("item"))),
        ("obs_repeated", repeated(obs_a, "obs_id")),
        ("gene_repeated", repeated(genes, "name")),
        ("gene_placeholder", named(genes, F.lower(F.btrim(text)).isin(*PLACEHOLDERS))),
        ("gene_padded", named(genes, text != F.btrim(text))),
        ("region_repeated", repeated(regions, "name")),
        ("region_no_colon", named(regions, ~F.contains(text, F.lit(":")))),
        ("region_unparsed", named(regions, F.contains(text, F.lit(":")) & ~text.rlike(REGION))),
        ("region_negative", named(parsed, (F.col("start") < 0) | (F.col("end") < 0))),
        ("region_inverted", named(parsed, F.col("end") <= F.col("start"))),
        ("region_no_chr", named(parsed, ~F.col("chrom").startswith("chr"))),
        ("value_not_finite", entries.where(bad).select(F.col("obs_id").alias("item"))),
        ("obs_without_value", finite.where("k = 0").select(F.col("obs_id").alias("item"))),
    ], examples)
