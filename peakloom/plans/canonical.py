"""Canonical frames (intervals, sparse matrix, links, latents) derived from the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _intervals(lines: DataFrame, width) -> DataFrame:
    start = F.col("l_partkey") * 1000 + F.col("l_orderkey") % 1000
    chrom = F.concat(F.lit("chr"), (F.col("l_suppkey") % 24 + 1).cast("string"))
    return lines.select(chrom.alias("chrom"), start.alias("start"), (start + width).alias("end")).distinct()


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _intervals(table(spark, sf_dir, "lineitem").where("l_linenumber = 1"), F.lit(501))


def db_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog lacks chr24, so that one contig has no counterpart."""
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber > 1")
    return _intervals(lines, F.lit(150) + F.col("l_orderkey") % 201).where("chrom <> 'chr24'")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("obs_id")).distinct()
    return users.select("obs_id", (F.col("obs_id") % 5).alias("grp"))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COO: an absent (obs, var) is 0. Values are whole numbers, so sums are exact."""
    e = table(spark, sf_dir, "events")
    var = F.concat_ws("_", "event_type", (F.dayofmonth("ts") % 8).cast("string"))
    return e.groupBy(F.col("user_id").alias("obs_id"), var.alias("var_id")).agg(F.sum(F.floor(F.abs("value")) + 1).cast("double").alias("value"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(target, region, importance, rho, distance as a stringified list, chrom, start, end)."""
    l = table(spark, sf_dir, "lineitem")
    g = l.groupBy((F.col("l_suppkey") % 40).alias("t"), F.col("l_partkey").alias("r")).agg(F.sum("l_linenumber").cast("bigint").alias("n"), F.min("l_orderkey").alias("o"))
    rho = ((F.col("n") * 13 + F.col("r")) % 41 - 20) / 40.0
    dist = (F.col("o") * 37 + F.col("r") * 11) % 300000 - 150000
    return g.select(
        F.format_string("gene%02d", "t").alias("target"),
        F.format_string("chr%d:%d-%d", F.col("r") % 22 + 1, F.col("r") * 1000, F.col("r") * 1000 + 501).alias("region"),
        F.col("n").cast("double").alias("importance"),
        F.when(F.col("r") % 17 == 0, F.lit(None)).otherwise(rho).cast("double").alias("rho"),
        F.when(F.col("r") % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("["), dist.cast("string"), F.lit("]"))).alias("distance"),
    )


def latents(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("obs_id"), (F.col("vec_id") % 2).cast("int").alias("modality"), F.col("label").alias("grp"), F.col("embedding").alias("z"))


# The same frames for DuckDB.
PEAKS_SQL = "SELECT DISTINCT 'chr' || (l_suppkey % 24 + 1) AS chrom, l_partkey * 1000 + l_orderkey % 1000 AS s, l_partkey * 1000 + l_orderkey % 1000 + 501 AS e FROM lineitem WHERE l_linenumber = 1"
DB_SQL = "SELECT DISTINCT 'chr' || (l_suppkey % 24 + 1) AS chrom, l_partkey * 1000 + l_orderkey % 1000 AS s, l_partkey * 1000 + l_orderkey % 1000 + 150 + l_orderkey % 201 AS e FROM lineitem WHERE l_linenumber > 1 AND l_suppkey % 24 <> 23"
OBS_SQL = "SELECT DISTINCT user_id AS obs_id, user_id % 5 AS grp FROM events"
ENTRIES_SQL = "SELECT user_id AS obs_id, event_type || '_' || (day(ts) % 8) AS var_id, CAST(sum(floor(abs(value)) + 1) AS DOUBLE) AS value FROM events GROUP BY 1, 2"
LINKS_SQL = """SELECT printf('gene%02d', t) AS target, printf('chr%d:%d-%d', r % 22 + 1, r * 1000, r * 1000 + 501) AS region, CAST(n AS DOUBLE) AS importance,
 CASE WHEN r % 17 = 0 THEN NULL ELSE ((n * 13 + r) % 41 - 20) / 40.0 END AS rho,
 CASE WHEN r % 13 = 0 THEN '' ELSE '[' || ((o * 37 + r * 11) % 300000 - 150000) || ']' END AS distance
 FROM (SELECT l_suppkey % 40 AS t, l_partkey AS r, CAST(sum(l_linenumber) AS BIGINT) AS n, min(l_orderkey) AS o FROM lineitem GROUP BY 1, 2)"""
LATENTS_SQL = "SELECT vec_id AS obs_id, CAST(vec_id % 2 AS INTEGER) AS modality, label AS grp, embedding AS z FROM embeddings"


def norm_sf_sql(z: str) -> str:
    """The upper tail of the normal distribution by the same series and continued fraction as `stats.norm_sf`."""
    x = f"(abs({z}) / sqrt(2.0))"
    series = f"list_reduce(list_concat([1.0::DOUBLE], CAST(range(60, 0, -1) AS DOUBLE[])), lambda a, k: 1 + a * 2 * {x} * {x} / (2 * k + 1))"
    fraction = f"list_reduce(list_concat([{x}], CAST(range(80, 0, -1) AS DOUBLE[])), lambda a, k: {x} + k / 2 / a)"
    upper = f"(CASE WHEN {x} < 2 THEN 1 - 2 / sqrt(pi()) * {x} * exp(-{x} * {x}) * {series} ELSE exp(-{x} * {x}) / ({fraction} * sqrt(pi())) END / 2)"
    return f"CASE WHEN {z} < 0 THEN 1 - {upper} ELSE {upper} END"


def student_p_sql(t: str, df: str) -> str:
    """Two-sided p of Student's t by the same finite sums as `stats.student_p`."""
    a = f"atan(abs({t}) / sqrt({df}))"
    total = f"list_reduce(list_concat([1.0::DOUBLE], CAST(range(CAST(({df} - 2 - {df} % 2) // 2 AS BIGINT), 0, -1) AS DOUBLE[])), lambda s, k: 1 + s * cos({a}) * cos({a}) * CASE WHEN {df} % 2 = 1 THEN 2 * k / (2 * k + 1) ELSE (2 * k - 1) / (2 * k) END)"
    one = f"CASE WHEN {df} = 1 THEN 2 * {a} / pi() WHEN {df} % 2 = 1 THEN 2 / pi() * ({a} + sin({a}) * cos({a}) * {total}) ELSE sin({a}) * {total} END"
    return f"greatest(0.0, 1 - {one})"


DENSE_SQL = f"o AS ({OBS_SQL}), e AS ({ENTRIES_SQL}), v AS (SELECT DISTINCT var_id FROM e), d AS (SELECT o.obs_id, o.grp, v.var_id, coalesce(e.value, 0) AS value FROM o CROSS JOIN v LEFT JOIN e ON e.obs_id = o.obs_id AND e.var_id = v.var_id)"
