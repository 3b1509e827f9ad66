"""Profiles of tables, id spaces and intervals: what a source holds, before it is used."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The spellings of a region id, and names of columns that may hold labels or ids.
FORMATS = {"colon": r"^[^:]+:[0-9]+-[0-9]+$", "dash": r"^[^-]+-[0-9]+-[0-9]+$", "underscore": r"^.+_[0-9]+_[0-9]+$"}
LABEL_NAMES = r"(cell.?type|celltype|lineage|annotation|label|cluster|ident|phenotype|predicted|initial|broad|class)"
ID_NAMES = r"(barcode|cell|^index$|^id$|rowname)"


def region_format(df: DataFrame, by: str, region: str, least: float = 0.9) -> DataFrame:
    """(by, n, format): the first spelling that at least so large a share of the ids has, or 'none'."""
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(region).rlike(p)).alias(f"_{k}") for k, p in FORMATS.items()))
    return g.select(by, "n", F.coalesce(*(F.when(F.col(f"_{k}") >= least * F.col("n"), k) for k in FORMATS), F.lit("none")).alias("format"))


def is_peaks(df: DataFrame, region: str, least: float = 0.9) -> DataFrame:
    """(n, share, kind) of one id column: PEAKS if more than the share look like regions, else GENES."""
    share = F.avg(F.col(region).rlike("|".join(FORMATS.values())).cast("double"))
    return df.agg(F.count(F.lit(1)).alias("n"), share.alias("share"), F.when(share > least, "PEAKS").otherwise("GENES").alias("kind"))


def matrix_kind(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, kind): all whole: raw_counts; else below 30: log1p; else normalized_nonlog. Null and NaN take no part."""
    v = F.when(~F.isnan(value), F.col(value))
    g = df.groupBy(by).agg(F.bool_and(v == F.floor(v)).alias("whole"), F.max(v).alias("top"))
    return g.select(by, F.when(F.col("whole"), "raw_counts").when(F.col("top") < 30, "log1p").when(F.col("top").isNotNull(), "normalized_nonlog").alias("kind"))


def width_profile(df: DataFrame, by: str) -> DataFrame:
    """Interval widths per group: extremes, mean, exact percentiles, distinct widths, and whether there is but one."""
    w = F.col("end") - F.col("start")
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.min(w).alias("least"), F.max(w).alias("most"), F.avg(w).alias("mean"), F.percentile(w, F.array(*map(F.lit, (0.01, 0.5, 0.99)))).alias("q"), F.countDistinct(w).alias("n_widths"))
    return g.select(by, "n", "least", "most", "mean", *(F.col("q")[i].alias(n) for i, n in enumerate(("p01", "p50", "p99"))), "n_widths", (F.col("n_widths") == 1).alias("fixed"))


def latent_profile(df: DataFrame, by: str, z: str) -> DataFrame:
    """(by, n, dims, any_nan, median_norm) of latent vectors."""
    norm = F.sqrt(F.aggregate(z, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.max(F.size(z)).cast("bigint").alias("dims"), F.coalesce(F.bool_or(F.exists(z, lambda x: F.isnan(x))), F.lit(False)).alias("any_nan"), F.median(norm).alias("median_norm"))


def id_overlap(left: DataFrame, right: DataFrame, by: str, key: str) -> DataFrame:
    """(by, n_left, n_shared, share, verdict): how much of each group's id set the other source has."""
    ids = left.select(by, key).where(F.col(key).isNotNull()).distinct().join(right.select(key).distinct().withColumn("_in", F.lit(1)), key, "left")
    share = F.count("_in") / F.count(F.lit(1))
    return ids.groupBy(by).agg(F.count(F.lit(1)).alias("n_left"), F.count("_in").alias("n_shared"), share.alias("share"), F.when(share >= 0.99, "match").when(share == 0, "disjoint").otherwise("partial").alias("verdict"))


def column_roles(df: DataFrame, labels: str = LABEL_NAMES, ids: str = ID_NAMES, probe: int = 50) -> DataFrame:
    """(column, n_unique, role) of columns whose names hint at labels or ids.

    An id column is unique in more than half of its rows and its `probe` least values are not all numbers: a numeric
    unique column is a score. One pass for the counts, one bounded sort per id column for the probe.
    """
    named = [c for c in df.columns if re.search(labels, c, re.I) or re.search(ids, c, re.I)]
    if not named:
        return df.sparkSession.createDataFrame([], "column string, n_unique bigint, role string")
    one = df.agg(F.count(F.lit(1)).alias("_n"), *(F.countDistinct(c).alias(f"u_{i}") for i, c in enumerate(named)))
    for i, c in enumerate(named):
        if re.search(ids, c, re.I):
            few = df.select(F.col(c).cast("string").alias("v")).where("v is not null").distinct().orderBy("v").limit(probe)
            one = one.join(few.agg(F.coalesce(F.bool_and(F.expr("try_cast(v as double)").isNotNull()), F.lit(False)).alias(f"p_{i}")))  # one row

    def role(i: int, c: str) -> Column:
        label = F.lit("label" if re.search(labels, c, re.I) else "none")
        if not re.search(ids, c, re.I):
            return label
        return F.when(F.col(f"u_{i}") <= 0.5 * F.col("_n"), label).when(F.col(f"p_{i}"), "score").otherwise("id")

    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"u_{i}").alias("n_unique"), role(i, c).alias("role")) for i, c in enumerate(named)))))


def one_sided(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): groups of both sources and of one only."""
    j = left.select(key).distinct().withColumn("_l", F.lit(1)).join(right.select(key).distinct().withColumn("_r", F.lit(1)), key, "full")
    return j.select(key, F.when(F.col("_l").isNull(), "right").when(F.col("_r").isNull(), "left").otherwise("both").alias("side"))


def drift(wanted: DataFrame, installed: DataFrame) -> DataFrame:
    """(name, status) of wanted versions that differ or are missing; both frames: (name, version)."""
    j = wanted.join(installed.select("name", F.col("version").alias("_v"), F.lit(1).alias("_in")), "name", "left")
    return j.where(F.col("_in").isNull() | ~F.col("version").eqNullSafe(F.col("_v"))).select("name", F.when(F.col("_in").isNull(), "MISSING").otherwise("DIFFERS").alias("status"))


def interval_faults(df: DataFrame) -> DataFrame:
    """(check, n): rows of repeated intervals beyond the first, ends not beyond starts, names without chr. One pass and a count."""
    g = df.groupBy("chrom", "start", "end").agg(F.count(F.lit(1)).alias("n"))
    s = g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("a"), F.coalesce(F.sum(F.when(F.col("end") <= F.col("start"), F.col("n"))), F.lit(0)).alias("b"), F.coalesce(F.sum(F.when(~F.startswith("chrom", F.lit("chr")), F.col("n"))), F.lit(0)).alias("c"))
    return s.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), F.col(k).alias("n")) for n, k in (("duplicated", "a"), ("inverted", "b"), ("unprefixed", "c"))))))


def sites(annotation: DataFrame) -> DataFrame:
    """(gene, chrom, strand, tss) of protein-coding, named, stranded transcripts: the start on +, the end on -."""
    ok = annotation.where("biotype = 'protein_coding' and gene is not null and gene not in ('', 'none') and strand in ('+', '-')")
    return ok.select("gene", "chrom", "strand", F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end")).alias("tss"))
