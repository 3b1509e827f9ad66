"""Genomic intervals: parsing, reciprocal overlap, anti join, distance joins. 0-based, half-open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REGION = r"^\s*([^:\s]+):([0-9]+)-([0-9]+)\s*$"
TOLERANT = r"^\s*([^:\s-]+)[:-]([0-9]+)-([0-9]+)\s*$"
BIN = 2048  # the narrowest bin; wider intervals have bins of twice the width, and so on


def parse(region: Column, pattern: str = REGION) -> Column:
    """Struct (chrom, start, end), or null for a malformed id or an end that is not beyond the start."""
    part = lambda i: F.regexp_extract(region, pattern, i)
    start, end = part(2).try_cast("bigint"), part(3).try_cast("bigint")
    return F.when(end > start, F.struct(part(1).alias("chrom"), start.alias("start"), end.alias("end")))


def strict(region: Column) -> Column:
    """Like parse, but a bad id fails the query."""
    return F.coalesce(parse(region), F.raise_error(F.concat(F.lit("bad region id: "), region)).cast("struct<chrom:string,start:bigint,end:bigint>"))


def _level(size: int) -> Column:
    """The least level whose bins, of size * 2^level, are as wide as the interval: it falls into two of them at most."""
    return F.greatest(F.lit(0), F.ceil(F.log2((F.col("end") - F.col("start")) / F.lit(float(size))))).cast("int")


def _binned(df: DataFrame, size: int, other: DataFrame) -> DataFrame:
    """df with `_own`, its width's level, exploded to (_level, _bin): bins of that level and of wider ones that `other` has.

    There are at most 64 levels, so what is broadcast is one row of a few numbers.
    """
    levels = other.agg(F.collect_set(_level(size)).alias("_levels"))
    of = df.withColumn("_own", _level(size)).join(F.broadcast(levels))
    of = of.withColumn("_level", F.explode(F.array_union(F.array("_own"), F.filter("_levels", lambda x: x > F.col("_own"))))).drop("_levels")
    width = F.lit(size).cast("bigint") * F.pow(F.lit(2.0), F.col("_level")).cast("bigint")
    return of.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))


def _meet(left: DataFrame, right: DataFrame, size: int, how: str) -> DataFrame:
    """left joined with (r_start, r_end) where they overlap: an equi-join on (chrom, level, bin) at the wider one's level.

    A pair that shares both bins meets in the first of them only. Hot chromosomes are spread over bins, and an interval
    is a few rows however wide it is.
    """
    l, r = left.select("chrom", "start", "end"), right.select("chrom", "start", "end")
    wide = _binned(r, size, l).withColumnsRenamed({"start": "r_start", "end": "r_end", "_own": "_r_own", "chrom": "_c", "_level": "_l", "_bin": "_b"})
    near = _binned(l, size, r)
    width = F.lit(size).cast("bigint") * F.pow(F.lit(2.0), F.col("_level")).cast("bigint")
    first = F.col("_bin") == F.floor(F.greatest("start", "r_start") / width)
    meet = (F.col("chrom") == F.col("_c")) & (F.col("_level") == F.col("_l")) & (F.col("_bin") == F.col("_b"))
    meet = meet & (F.col("_level") == F.greatest("_own", "_r_own")) & (F.least("end", "r_end") > F.greatest("start", "r_start")) & first
    return near.join(wide, meet, how)


def overlaps(left: DataFrame, right: DataFrame, size: int = BIN) -> DataFrame:
    """Pairs of overlapping intervals: (chrom, start, end, r_start, r_end, ov)."""
    ov = F.least("end", "r_end") - F.greatest("start", "r_start")
    return _meet(left, right, size, "inner").select("chrom", "start", "end", "r_start", "r_end", ov.alias("ov"))


def audit(peaks: DataFrame, regions: DataFrame, threshold: float = 0.4) -> DataFrame:
    """One row per distinct peak: best overlap and fractions (independent maxima), counts, best region (first in start
    order), whether its contig is in the catalog, and whether some region passes the reciprocal rule (strictly).

    The peak goes along through a left join of bins and is put together once.
    """
    ov = F.least("end", "r_end") - F.greatest("start", "r_start")
    of_peak, of_region = ov / (F.col("end") - F.col("start")), ov / (F.col("r_end") - F.col("r_start"))
    found = F.col("r_start").isNotNull()
    best = _meet(peaks.select("chrom", "start", "end").distinct(), regions, BIN, "left").groupBy("chrom", "start", "end").agg(
        F.coalesce(F.max(F.when(found, ov)), F.lit(0)).cast("bigint").alias("best_ov"),
        F.coalesce(F.max(F.when(found, of_peak)), F.lit(0)).cast("double").alias("best_frac_peak"),
        F.coalesce(F.max(F.when(found, of_region)), F.lit(0)).cast("double").alias("best_frac_region"),
        F.count_if(found).alias("n_overlapping"),
        F.count_if(found & ((of_peak > threshold) | (of_region > threshold))).alias("n_passing"),
        F.min(F.when(found, F.struct((-ov).alias("o"), F.col("r_start").alias("s"), F.col("r_end").alias("e")))).alias("_best"),
    )
    contigs = regions.select("chrom").distinct().withColumn("_in", F.lit(True))
    out = best.join(contigs, "chrom", "left")
    return out.select(
        "chrom", "start", "end", "best_ov", "best_frac_peak", "best_frac_region", "n_overlapping", "n_passing",
        F.when(F.col("_best").isNotNull(), F.format_string("%s:%d-%d", "chrom", "_best.s", "_best.e")).alias("best_region"),
        F.coalesce("_in", F.lit(False)).alias("chrom_in_db"),
        (F.col("n_passing") > 0).alias("representable"),
    )


def outside(left: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Intervals of left that meet no interval of the blacklist (anti range join). A hit is a matter of existence: the
    semi join of bins stops at the first, so no pairs are made."""
    hit = _meet(left, blacklist, BIN, "left_semi").select("chrom", "start", "end").distinct()
    return left.join(hit, ["chrom", "start", "end"], "left_anti")


def within(points: DataFrame, sites: DataFrame, window: int) -> DataFrame:
    """Pairs of the same chrom with |mid - tss| <= window; mid = (start + end) / 2. sites: (site_id, chrom, tss)."""
    size = 2 * window
    p = points.withColumn("_mid", (F.col("start") + F.col("end")) / 2).withColumn("_bin", F.floor(F.col("_mid") / size))
    s = sites.withColumn("_bin", F.explode(F.array_distinct(F.transform(F.array(F.lit(-window), F.lit(0), F.lit(window)), lambda d: F.floor((F.col("tss") + d) / size)))))
    return p.join(s, ["chrom", "_bin"]).where(F.abs(F.col("_mid") - F.col("tss")) <= window).drop("_bin", "_mid")
