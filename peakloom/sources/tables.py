"""Table sources and sinks: region catalogs, link tables, chromosome sizes, feather schemas; audit, interact, peak files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.intervals import parse
from ..operators.labels import require_columns
from ..operators.links import NEGATIVE, POSITIVE, safe_name, top_per
from .text import bed_lines

# Columns of a link table.
LINK_COLUMNS = ("target", "region", "importance", "rho")


def three_spellings(name: Column) -> Column:
    """Struct (chrom, start, end) of chr:start-end, chr-start-end or chr:start:end; null for what is none of them."""
    # One pass of one pattern: its parts are put on lines, which no other text can have but a name that is left as it is.
    lines = F.regexp_replace(name, r"^(?:([^:]+):([0-9]+)[-:]([0-9]+)|(.+)-([0-9]+)-([0-9]+))$", "$1$4\n$2$5\n$3$6")
    ends = F.substring_index(lines, "\n", -2)
    start, end = F.substring_index(ends, "\n", 1), F.substring_index(ends, "\n", -1)
    chrom = F.left(lines, F.length(lines) - F.length(ends) - 1)
    return F.when(lines != name, F.struct(chrom.alias("chrom"), start.try_cast("bigint").alias("start"), end.try_cast("bigint").alias("end")))


def catalog_of_names(names: DataFrame, name: str) -> DataFrame:
    """(chrom, start, end) of variable names in any of three spellings, distinct, by place; other names are left out."""
    p = names.select(three_spellings(F.col(name)).alias("p")).where("p is not null and p.end > p.start")
    return p.select("p.*").distinct().orderBy("chrom", "start", "end")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end) of a region catalog: parquet; csv, tsv or txt with these columns, or one id a line; bed. Empty is fatal."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        df = spark.read.parquet(path)
        low = {c.lower(): c for c in df.columns}
        require_columns(df.toDF(*(c.lower() for c in df.columns)), ["chrom", "start", "end"])
        out = df.select(F.col(low["chrom"]).alias("chrom"), *(F.col(low[k]).cast("bigint").alias(k) for k in ("start", "end")))
    elif kind == "bed":
        out = bed_lines(spark.read.text(path)).where("ok").drop("ok")
    else:
        head = spark.read.text(path).limit(1).first()
        sep = "\t" if head and "\t" in head[0] else ","
        low = [x.strip().lower() for x in (head[0] if head else "").split(sep)]
        if {"chrom", "start", "end"} <= set(low):
            df = spark.read.csv(path, sep=sep, header=True).toDF(*low)
            out = df.select("chrom", *(F.col(k).cast("bigint").alias(k) for k in ("start", "end")))
        else:
            ids = spark.read.text(path).select(parse(F.btrim("value")).alias("p")).where("p is not null")
            out = ids.select("p.*")
    if not out.limit(1).count():
        raise ValueError(f"no regions in {path}")
    return out


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated link table; lacking columns are fatal before any row is read."""
    df = require_columns(spark.read.csv(path, sep="\t", header=True), list(LINK_COLUMNS))
    return df.withColumns({c: F.col(c).try_cast("double") for c in ("importance", "rho")})


def chromsizes(sizes: DataFrame, wanted: list[str]) -> DataFrame:
    """(Chromosome, Start, End) of the wanted chromosomes, Start 0; one that sizes (chrom, length) lack is fatal."""
    have = {r["chrom"] for r in sizes.where(F.col("chrom").isin(wanted)).select("chrom").distinct().collect()}  # as many as are wanted
    if lack := [x for x in wanted if x not in have]:
        raise ValueError(f"chromosomes absent: {lack}")
    return sizes.where(F.col("chrom").isin(wanted)).select(F.col("chrom").alias("Chromosome"), F.lit(0).cast("bigint").alias("Start"), F.col("length").cast("bigint").alias("End"))


def audit_rows(audit: DataFrame) -> DataFrame:
    """The audit as it is written: ids, widths, fractions to six places, NA where nothing overlaps, flags as 0 and 1."""
    six = lambda c: F.format_string("%.6f", F.bround(c, 6))
    flag = lambda c: F.col(c).cast("int").cast("string")
    return audit.select(
        F.format_string("%s:%d-%d", "chrom", "start", "end").alias("peak_id"), "chrom", "start", "end", (F.col("end") - F.col("start")).alias("width"),
        F.col("best_ov").alias("best_overlap_bp"), six("best_frac_peak").alias("best_frac_of_peak"), six("best_frac_region").alias("best_frac_of_db_region"),
        six(F.greatest("best_frac_peak", "best_frac_region")).alias("best_frac_either"), F.col("n_overlapping").alias("n_db_regions_overlapping"), F.col("n_passing").alias("n_db_regions_passing"),
        F.coalesce("best_region", F.lit("NA")).alias("best_db_region"), flag("chrom_in_db").alias("chrom_in_db"), flag("representable").alias("representable"),
    )


def write_audit(audit: DataFrame, prefix: str) -> dict:
    """Per-peak CSV at {prefix}.per_peak.csv and the summary as JSON at {prefix}.summary.json, which is returned."""
    audit_rows(audit).write.mode("overwrite").csv(f"{prefix}.per_peak.csv", header=True)
    one = audit.agg(F.count(F.lit(1)).alias("n_peaks"), F.count_if("representable").alias("n_representable"), F.countDistinct(F.when(F.col("representable"), F.col("best_region"))).alias("n_regions")).first().asDict()
    audit.sparkSession.createDataFrame([(json.dumps(one, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{prefix}.summary.json")
    return one


def interact_rows(links: DataFrame, anchored: DataFrame | None, group: str, z: str, n: int = 50000) -> DataFrame:
    """The 18 columns of the interact format and the group, for the n strongest links of a group.

    links: (target, region, group, z, rho); anchored: (target, region, anchor), None if links have it. The arc spans from the region's middle to
    the anchor; scores are 0 to 1000 of the group's largest z; the colour is that of the sign of rho. Halves of rho's
    decimals are rounded away from zero in the name; an undefined rho is written nan.
    """
    if anchored is not None:
        links = links.join(anchored.select("target", "region", "anchor"), ["target", "region"])
    top = top_per(links, group, [F.desc(z), F.asc("region"), F.asc("target")], n)
    top = top.withColumn("_p", parse(F.col("region"))).where("_p is not null")
    mid = F.floor((F.col("_p.start") + F.col("_p.end")) / 2)
    score = F.least(F.greatest(F.bround(F.col(z) / F.greatest(F.max(z).over(Window.partitionBy(group)), F.lit(1e-9)) * 1000), F.lit(0.0)), F.lit(1000.0)).cast("int")
    dot = F.lit(".")
    return top.select(
        F.col("_p.chrom").alias("chrom"), F.least(mid, "anchor").alias("chromStart"), (F.greatest(mid, F.col("anchor")) + 1).alias("chromEnd"),
        F.concat("target", F.format_string("|z=%.1f", F.col(z)), F.coalesce(F.when(F.col("rho").isNotNull(), F.format_string("|rho=%+.2f", F.col("rho"))), F.lit("|rho=nan"))).alias("name"), score.alias("score"), F.round(z, 3).alias("value"), safe_name(F.col(group).cast("string"), True).alias("exp"),
        F.when(F.col("rho") > 0, POSITIVE).otherwise(NEGATIVE).alias("color"),
        F.col("_p.chrom").alias("sourceChrom"), F.col("_p.start").alias("sourceStart"), F.col("_p.end").alias("sourceEnd"), F.col("region").alias("sourceName"), dot.alias("sourceStrand"),
        F.col("_p.chrom").alias("targetChrom"), F.col("anchor").alias("targetStart"), (F.col("anchor") + 1).alias("targetEnd"), F.col("target").alias("targetName"), dot.alias("targetStrand"),
    )


def peak_rows(interact: DataFrame) -> DataFrame:
    """BED6 rows of the peak ends of interact rows, one a region and group: that of the largest score."""
    g = interact.groupBy("exp", "sourceChrom", "sourceStart", "sourceEnd").agg(F.max("score").alias("score"), F.min("sourceName").alias("name"))
    return g.select("exp", F.col("sourceChrom").alias("chrom"), F.col("sourceStart").alias("start"), F.col("sourceEnd").alias("end"), "name", "score", F.lit(".").alias("strand"))


def write_table(df: DataFrame, folder: str, stem: str) -> str:
    """df as Parquet at {folder}/{stem}.parquet, replacing what was there; the path."""
    path = f"{folder}/{stem}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path
