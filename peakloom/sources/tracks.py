"""Browser and fragment files: a folder of text a group, in coordinate order, replacing what was there.

Groups are folders named by a safe form of theirs, so that a slash or a blank opens no other folder; two groups of one
safe name are refused. Group files are cut by ranges of (group, place), so that a large group is several tasks and its
parts, in name order, one sorted file. Link tracks hold a group's strongest links only and are one file each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.links import safe_name
from . import files

NONE = "none"  # the folder of a null group
BIN = 1 << 14  # base pairs of a bin of the linear index


def folders(df: DataFrame, *groups: str) -> DataFrame:
    """df with each group as the name of its folder; groups of one name are fatal. Groups are few."""
    for g in groups:
        name = F.coalesce(safe_name(F.col(g).cast("string"), True), F.lit(NONE))
        name = F.regexp_replace(name, r"[^0-9A-Za-z_.+-]", "_")
        clash = df.select(F.col(g), name.alias("_f")).distinct().groupBy("_f").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.coalesce(F.col(g).cast("string"), F.lit("null")))).alias("of")).where("n > 1").first()
        if clash:
            raise ValueError(f"groups {clash['of']} would share the folder {clash['_f']}")
        df = df.withColumn(g, name)
    return df


def _tabbed(*columns):
    return F.concat_ws("\t", *(F.col(c).cast("string") for c in columns))


def write_sorted(df: DataFrame, line, path: str, groups: list[str], place: list[str], gzip: bool = False, rows: int = 0) -> None:
    """Lines of each group by place; groups are folder names already. rows: of a file at most (0: any number)."""
    keys = [*groups, *place]
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*groups, line.alias("value"))
    w = out.write.mode("overwrite").option("maxRecordsPerFile", rows).partitionBy(*groups)
    (w.option("compression", "gzip") if gzip else w).text(path)


def write_bedgraph(track: DataFrame, path: str, value: str, group: str = "grp") -> None:
    """bedGraph of each group: values above 0 to five places, by place. track: (group, chrom, start, end, value)."""
    rows = folders(track.where(F.col(value) > 0), group)
    line = F.concat_ws("\t", _tabbed("chrom", "start", "end"), F.format_string("%.5f", F.col(value)))
    write_sorted(rows, line, path, [group], ["chrom", "start", "end"])


def write_link_tracks(interact: DataFrame, path: str, description: str = "") -> dict[str, int]:
    """Of rows of `interact_rows`: interact files with a track line, BEDPE and peak files of each group; links of each.

    A group is one file of each kind, for it holds a set number of links. Files are in order of place.
    """
    columns = [c for c in interact.columns]
    score = Window.partitionBy("exp", "sourceChrom", "sourceStart", "sourceEnd").orderBy(F.desc("score"), "sourceName")
    peaks = interact.withColumn("_k", F.row_number().over(score)).where("_k = 1").withColumn("_dot", F.lit("."))
    head = interact.select("exp").distinct().select("exp", F.lit(0).alias("_o"), F.lit("").alias("_c"), F.lit(0).cast("bigint").alias("_s"), F.concat(F.lit('track type=interact name="'), "exp", F.lit(f' links" description="{description}" interactDirectional=true maxHeightPixels=200:100:50 visibility=full')).alias("value"))
    rows = interact.select("exp", F.lit(1).alias("_o"), F.col("chrom").alias("_c"), F.col("chromStart").cast("bigint").alias("_s"), _tabbed(*columns).alias("value"))
    kinds = {
        "interact": head.unionByName(rows),
        "bedpe": interact.withColumn("_dot", F.lit(".")).select("exp", F.lit(1).alias("_o"), F.col("sourceChrom").alias("_c"), F.col("sourceStart").cast("bigint").alias("_s"), _tabbed("sourceChrom", "sourceStart", "sourceEnd", "targetChrom", "targetStart", "targetEnd", "targetName", "score", "_dot", "_dot").alias("value")),
        "peaks": peaks.select("exp", F.lit(1).alias("_o"), F.col("sourceChrom").alias("_c"), F.col("sourceStart").cast("bigint").alias("_s"), _tabbed("sourceChrom", "sourceStart", "sourceEnd", "sourceName", "score", "_dot").alias("value")),
    }
    for kind, df in kinds.items():
        df.repartition("exp").sortWithinPartitions("exp", "_o", "_c", "_s", "value").select("exp", "value").write.mode("overwrite").partitionBy("exp").text(f"{path}/{kind}")
    return {r["exp"]: r["n"] for r in interact.groupBy("exp").agg(F.count(F.lit(1)).alias("n")).collect()}


def write_region_sets(regions: DataFrame, groups: DataFrame, path: str, group: str = "grp") -> dict:
    """BED3 of each group's regions, by place; the number of lines of each. A group without regions gets an empty file.

    Groups are few: their names and counts come to the driver.
    """
    spark = regions.sparkSession
    named = folders(groups.select(group).distinct().withColumn("_group", F.col(group)), group).withColumnRenamed(group, "_folder")
    rows = regions.join(F.broadcast(named), F.col(group).eqNullSafe(F.col("_group"))).select(F.col("_folder").alias(group), "chrom", "start", "end")
    write_sorted(rows, _tabbed("chrom", "start", "end"), path, [group], ["chrom", "start", "end"])
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed(group, "_folder")
    every = named.join(counts, "_folder", "left").select("_group", "_folder", F.coalesce("_n", F.lit(0)).alias("n")).collect()
    for r in every:
        if not r["n"]:
            files.write_new(spark, f"{path}/{group}={r['_folder']}/part-empty.txt", "")
    return {r["_group"]: r["n"] for r in every}


# --- fragments ---------------------------------------------------------------------------------------------------


def write_fragments(fragments: DataFrame, path: str, rows: int = 1_000_000, keys: tuple[str, str] = ("grp", "sample")) -> None:
    """Fragments (grp, sample, chrom, start, end, barcode, n) of each group and sample as compressed tab-separated files of
    `rows` lines at most, in order of place, with a linear index: which files hold fragments of which bin.

    A file is a block: compressed on its own and opened alone.
    """
    groups = list(keys)
    line = _tabbed("chrom", "start", "end", "barcode", "n")
    write_sorted(folders(fragments, *groups), line, f"{path}/data", groups, ["chrom", "start", "end", "barcode"], True, rows)
    spark = fragments.sparkSession
    f = _fields(spark.read.text(f"{path}/data").withColumn("file", F.input_file_name()))
    bins = F.sequence(F.floor(F.col("start") / BIN), F.floor(F.greatest(F.col("end") - 1, "start") / BIN))
    index = f.select(*groups, "file", "chrom", F.explode(bins).alias("bin")).groupBy(*groups, "file", "chrom", "bin").agg(F.count(F.lit(1)).alias("n"))
    index.write.mode("overwrite").parquet(f"{path}/index")


def _fields(df: DataFrame) -> DataFrame:
    p = F.split("value", "\t")
    return df.select(*(c for c in df.columns if c != "value"), p[0].alias("chrom"), p[1].cast("bigint").alias("start"), p[2].cast("bigint").alias("end"), p[3].alias("barcode"), p[4].cast("bigint").alias("n"))


def read_fragments(spark: SparkSession, path: str, chrom: str, start: int, end: int, where: str = "true") -> DataFrame:
    """Fragments that meet a range, of the groups and samples that `where` chooses; only files that the index names are opened."""
    index = spark.read.parquet(f"{path}/index").where((F.col("chrom") == chrom) & F.col("bin").between(start // BIN, max(start, end - 1) // BIN)).where(where)
    names = [r["file"] for r in index.select("file").distinct().collect()]  # as many as the range needs
    if not names:
        return _fields(spark.read.text(f"{path}/data").limit(0))
    rows = _fields(spark.read.option("basePath", f"{path}/data").text(names))
    return rows.where((F.col("chrom") == chrom) & (F.col("start") < end) & (F.col("end") > start)).where(where)
