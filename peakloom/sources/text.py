"""Text sources and sinks: BED, Matrix Market, sidecar tables, BED / bedGraph / interact writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.links import safe_name


def bed_lines(lines: DataFrame) -> DataFrame:
    """lines: (value). (chrom, start, end, ok): blank, comment, track and browser lines are left out; tabs, else blanks."""
    v = F.btrim("value", F.lit(" \r\n"))
    use = lines.where((v != "") & ~v.rlike(r"^(?:#|track|browser)"))
    parts = F.when(F.contains(v, F.lit("\t")), F.split(v, "\t")).otherwise(F.split(v, r"\s+"))
    p = use.select(parts.alias("p"))
    get = lambda i: F.get("p", F.lit(i))
    out = p.select(get(0).alias("chrom"), get(1).try_cast("bigint").alias("start"), get(2).try_cast("bigint").alias("end"))
    return out.withColumn("ok", F.coalesce((F.col("end") > F.col("start")) & (F.col("start") >= 0), F.lit(False)))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return bed_lines(spark.read.text(path)).where("ok").drop("ok")


def read_matrix_market(spark: SparkSession, path: str) -> DataFrame:
    """(i, j, value), 1-based, of a coordinate file; comments and the size line are left out."""
    t = spark.read.text(path).where(~F.col("value").startswith("%")).select(F.split(F.btrim("value"), r"\s+").alias("p"), F.monotonically_increasing_id().alias("n"))
    first = t.agg(F.min("n").alias("m"))
    t = t.join(F.broadcast(first), t["n"] > first["m"])  # one row
    return t.select(F.col("p")[0].cast("bigint").alias("i"), F.col("p")[1].cast("bigint").alias("j"), F.col("p")[2].cast("double").alias("value"))


def read_named_matrix(spark: SparkSession, path: str, rows: str, columns: str) -> DataFrame:
    """(row, column, value) of a coordinate file with files of its row and column names, one a line (first field).

    Fatal are: names that repeat, numbers of names that differ from the size line, and entries outside it.
    """
    size = spark.read.text(path).where(~F.col("value").startswith("%") & (F.btrim("value") != "")).limit(1).first()
    shape = [int(x) for x in size[0].split()[:2]] if size else [0, 0]
    names = []
    for file, n, what in ((rows, shape[0], "rows"), (columns, shape[1], "columns")):
        t = spark.read.text(file).where("value <> ''").select(F.split(F.btrim("value", F.lit("\r\n")), "\t")[0].alias("name"), F.monotonically_increasing_id().alias("_i"))
        one = t.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("name").alias("d")).first()
        if one["d"] < one["n"]:
            raise ValueError(f"{one['n'] - one['d']} names repeat in {file}")
        if one["n"] != n:
            raise ValueError(f"{path} has {n} {what}, {file} {one['n']} names")
        part = F.shiftright("_i", 33)
        before = t.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_f"))  # one row a file split
        before = before.select("_p", "_f", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
        inner = F.row_number().over(Window.partitionBy("_p").orderBy("_i"))
        names.append(t.withColumn("_p", part).join(before, "_p").withColumn("place", F.col("_b") + inner).select("place", "name"))
    m = read_matrix_market(spark, path)
    if m.where(~F.col("i").between(1, shape[0]) | ~F.col("j").between(1, shape[1])).limit(1).count():
        raise ValueError(f"{path} has entries outside {shape[0]} x {shape[1]}")
    return m.join(names[0].toDF("i", "row"), "i").join(names[1].toDF("j", "column"), "j").select("row", "column", "value")


def read_until(spark: SparkSession, path: str, prefix: str = "rho__") -> DataFrame:
    """A delimited table read by tab, or else by comma: by the first that gives a column with the prefix; none is fatal."""
    for sep in ("\t", ","):
        df = spark.read.csv(path, sep=sep, header=True)
        if any(c.startswith(prefix) for c in df.columns):
            return df
    raise ValueError(f"{path} has no column {prefix}*, by tab or by comma")


def read_sidecar(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A delimited table whose separator is the one of its first line that splits it more; a repeated key is fatal."""
    head = spark.read.text(path).limit(1).first()
    sep = "\t" if head and head[0].count("\t") >= head[0].count(",") else ","
    df = spark.read.csv(path, sep=sep, header=True)
    if df.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"{key} repeats in {path}")
    return df


def read_region_names(spark: SparkSession, path: str) -> DataFrame:
    """(region) of a list or BED file: the only field, or the fourth, or chrom:start-end of the first three."""
    p = spark.read.text(path).where(F.btrim("value") != "").select(F.split(F.btrim("value"), r"\s+").alias("p"))
    joined = F.concat(F.col("p")[0], F.lit(":"), F.get("p", F.lit(1)), F.lit("-"), F.get("p", F.lit(2)))
    return p.select(F.when(F.size("p") == 1, F.col("p")[0]).when(F.size("p") >= 4, F.get("p", F.lit(3))).when(F.size("p") == 3, joined).alias("region"))


def read_positional(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A table with `row_idx`, its rows' places from 0. Rows one field wider than the header begin with `__rowname__`.

    Places follow the file: the ids of Spark's rows rise along it, and their rank needs one sort by range, not one task.
    """
    two = [r[0].rstrip("\r\n") for r in spark.read.text(path).limit(2).collect()]
    if not two:
        return spark.createDataFrame([], "row_idx bigint")
    names = two[0].split(sep)
    if len(two) > 1 and len(two[1].split(sep)) == len(names) + 1:
        names = ["__rowname__", *names]
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("_i"))
    part = F.shiftright("_i", 33)
    per = lines.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))  # one row a file split
    before = per.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    placed = lines.withColumns({"_p": part, "_o": F.col("_i").bitwiseAND((1 << 33) - 1)}).join(before, "_p").withColumn("row_idx", F.col("_b") + F.col("_o") - 1).where("row_idx >= 0")
    fields = F.split(F.col("value"), sep, -1)
    return placed.select("row_idx", *(F.get(fields, F.lit(i)).alias(n.strip('"')) for i, n in enumerate(names)))


def decode(df: DataFrame, column: str, categories: DataFrame, empty: str | None = None) -> DataFrame:
    """A column of category codes made labels; codes below 0, unknown and null ones become `empty`. categories: (code, label)."""
    named = categories.select(F.col("code").alias(column), F.col("label").alias("_label"))
    return df.join(named, column, "left").withColumn(column, F.coalesce("_label", F.lit(empty))).drop("_label")


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """(file, n_lines) of every file of a folder or glob that has lines."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return spark.read.text(path).select(name.alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n_lines"))


def bed6(regions: DataFrame, group: str = "grp", effect: str = "eff") -> DataFrame:
    """(group, line) of BED6: name {group}_{number}, effect to 4 places, sorted by place within the group."""
    k = F.row_number().over(Window.partitionBy(group).orderBy("chrom", "start", "end"))
    name = F.concat_ws("_", safe_name(F.col(group).cast("string")), k.cast("string"))
    return regions.select(F.col(group), F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), name, F.format_string("%.4f", effect), F.lit(".")).alias("line"))


def bedgraph(track: DataFrame, value: str) -> DataFrame:
    """(grp, line) of values above 0 to 5 places."""
    return track.where(F.col(value) > 0).select("grp", F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.format_string("%.5f", value)).alias("line"))


def write_groups(lines: DataFrame, path: str, group: str = "grp") -> None:
    """One folder of text a group, by place, replacing what was there; lines: (group, line), which begin with a place."""
    from .tracks import folders, write_sorted

    p = F.split("line", "\t")
    placed = folders(lines, group).withColumns({"_chrom": p[0], "_start": p[1].try_cast("bigint"), "_end": p[2].try_cast("bigint")})
    write_sorted(placed, F.col("line"), path, [group], ["_chrom", "_start", "_end", "line"])
