"""Region catalogs of ranking databases from the footers of their Arrow files: of a file of many gigabytes the trailer,
the footer and, where regions are rows, one column are read."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import StoredFile
from .tables import three_spellings

# The column that holds a database's row names, by what its rows are.
ROW_COLUMNS = ("motifs", "tracks", "regions", "genes")
OLD_MAGIC, MAGIC = b"FEA1", b"ARROW1"


def arrow_schema(file: StoredFile) -> pa.Schema:
    """The schema of an Arrow (feather v2) file, from its trailer and footer alone."""
    file.seek(0)
    head = file.read(len(MAGIC))
    if head[:4] == OLD_MAGIC:
        raise ValueError(f"{file.path} is a feather file of version 1: convert it first")
    if head != MAGIC:
        raise ValueError(f"{file.path} is no Arrow file")
    return pa.ipc.open_file(pa.PythonFile(file, mode="r")).schema


def _values(file: StoredFile, column: str):
    """The values of one column, batch by batch, other columns unread."""
    at = arrow_schema(file).names.index(column)
    reader = pa.ipc.open_file(pa.PythonFile(file, mode="r"), options=pa.ipc.IpcReadOptions(included_fields=[at]))
    for i in range(reader.num_record_batches):
        yield reader.get_batch(i).select([column])


def read_database_regions(spark: SparkSession, path: str, expected: int | None = None) -> DataFrame:
    """(region, chrom, start, end), distinct, of a ranking or score database.

    Where motifs or tracks are rows, regions are the names of the other columns; where regions are rows, the values of
    that column. A prefix up to a double underscore is cut where the first name has one. Databases of genes are refused,
    and so is any with a name that is no region; `expected` is the number of regions there must be.
    """
    file = StoredFile(spark, path)
    names = arrow_schema(file).names
    rows = [n for n in ROW_COLUMNS if n in names]
    if rows == ["regions"]:
        batches = [spark.createDataFrame(pa.Table.from_batches([b]).rename_columns(["name"])) for b in _values(file, "regions")]
        found = batches[0] if batches else spark.createDataFrame([], "name string")
        for b in batches[1:]:
            found = found.unionByName(b)
    elif "genes" in rows:
        raise ValueError(f"{path} is a database of genes")
    else:
        found = spark.createDataFrame(pa.table({"name": pa.array([n for n in names if n not in ROW_COLUMNS], pa.string())}))
    first = found.first()
    if first is None:
        raise ValueError(f"{path} holds no regions")
    region = F.substring_index("name", "__", -1) if "__" in first["name"] else F.col("name")
    out = found.select(region.alias("region")).distinct().withColumn("_p", three_spellings(F.col("region")))
    one = out.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_p").isNull()).alias("odd"), F.min(F.when(F.col("_p").isNull(), F.col("region"))).alias("name")).first()
    if one["odd"]:
        raise ValueError(f"{path}: {one['odd']} of {one['n']} names are no regions, {one['name']!r} among them")
    if expected is not None and one["n"] != expected:
        raise ValueError(f"{path} holds {one['n']} regions, not {expected}")
    return out.select("region", "_p.*")
