"""Shared plumbing: Arrow batch maps, the word rule, hashing, and tables in the shared folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a worker turns into Python objects at a time; bounds memory, not results.
SLICE_ROWS = 512

_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
    "array<float>": pa.list_(pa.float32()),
}


def map_columns(df: DataFrame, keep: list[str], give: list[str], out: list[tuple[str, str]], make: Callable[[], Callable]) -> DataFrame:
    """Arrow map without a shuffle: `make()` is called once per task and returns f(*lists) -> lists of `out` columns.

    `keep` columns pass through unchanged; `give` columns reach f as Python lists; other columns are dropped, so extra
    or clashing columns of the input have no effect.
    """
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in out])
    cols = list(dict.fromkeys([*keep, *give]))
    kinds = [_ARROW[t] for _, t in out]
    names = [*keep, *(n for n, _ in out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                got = f(*(b.column(cols.index(c)).to_pylist() for c in give))
                arrays = [b.column(cols.index(c)) for c in keep] + [pa.array(x, kind) for x, kind in zip(got, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.select(*cols).mapInArrow(run, schema)


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct `row`, so that no name of ours can clash with an input's."""
    return F.struct(*docs.columns).alias("row")


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


# --- words -----------------------------------------------------------------------------------------------------

#: Bytes to bytes: A-Z to a-z, ASCII other than letters and digits to a blank. Bytes from 0x80 belong to words.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased, as UTF-8 bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split() if text else []


class WordHashes:
    """64-bit hashes of words. None is remembered: a word is hashed in a third of the time that it takes to be found among 200,000."""

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; by a sort, which is faster than the library's table for numbers that hardly repeat."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Words in a shingle of the near-duplicate operators.
SHINGLE_WORDS = 5


def shingles(hashes: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit hashes of all runs of k words; a text of fewer words, but not none, is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(k, n)
    s = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        s = s * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - k + 1 + i]
    return mix(s)


# --- tables in the shared folder -------------------------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, or the one the session was given for checkpoints.

    One of our own only where neither is set and driver and executors are one process (tests); a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(f"{tempfile.gettempdir()}/peakloom-checkpoints")
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: cuts lineage, and lost executors cost no earlier step.

    The table is removed by `discard`, or when the driver's Python ends; a DataFrame built on it is lazy and may run later.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/peakloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes written tables that nothing will read any more."""
    for df in tables:
        _remove(df.sparkSession, df.written_at)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session has ended already; the cluster clears its checkpoint folder
        pass


def text_of(column: str = "text"):
    """Null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))
