"""Document fingerprints: MinHash over word shingles by universal hash permutations in numpy.

Texts are compared with an edited copy of themselves (their tail replaced by the head of the next text in descending
id) and with that next text. Neighbours in order of id are brought together by one shuffle into ranges of ids; the first
row of each range travels to the range before, so no task sees more than its range.

`link_fingerprints` joins the signature bands in Spark and verifies the Jaccard likeness of shingle sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_ROWS, WordHashes, discard, distinct, shingles, text_of, words, written
from .neardup import LIKENESS, classes

PERMUTATIONS = 128
BANDS, ROWS = 32, 4  # a pair of likeness 0.8 shares a band with a chance of 1 - 5e-8
RANGE_BYTES, WIDE_BYTES, MANY = 4 << 20, 64 << 20, 2048
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(0, 1 << 63, PERMUTATIONS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, PERMUTATIONS).astype(np.uint64)
_CHUNK = 256


def signature(elements: np.ndarray) -> np.ndarray:
    """The least value of each permutation (a x + b mod 2^64, upper half) over the shingles; all ones without any."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(elements), _CHUNK):
        np.minimum(least, (elements[i : i + _CHUNK, None] * _A + _B).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components, an estimate of the Jaccard likeness of the shingle sets."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def bands(sig: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of the signature."""
    parts = sig.astype(np.uint64).reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        h = (h ^ parts[:, i]) * _GOLD
        h ^= h >> np.uint64(31)
    return h


class Print:
    """What is kept of a text: its shingles, their signature, and the lower 16 bits of that as the fingerprint."""

    def __init__(self, text: str, hashes: WordHashes) -> None:
        self.shingles = distinct(shingles(hashes.of(words(text))))
        self.signature = signature(self.shingles)
        self.fingerprint = self.signature.astype(np.uint16)

    def against(self, other: "Print") -> tuple[float, int, float]:
        """(likeness of the fingerprints, shared bands, Jaccard likeness of the shingles where a band is shared, else 0)."""
        if not len(self.shingles) or not len(other.shingles):
            same = float(len(self.shingles) == len(other.shingles))
            return likeness(self.fingerprint, other.fingerprint), 0, same
        shared = int((bands(self.signature) == bands(other.signature)).sum())
        both = len(np.intersect1d(self.shingles, other.shingles, assume_unique=True)) if shared else 0
        return likeness(self.fingerprint, other.fingerprint), shared, both / (len(self.shingles) + len(other.shingles) - both)


class Ranges:
    """Ranges of rows in descending order of (id, tie), rows without an id last; heads: the first row of each, in order."""

    def __init__(self, heads: list[tuple[object, int]]) -> None:
        some = [h for h in heads if h[0] is not None][::-1]
        self.ids, self.ties = pd.Series([h[0] for h in some]).to_numpy(), np.array([h[1] for h in some], np.int64)
        self.null_ties = np.array([h[1] for h in heads if h[0] is None][::-1], np.int64)
        self.n = len(heads)

    def of(self, ids: pd.Series, none: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(range of each row, whether it is the first of its range); none: rows without an id, whatever stands in ids."""
        at, head = np.zeros(len(tie), np.int64), np.zeros(len(tie), bool)
        if len(self.ids) and not none.all():
            x, t = ids[~none].to_numpy(), tie[~none]
            low, high = np.searchsorted(self.ids, x, "left"), np.searchsorted(self.ids, x, "right")
            first = np.zeros(len(x), bool)
            for k in np.flatnonzero(low < high):  # rows whose id is that of a head
                inside = int(np.searchsorted(self.ties[low[k] : high[k]], t[k], "left"))
                first[k] = low[k] + inside < high[k] and self.ties[low[k] + inside] == t[k]
                low[k] += inside
            at[~none], head[~none] = np.maximum(len(self.ids) - 1 - low, 0), first
        low = np.searchsorted(self.null_ties, tie[none], "left")
        at[none] = self.n - 1 - low
        head[none] = (low < len(self.null_ties)) & (self.null_ties[np.minimum(low, max(0, len(self.null_ties) - 1))] == tie[none]) if len(self.null_ties) else False
        return at, head


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, _range, _context, _text) sorted by range, then context rows last, then descending id.

    The row after the last of a range is a context row: a copy of the first row of the next range (of the first range
    after the last one). Ties of an id are ordered by the hash of the text; rows without an id come last. Ids are of any
    type that can be ordered. A range is RANGE_BYTES of text, or WIDE_BYTES where there would be more than MANY of them,
    so a task's share never grows with the input; the heads, one for each range, go to the driver and to all tasks.
    """
    rows = docs.select(F.col(id_col), F.col(id_col).alias("_order"), text_of(text_col).alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    keys = written(rows.select("_order", "_tie", F.octet_length("_text").alias("_n")))
    size = keys.agg(F.sum("_n").alias("n")).first()["n"] or 0
    n = max(1, math.ceil(size / RANGE_BYTES))
    n = n if n <= MANY else max(MANY, math.ceil(size / WIDE_BYTES))
    dealt = keys.repartitionByRange(n, F.desc_nulls_last("_order"), F.desc("_tie")) if n > 1 else keys
    top = dealt.groupBy(F.spark_partition_id().alias("p") if n > 1 else F.lit(0).alias("p")).agg(F.max(F.struct("_order", "_tie")).alias("h"))
    heads = [(r["h"]["_order"], r["h"]["_tie"]) for r in top.orderBy(F.desc_nulls_last("h._order"), F.desc("h._tie")).select("h").collect()]
    discard(keys)
    ranges = Ranges(heads)

    @F.pandas_udf("range int, also int")
    def place(order: pd.Series, none: pd.Series, tie: pd.Series) -> pd.DataFrame:
        at, head = ranges.of(order, none.to_numpy(bool), tie.to_numpy(np.int64))
        return pd.DataFrame({"range": at.astype("int32"), "also": pd.array(np.where(head, (at - 1) % ranges.n, -1), "Int32")})

    filled = F.coalesce("_order", F.lit(heads[0][0])) if heads and heads[0][0] is not None else F.lit(0)  # else pandas makes whole numbers floats
    rows = rows.withColumn("_place", place(filled, F.col("_order").isNull(), "_tie"))
    own, copy = F.struct(F.col("_place.range").alias("_range"), F.lit(False).alias("_context")), F.struct(F.col("_place.also").alias("_range"), F.lit(True).alias("_context"))
    rows = rows.withColumn("_at", F.explode(F.when(F.col("_place.also") < 0, F.array(own)).otherwise(F.array(own, copy))))
    rows = rows.select(F.col(id_col), "_order", "_tie", F.col("_at._range").alias("_range"), F.col("_at._context").alias("_context"), "_text")
    rows = rows.repartition(F.col("_range")).sortWithinPartitions("_range", "_context", F.desc_nulls_last("_order"), F.desc("_tie"))
    return rows.select(id_col, "_range", "_context", "_text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: length, fingerprints of the text and its edited copy, their likeness, and the same by bands.

    near_* are shares of equal components; bands_* are the bands that the signatures share, and jaccard_* the exact
    likeness of the shingle sets of those that share one, as in a join of bands (0 for those that don't).

    Null texts are empty; an empty text has the fingerprint of no shingles, and two such are alike (1.0). A text of one
    to four words is one shingle. A single row is its own next. Repeated rows follow each other; other columns are ignored.
    """
    numbers = [(f"{k}_{other}", kind, t) for k, kind, t in (("near", "double", pa.float64()), ("bands", "bigint", pa.int64()), ("jaccard", "double", pa.float64())) for other in ("edited", "next")]
    kinds = [("n_chars", "bigint", pa.int64()), *((n, "string", pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")), *numbers]
    rows = with_next(docs, id_col, text_col)
    schema = T.StructType([rows.schema[id_col], *(T.StructField(n, T._parse_datatype_string(t)) for n, t, _ in kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, out = WordHashes(), None, []

        def flush():
            part = pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], batch.column(0).type), *(pa.array([r[i + 1] for r in out], kind) for i, (_, _, kind) in enumerate(kinds))], names=schema.names)
            out.clear()
            return part

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns), strict=True):
                    id_, range_, context, text = row
                    if held is not None and held[1] == range_:
                        if context and held[2]:
                            continue  # repeated first rows
                        own = Print(text, hashes)
                        new = edited(held[3], text)
                        changed = Print(new, hashes)
                        pairs = zip(held[4].against(changed), held[4].against(own))
                        out.append((held[0], len(held[3]), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), held[4].fingerprint.tobytes().hex(), changed.fingerprint.tobytes().hex(), *(x for pair in pairs for x in pair)))
                        held = (*row, own)
                    else:
                        held = (*row, Print(text, hashes))
                if out:
                    yield flush()

    return rows.mapInArrow(run, schema)


def _make_bands():
    hashes = WordHashes()

    def f(texts):
        found = [distinct(shingles(hashes.of(words(t)))) for t in texts]
        return [bands(signature(e)).view(np.int64).tolist() if len(e) else [] for e in found], [len(e) for e in found]

    return f


def _make_features():
    hashes = WordHashes()
    return lambda text: distinct(shingles(hashes.of(words(text))))


def link_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LIKENESS) -> DataFrame:
    """One row per input row: id, key of its text, root, class_id, class_size and first, by joined bands and verified Jaccard."""
    return classes(docs, _make_bands, _make_features, id_col, text_col, least)
