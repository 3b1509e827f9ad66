"""MinHash near-dedup: BagMinHash signatures over five-word shingles, banded, with the multiset overlap verified."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bag_minhash
from .common import WordHashes, mix, packed, shingles, text_of, unpacked, words, written
from .neardup import LIKENESS, classes


def bag(text: str | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The multiset of word shingles: distinct hashes, counts."""
    return np.unique(shingles(hashes.of(words(text))), return_counts=True)


def make_bands():
    hashes = WordHashes()

    def f(texts):
        bands, sizes = [], []
        for t in texts:
            e, n = bag(t, hashes)
            sizes.append(int(n.sum()))
            bands.append(bag_minhash.bands(bag_minhash.signature(e, n)) if len(e) else [])
        return bands, sizes

    return f


def make_features():
    """A hash for each copy of each shingle: the Jaccard likeness of these sets is that of the multisets."""
    hashes = WordHashes()

    def f(text):
        e, n = bag(text, hashes)
        copy = np.arange(int(n.sum()), dtype=np.uint64) - np.repeat(np.cumsum(n) - n, n).astype(np.uint64)
        return np.sort(mix(np.repeat(e, n) + copy * np.uint64(0x9E3779B97F4A7C15)))

    return f


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", likeness: float = LIKENESS) -> DataFrame:
    """One row per input row: id, key, class_key, class_id, class_size, kept (the class's representative).

    Classes are connected components of links of weighted Jaccard likeness `likeness` or more between the multisets of
    five-word shingles; a text of one to four words is one shingle. Texts without words (null and empty too) are alike
    only if equal. The representative has the least id; rows without an id come last, and of several texts with that id
    the one of the least key counts. Repeated rows are in one class and are all `kept` if one is.

    class_key names the class whatever the ids; class_id, its least id, is null or shared where ids are null or repeated.
    """
    found = classes(docs, make_bands, make_features, id_col, text_col, likeness)
    kept = F.col(id_col).eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))
    return found.select(id_col, "key", F.lower(F.hex("root")).alias("class_key"), "class_id", "class_size", kept.alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", likeness: float = LIKENESS) -> DataFrame:
    """The input's columns; the representative row of each class. Of rows that repeat its id and text one stays: that of
    the least hash of the whole row."""
    # One name for id and key, so that the join and the choice among repeated rows share one shuffle.
    name = lambda id_, key: F.md5(F.concat_ws("/", id_.isNull().cast("string"), F.coalesce(id_.cast("string"), F.lit("")), F.hex(key)))
    found = classes(docs, make_bands, make_features, id_col, text_col, likeness)
    kept = written(found.groupBy("root").agg(F.first("first").alias("first")).select(name(F.col("first.id"), F.col("first.key")).alias("_name")))
    keyed = docs.select(packed(docs), name(F.col(id_col), F.unhex(F.md5(text_of(text_col)))).alias("_name"))
    one = keyed.join(kept, "_name", "left_semi").groupBy("_name").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return unpacked(one.select("row"))
