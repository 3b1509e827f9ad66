"""Cross-tokenizer alignment: tokens of two vocabularies over the same bytes, linked where they end together.

Cumulated token lengths are the ends of both sides over a run of texts; their intersection are the common cuts, which
cut both sides into groups; tokens that end at a common cut are linked. How often a pair of ids is linked in the corpus
is summed in tasks first, then by pair and salt, then by pair.

Of two tokens that end together the shorter is an ending of the longer. So the pairs that can occur at all follow from
the vocabularies alone (`possible_pairs`: some hundred thousand), whatever the corpus: their counts may be broadcast.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import ChunkCoder, byte_bpe, once, pieces
from .common import map_columns, written

SALTS = 16
SLICE_CHARS = 1 << 20  # of texts aligned at a time (or one longer text)


def byte_level_tokens(json_path: str) -> list[bytes]:
    """The bytes of every id: byte-level vocabularies write bytes that print as themselves, others from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in prints)}
    with open(json_path, encoding="utf-8") as f:
        spec = json.load(f)
    entries = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
    out = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        out[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return out


def piece_tokens(model_path: str) -> list[bytes]:
    """The bytes of every id: U+2581 is a blank, <0xHH> a byte."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in range(len(model))]


def possible_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many pairs of ids can end together: one's bytes are an ending of the other's."""
    endings = lambda x: {x[i:] for i in range(len(x))}
    known_a, known_b = {}, {}
    for known, side in ((known_a, a), (known_b, b)):
        for x in side:
            known[x] = known.get(x, 0) + 1
    longer_a = sum(known_b.get(e, 0) for x in a for e in endings(x))
    longer_b = sum(known_a.get(e, 0) for x in b for e in endings(x) if e != x)
    return longer_a + longer_b


class Side:
    """A vocabulary's bytes by id, and how an id is written in a list of groups."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.tokens = tokens

    def written(self, last: str) -> np.ndarray:
        """How an id is written inside a group, and from len(tokens) on, how at its end."""
        return np.array([f"{i}{mark}" for mark in (",", last) for i in range(len(self.tokens))], object)


def align(a: np.ndarray, b: np.ndarray, left: Side, right: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group of each a token, group of each b token, a token and b token of each link) of ids over the same bytes.

    Every pair of tokens that end at one cut is a link: tokens without bytes end where the one before does.
    """
    ends_a, ends_b = np.cumsum(left.size[a]), np.cumsum(right.size[b])
    rising = bool(left.size[a].all() and right.size[b].all())  # no token without bytes: ends are distinct
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=rising)
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    first_a, first_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
    n_a, n_b = np.searchsorted(ends_a, cuts, "right") - first_a, np.searchsorted(ends_b, cuts, "right") - first_b
    each = n_a * n_b
    cut, place = np.repeat(np.arange(len(cuts)), each), np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return group_a, group_b, first_a[cut] + place // n_b[cut], first_b[cut] + place % n_b[cut]


def _groups(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, written: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The written ids of all groups in a row, each with the sign after it: a group's a ids, then its b ids."""
    last = lambda g: np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool)
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    of_a, of_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    out = np.empty(len(a) + len(b), object)
    out[np.arange(len(a)) + (np.cumsum(of_b) - of_b)[group_a]] = written[0][a + last(group_a) * (len(written[0]) // 2)]
    out[np.arange(len(b)) + np.cumsum(of_a)[group_b]] = written[1][b + last(group_b) * (len(written[1]) // 2)]
    return out


class Aligner:
    def __init__(self, json_path: str, ranks_path: str, model_path: str) -> None:
        self.a, self.b = Side(byte_level_tokens(json_path)), Side(piece_tokens(model_path))
        self.written = (self.a.written("|"), self.b.written(";"))
        self.coder = ChunkCoder(byte_bpe(json_path, ranks_path), pieces(model_path), tokens=[self.a.tokens, self.b.tokens])

    def __call__(self, texts: list[str | None]) -> tuple[list, ...]:
        """n_a, n_b, n_groups, n_links, groups_sha256, pairs, counts of each text; a pair is a id x ids of b + b id."""
        out: list[tuple] = [(0, 0, 0, 0, "", [], [])] * len(texts)
        batch, chars = [], 0
        for i, t in enumerate(texts):
            if t:
                batch.append(i)
                chars += len(t)
            if batch and (chars >= SLICE_CHARS or i == len(texts) - 1):
                self._batch(texts, batch, out)
                batch, chars = [], 0
        if batch:
            self._batch(texts, batch, out)
        return tuple(map(list, zip(*out, strict=True))) if out else ([],) * 7

    def _batch(self, texts: list[str | None], batch: list[int], out: list[tuple]) -> None:
        given = [texts[i] for i in batch]
        (ids_a, ids_b), sure = self.coder.encode_all(given, True)
        joined = self.coder.joined
        same = [i for i, t in enumerate(given) if sure[i] or joined(0, ids_a[i]) == (" " + t).encode("utf-8", "surrogatepass") == joined(1, ids_b[i])]
        if not same:
            return
        a = np.frombuffer(b"".join(ids_a[i] for i in same), "<u4").astype(np.int64)
        b = np.frombuffer(b"".join(ids_b[i] for i in same), "<u4").astype(np.int64)
        group_a, group_b, link_a, link_b = align(a, b, self.a, self.b)  # a text's end is a common cut
        pair = a[link_a] * len(self.b.tokens) + b[link_b]
        marks = _groups(a, b, group_a, group_b, self.written)
        end_a, end_b = np.cumsum([len(ids_a[i]) // 4 for i in same]), np.cumsum([len(ids_b[i]) // 4 for i in same])
        end_group = group_a[end_a - 1] + 1
        end_link = np.searchsorted(link_a, end_a)
        at_a = at_b = at_group = at_link = 0
        for k, i in enumerate(same):
            to_a, to_b, to_group, to_link = int(end_a[k]), int(end_b[k]), int(end_group[k]), int(end_link[k])
            text = "".join(marks[at_a + at_b : to_a + to_b].tolist())[:-1]
            pairs, counts = np.unique(pair[at_link:to_link], return_counts=True)
            out[batch[i]] = (to_a - at_a, to_b - at_b, to_group - at_group, to_link - at_link, hashlib.sha256(text.encode()).hexdigest(), pairs, counts)
            at_a, at_b, at_group, at_link = to_a, to_b, to_group, to_link


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n) over rows (pairs, counts): summed in the task, which holds no more than the vocabularies' possible pairs,
    then by pair and salt, then by pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, held = [], [], 0
        def fold():
            k, at = np.unique(np.concatenate(keys), return_inverse=True)
            return k, np.bincount(at, np.concatenate(sums)).astype(np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            keys.append(pc.list_flatten(b.column(0)).to_numpy(zero_copy_only=False))
            sums.append(pc.list_flatten(b.column(1)).to_numpy(zero_copy_only=False))
            held += len(keys[-1])
            if held > 1 << 22:
                k, s = fold()
                keys, sums, held = [k], [s], len(k)
        if held:
            k, s = fold()
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(s, pa.int64())], names=["pair", "n"])

    parts = rows.select("pairs", "counts").mapInArrow(run, "pair bigint, n bigint")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("pair", "n", F.spark_partition_id()), F.lit(SALTS))).groupBy("pair", "salt").agg(F.sum("n").alias("n"))
    return salted.groupBy("pair").agg(F.sum("n").alias("n"))


def align_tokens(docs: DataFrame, json_path: str, ranks_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A blank and the text are encoded by the byte-level vocabulary of json_path (also given as ranks) and the text by the
    piece model, which adds the blank; strings of special tokens are plain text. Texts that are null, empty, or not the
    joined bytes of their tokens on both sides have zeros and the empty string. Repeated rows count each time; further
    columns are ignored; an empty table gives none.

    Texts are encoded once, in place, and the result is written with each text's distinct pairs; only pair counts move.
    A slice of texts bounds memory (or one longer text).
    """
    paths = (json_path, ranks_path, model_path)

    def make():
        return once(paths, lambda: Aligner(*paths))

    out = [("n_a", "bigint"), ("n_b", "bigint"), ("n_groups", "bigint"), ("n_links", "bigint"), ("groups_sha256", "string"), ("pairs", "array<bigint>"), ("counts", "array<bigint>")]
    rows = written(map_columns(docs, [id_col], [text_col], out, make))
    of_b = len(piece_tokens(model_path))
    most = F.max("n").over(Window.partitionBy(F.col("pair") % of_b))
    table = pair_counts(rows).select("pair", "n", (F.col("n") == most).alias("best")).toArrow()  # bounded by the vocabularies
    order = np.argsort(table["pair"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy()[order] for c in ("pair", "n", "best")))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for b in batches:
            counts = pc.list_flatten(b["counts"]).to_numpy(zero_copy_only=False)
            at = np.searchsorted(pair, pc.list_flatten(b["pairs"]).to_numpy(zero_copy_only=False))
            size = pc.list_value_length(b["pairs"]).to_numpy(zero_copy_only=False)
            line = np.repeat(np.arange(b.num_rows), size)
            sums = [np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)]
            np.add.at(sums[0], line, counts * best[at])
            np.add.at(sums[1], line, counts * n[at])
            yield pa.RecordBatch.from_arrays([*(b[c] for c in first), *(pa.array(s) for s in sums), b["groups_sha256"]], names=[*first, "n_best", "count_sum", "groups_sha256"])

    first = [id_col, "n_a", "n_b", "n_groups", "n_links"]
    schema = rows.select(*first, F.col("n_links").alias("n_best"), F.col("n_links").alias("count_sum"), "groups_sha256").schema
    return rows.select(*first, "groups_sha256", "pairs", "counts").mapInArrow(score, schema)
