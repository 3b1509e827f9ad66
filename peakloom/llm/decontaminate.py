"""Benchmark decontamination by an FM-index per training shard.

A shard is the text of one Arrow batch. Only runs of words that could hold a benchmark window are indexed: every pair
of neighbouring words of a window is a pair of neighbours in some benchmark item, so runs of such pairs that are at
least as long as the shortest window lose nothing. Over these runs a suffix array, its Burrows-Wheeler transform, a
wavelet matrix of ranks and sampled suffix positions are built. All windows are searched backwards at once, occurrences
are located by walking to the next sampled position, and their word spans are merged into removal spans.

The benchmark travels to executors in blocks of bounded size, one after the other; each is one map over the documents,
without a shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_ROWS, discard, packed, text_of, unpacked, words, written

WINDOW = 13  # words
BLOCK_BYTES = 16 << 20  # of benchmark text broadcast at once
SHARD_WORDS = 1 << 20  # indexed words of a shard, at which it is closed at the end of a document
SAMPLE = 8  # every so many suffix positions are kept
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before A-Z are lower-cased


class Windows:
    """The windows of one block of benchmark items, as word ids from 1."""

    def __init__(self, items: list[tuple[str, str]]) -> None:
        self.ids: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.items)}
        found: dict[int, dict[tuple[int, ...], set[int]]] = {}
        pairs, singles = set(), set()
        for item, text in items:
            seq = [self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)]
            if not seq:
                continue
            n = min(WINDOW, len(seq))
            pairs.update(zip(seq, seq[1:]))
            if n == 1:
                singles.add(seq[0])
            of = found.setdefault(n, {})
            for i in range(len(seq) - n + 1):
                of.setdefault(tuple(seq[i : i + n]), set()).add(number[item])
        self.size = len(self.ids) + 1
        self.pairs = np.array(sorted(a * self.size + b for a, b in pairs), np.int64)
        self.single = np.zeros(self.size, bool)
        self.single[list(singles)] = True
        self.shortest = min((n for n in found if n > 1), default=0)
        #: (length, windows as rows, items of each window as a flat array with its offsets)
        self.groups = []
        for n, of in sorted(found.items()):
            sets = [sorted(x) for x in of.values()]
            at = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
            self.groups.append((n, np.array(list(of), np.int64), np.array([y for x in sets for y in x], np.int64), at))

    def runs(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word ids, word positions) of the runs that can hold a window."""
        get = self.ids.get
        ids = np.fromiter((get(w, 0) for w in tokens), np.int64, len(tokens))
        keep = self.single[ids] if len(ids) else np.zeros(0, bool)
        if self.shortest and len(ids) >= self.shortest:
            linked = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            code = ids[linked] * self.size + ids[linked + 1]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            linked = linked[self.pairs[at] == code]
            if len(linked) >= self.shortest - 1:
                edge = np.flatnonzero(np.diff(linked) != 1) + 1
                first, last = linked[np.concatenate([[0], edge])], linked[np.concatenate([edge - 1, [len(linked) - 1]])]
                for a, b in zip(first, last):
                    if b - a + 2 >= self.shortest:
                        keep[a : b + 2] = True
        where = np.flatnonzero(keep)
        return ids[where], where


class FMIndex:
    """Over segments of word ids; words of different segments are never neighbours."""

    def __init__(self, text: np.ndarray, segment_starts: np.ndarray) -> None:
        """text: ids from 1 with a 0 before each segment and at the end; segment_starts: where these zeros are."""
        n = len(text)
        rank = text + n  # separators sort first and differ from each other
        rank[segment_starts] = np.arange(len(segment_starts))
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        k = 1
        while True:  # prefix doubling; separators differ, so it ends once k exceeds the longest segment
            key = rank * (n + 1)
            key[: n - k] += rank[k:] + 1
            sa = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(np.diff(key[sa]) != 0)])
            rank = np.empty(n, np.int64)
            rank[sa] = new
            if new[-1] == n - 1 or k >= n:
                break
            k *= 2
        self.n, self.top = n, int(text.max())
        bwt = text[sa - 1]
        counts = np.bincount(text, minlength=int(text.max()) + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])  # rows that start with a smaller symbol
        # Sampled: every SAMPLE-th position, and those after a separator, so that no walk crosses one.
        self.sampled = (sa % SAMPLE == 0) | (bwt == 0)
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = sa[self.sampled]
        self.levels = []
        for bit in range(max(1, int(text.max()).bit_length()) - 1, -1, -1):
            ones = (bwt >> bit) & 1
            rank1 = np.concatenate([[0], np.cumsum(ones)])
            self.levels.append((bit, n - int(rank1[-1]), rank1))
            bwt = np.concatenate([bwt[ones == 0], bwt[ones == 1]])

    def _down(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        for bit, zeros, rank1 in self.levels:
            r = rank1[row]
            row = np.where((symbol >> bit) & 1 == 1, zeros + r, row - r)
        return row

    def ranks(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the transform before each row."""
        return self._down(symbol, row) - self._down(symbol, np.zeros_like(row))

    def symbols(self, row: np.ndarray) -> np.ndarray:
        out = np.zeros(len(row), np.int64)
        for bit, zeros, rank1 in self.levels:
            one = rank1[row + 1] - rank1[row]
            out |= one << bit
            row = np.where(one == 1, zeros + rank1[row], row - rank1[row])
        return out

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all rows of patterns: (pattern number, low row, high row) of those that occur."""
        alive = np.arange(len(patterns))
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[alive, j]
            there = c <= self.top
            alive, lo, hi, c = alive[there], lo[there], hi[there], c[there]
            lo, hi = self.first[c] + self.ranks(c, lo), self.first[c] + self.ranks(c, hi)
            some = hi > lo
            alive, lo, hi = alive[some], lo[some], hi[some]
        return alive, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, todo, at, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), rows, 0
        while len(todo):
            done = self.sampled[at]
            out[todo[done]] = self.samples[self.sample_rank[at[done]]] + steps
            todo, at = todo[~done], at[~done]
            c = self.symbols(at)
            at = self.first[c] + self.ranks(c, at)
            steps += 1
        return out


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    size = hi - lo
    of = np.repeat(np.arange(len(lo)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + lo[of], of


def search_shard(windows: Windows, docs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """For each document's runs: merged word spans [start, end) of all windows that occur, and their items."""
    out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in docs]
    ids, where, doc = [], [], []
    for d, (i, w) in enumerate(docs):
        if len(i):
            cut = np.concatenate([[0], np.flatnonzero(np.diff(w) != 1) + 1])
            ids.append(np.insert(i, cut, 0))
            where.append(np.insert(w, cut, -1))
            doc.append(np.full(len(ids[-1]), d))
    if not ids:
        return out
    text, where, doc = np.concatenate([*ids, [0]]), np.concatenate([*where, [-1]]), np.concatenate([*doc, [-1]])
    index = FMIndex(text, np.flatnonzero(text == 0))
    cover = np.zeros(len(text) + 1, np.int64)
    for n, patterns, items, at in windows.groups:
        number, lo, hi = index.search(patterns)
        if not len(number):
            continue
        rows, of = _ranges(lo, hi)
        start = index.locate(rows)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + n, -1)
        seen = np.unique(np.stack([doc[start], number[of]]), axis=1)
        flat, back = _ranges(at[seen[1]], at[seen[1] + 1])
        for d, k in np.unique(np.stack([seen[0][back], items[flat]]), axis=1).T.tolist():
            out[d][1].add(windows.items[k])
    hit = np.cumsum(cover)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        out[doc[a]][0].append((int(where[a]), int(where[b - 1]) + 1))
    return out


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def excise(text: str | None, spans: list[int] | None) -> str | None:
    """The text without the words of the spans (flat start, end, start, end ...), from a word's start to the last's end."""
    if not text or not spans:
        return text
    at = [m.span() for m in WORD.finditer(text)]
    out, from_ = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(text[from_ : at[a][0]])
        from_ = at[b - 1][1]
    return "".join([*out, text[from_:]])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list[tuple[str, str]], bool]]:
    """The benchmark in blocks of about BLOCK_BYTES, one at a time: a list of (item, text), and whether it is the last."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), text_of(text_col).alias("words"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, math.ceil(size / BLOCK_BYTES))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n)))
    for b in range(n):
        yield [(r["item"], r["words"]) for r in rows.where(F.col("block") == b).select("item", "words").toLocalIterator()], b == n - 1


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: counts, items with occurring windows, the contamination verdict and the removal spans.

    Null and empty texts have no words and are clean; items without words have no windows; an empty benchmark leaves
    all clean. Repeated documents give repeated rows, a repeated item counts once, an item without an id is named "".
    Columns other than those named are ignored. `spans` is flat: start, end (exclusive) in words, merged.
    """
    return _all_passes(docs, [id_col], text_col, _blocks(benchmark, item_col, item_text_col))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The input's rows and columns without contaminated documents (same rules as `decontaminate`)."""
    rows = docs.select(packed(docs), F.col(text_col).alias("text"))
    return unpacked(_all_passes(rows, ["row"], "text", _blocks(benchmark, item_col, item_text_col)).where("not contaminated"))


def _all_passes(docs: DataFrame, keep: list[str], text_col: str, blocks: Iterator) -> DataFrame:
    """One pass a block; between passes the rows are written out, so that one block is in memory and one worker in a task."""
    sc = docs.sparkSession.sparkContext
    out = docs.select(*keep, F.col(text_col).alias("_text"), F.lit(None).cast("array<int>").alias("_spans"), F.lit(None).cast("array<string>").alias("_items"))
    before = None
    for block, last in blocks:
        shared = sc.broadcast(block)
        out = _pass(out, keep, shared, last)
        if not last:
            out = written(out)
            shared.destroy()
            if before is not None:
                discard(before)
            before = out
    return out


_FOUND = [("spans", "array<int>", pa.list_(pa.int32())), ("items", "array<string>", pa.list_(pa.string()))]
_COUNTS = [("n_words", "bigint", pa.int64()), ("n_hit", "bigint", pa.int64()), ("n_items", "bigint", pa.int64()), ("items_sha256", "string", pa.string()), ("contaminated", "boolean", pa.bool_())]


def _pass(df: DataFrame, keep: list[str], block, last: bool) -> DataFrame:
    """One block's windows; df: `keep`, then _text and what earlier blocks found. The last pass gives the counts."""
    own = [*_COUNTS, *_FOUND] if last else [("_text", "string", pa.string()), *(("_" + n, t, k) for n, t, k in _FOUND)]
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(n, T._parse_datatype_string(t)) for n, t, _ in own)])
    m = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(block.value)
        for batch in batches:
            n_words, shard, size, found = [], [], 0, []
            for at in range(0, batch.num_rows, SLICE_ROWS):
                for text in batch.column(m).slice(at, SLICE_ROWS).to_pylist():
                    tokens = words(text)
                    n_words.append(len(tokens))
                    shard.append(windows.runs(tokens))
                    size += len(shard[-1][0])
                    if size >= SHARD_WORDS:
                        found += search_shard(windows, shard)
                        shard, size = [], 0
            found += search_shard(windows, shard)
            spans, items = [], []
            for (new, more), old, had in zip(found, batch.column(m + 1).to_pylist(), batch.column(m + 2).to_pylist(), strict=True):
                old = old or []
                spans.append([x for s in merge_spans([*new, *zip(old[::2], old[1::2])]) for x in s])
                items.append(sorted(more | set(had or [])))
            if last:
                hit = [sum(s[1::2]) - sum(s[::2]) for s in spans]
                cols = [n_words, hit, [len(i) for i in items], [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], [h > 0 and 20 * h >= n for h, n in zip(hit, n_words)]]
            else:
                cols = [batch.column(m)]
            arrays = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, (_, _, kind) in zip([*cols, spans, items], own)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:m], *arrays], names=schema.names)

    return df.mapInArrow(run, schema)
