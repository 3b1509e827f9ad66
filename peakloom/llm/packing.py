"""Best-fit packing by linear grouping: as few sequences of at most `capacity` tokens as it can.

Only the lengths of pieces matter, so all planning is done on their histogram, which has `capacity` entries whatever the
corpus. Large lengths (over a quarter of a sequence) are rounded up within groups of equal cardinality, so few distinct
sizes are left; how often each configuration of them is used is a linear program, whose columns are made as wanted by a
knapsack over the dual prices. Configurations then get actual lengths instead of rounded ones, longest first, and what
is left goes longest first to the sequence where it fits best. Sequences of the same lengths are one run with a count.

Pieces find their places by their rank among those of their length: runs are ranges of ranks. Ranks are made in two
levels, within buckets of a length by hash and over the buckets, so that a common length is no single task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .chunks import ChunkCoder, byte_bpe, once
from .common import SLICE_ROWS, written

CAPACITY, END = 1024, 2
GROUPS = 8192  # of large lengths; as many as they can be, so that common lengths are rounded by little or nothing
BUCKET_SHARE, BUCKET_ROWS = 1024, 50_000  # a bucket of ranks has no more than this part of all pieces, nor more pieces


# --- configurations of rounded lengths ---------------------------------------------------------------------------


class _Knapsack:
    """Fills of one sequence that are worth most at given prices of the sizes, any number of each."""

    def __init__(self, size: np.ndarray, capacity: int) -> None:
        self.size, self.capacity = size, capacity
        room = np.arange(capacity + 1, dtype=np.int32)[:, None] - size.astype(np.int32)
        self.fits, self.room = room >= 0, np.maximum(room, 0)

    def best(self, price: np.ndarray, most: int) -> tuple[float, np.ndarray]:
        """(greatest value, up to `most` fills with the greatest values, a row each): for each size the best with it."""
        at = np.zeros(self.capacity + 1)
        at[self.size] = price
        best = np.maximum.accumulate(at)
        where = np.maximum.accumulate(np.where(at == best, np.arange(self.capacity + 1), 0))
        number = np.full(self.capacity + 1, -1)
        number[self.size] = np.arange(len(self.size))
        picks, line = [np.where(best > 0, number[where], -1)], np.arange(self.capacity + 1)
        for _ in range(self.capacity // int(self.size.min()) - 2):
            value = np.where(self.fits, price + best[self.room], 0.0)
            pick = value.argmax(axis=1)
            new = value[line, pick]
            picks.append(np.where(new > best, pick, -1))
            best = np.maximum(new, best)
        value = price + best[self.capacity - self.size]
        chosen = np.argsort(-value, kind="stable")[:most]
        counts = np.zeros((len(chosen), len(self.size)), np.int64)
        for row, g in enumerate(chosen.tolist()):
            counts[row, g] += 1
            left = self.capacity - int(self.size[g])
            for pick in reversed(picks):
                if (g := int(pick[left])) >= 0:
                    counts[row, g] += 1
                    left -= int(self.size[g])
        return float(value.max()), np.unique(counts, axis=0)


def _greedy(size: np.ndarray, need: np.ndarray, capacity: int) -> np.ndarray:
    """Fills to begin with, a row each: the largest size that is wanted still, then always the largest that fits."""
    left, out = need.copy(), []
    while (left > 0).any():
        fill, room = np.zeros(len(size)), capacity
        while (g := np.flatnonzero((left > fill) & (size <= room))).size:
            i = g[size[g].argmax()]
            n = min(room // size[i], max(1, int(left[i] - fill[i])))
            fill[i] += n
            room -= n * size[i]
        some = fill > 0
        left[some] -= fill[some] * max(1, int((left[some] // fill[some]).min()))
        out.append(fill)
    return np.array(out)


def configurations(size: np.ndarray, need: np.ndarray, capacity: int, rounds: int = 20_000, gap: float = 5e-4) -> list[tuple[np.ndarray, float]]:
    """(how many of each size, how often) of least total that meets every need: a linear program by column generation.

    Ends when no column would lower the total by more than `gap` of it, or after `rounds` exchanges of a column.
    """
    k = len(size)
    columns = np.diag(capacity // size).astype(float)
    inverse, x, cost = np.diag(1.0 / (capacity // size)), need / (capacity // size), np.ones(k)
    knapsack, pool = _Knapsack(size, capacity), _greedy(size, need, capacity)
    for r in range(1, rounds + 1):
        price = cost @ inverse
        least = int(price.argmin())
        worth = pool @ price
        if price[least] < -1e-9:  # more of a size than is needed costs nothing
            column, c = -np.eye(k)[least], 0.0
        else:
            if not len(pool) or worth.max() <= 1 + gap:
                value, more = knapsack.best(np.maximum(price, 0), 64)
                if value <= 1 + gap:
                    break
                pool = np.concatenate([more, pool[np.argsort(-worth, kind="stable")[:2000]]])
                worth = pool @ price
            column, c = pool[worth.argmax()].astype(float), 1.0
        way = inverse @ column
        up = np.flatnonzero(way > 1e-9)
        out = up[(x[up] / way[up]).argmin()]
        step = x[out] / way[out]
        x = np.maximum(x - step * way, 0)
        x[out] = step
        columns[:, out], cost[out] = column, c
        inverse[out] /= way[out]
        way[out] = 0
        inverse -= np.outer(way, inverse[out])
        if r % 500 == 0:
            inverse = np.linalg.inv(columns)
            x = np.maximum(inverse @ need, 0)
    return [(columns[:, j].round().astype(np.int64), float(x[j])) for j in range(k) if cost[j] and x[j] > 0]


# --- the plan ----------------------------------------------------------------------------------------------------


def _grouped(runs: list[tuple[int, int]], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Groups of equal cardinality of the runs (longest first): their rounded length, their actual [length, pieces],
    shortest first."""
    per = -(-sum(n for _, n in runs) // groups)
    out: dict[int, list[list[int]]] = {}
    top, room = 0, 0
    for length, n in runs:
        while n:
            if not room:
                top, room = length, per
            part, group = min(n, room), out.setdefault(top, [])
            if group and group[0][0] == length:
                group[0][1] += part
            else:
                group.insert(0, [length, part])
            n, room = n - part, room - part
    return list(out.items())


def _taken(lengths: list[list[int]], n: int) -> dict[int, int]:
    """The n longest, taken off: how many of each length."""
    out: dict[int, int] = {}
    while n:
        part = min(n, lengths[-1][1])
        out[lengths[-1][0]] = out.get(lengths[-1][0], 0) + part
        lengths[-1][1] -= part
        n -= part
        if not lengths[-1][1]:
            lengths.pop()
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[list[tuple[int, int]], int]]:
    """Runs (contents, count): count sequences that hold each of `contents` (length, times) in this order."""
    runs = sorted(((s, n) for s, n in histogram.items() if n), reverse=True)
    done = [([(s, 1)], n) for s, n in runs if s == capacity]
    large = [(s, n) for s, n in runs if capacity // 4 < s < capacity]
    small = [(s, n) for s, n in runs if s <= capacity // 4]
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}  # runs by the room that is left

    def put(contents: list[tuple[int, int]], n: int) -> None:
        room = capacity - sum(s * t for s, t in contents)
        (open_.setdefault(room, []) if room else done).append((contents, n))

    rest: dict[int, int] = {}
    if large:
        grouped = _grouped(large, groups)
        size, need = np.array([s for s, _ in grouped]), np.array([float(sum(n for _, n in g)) for _, g in grouped])
        left = need.astype(np.int64)
        for count, often in configurations(size, need, capacity):
            members = np.flatnonzero(count)
            n = min(int(often + 1e-6), int((left[members] // count[members]).min()))
            left[members] -= n * count[members]
            while n:  # actual lengths instead of rounded ones, as many sequences at once as get the same
                part = min([n, *(max(1, grouped[i][1][-1][1] // int(count[i])) for i in members)])
                contents: dict[int, int] = {}
                for i in members:
                    for s, k in _taken(grouped[i][1], part * int(count[i])).items():
                        contents[s] = contents.get(s, 0) + k // part
                put(sorted(contents.items(), reverse=True), part)
                n -= part
        for _, g in grouped:
            for s, n in g:
                rest[s] = rest.get(s, 0) + n
    for s, n in sorted([*rest.items(), *small], reverse=True):
        while n:
            room = min((r for r in open_ if r >= s), default=0)
            contents, there = open_[room].pop() if room else ([], n)
            if room and not open_[room]:
                del open_[room]
            times = min((room or capacity) // s, n)
            bins = min(there, n // times)
            if bins < there and room:
                open_.setdefault(room, []).append((contents, there - bins))
            put([*contents, (s, times)], bins)
            n -= bins * times
    return done + [x for r in open_.values() for x in r]


def places(runs: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """Ranges of ranks, sorted by length and first rank: sequence is base + i // times, offset start + i % times * length
    for the i-th rank of a range."""
    rows, base, ranks = [], 0, {}
    for contents, n in runs:
        at = 0
        for s, times in contents:
            rows.append((s, ranks.get(s, 0), base, at, times))
            ranks[s] = ranks.get(s, 0) + n * times
            at += s * times
        base += n
    rows.sort()
    return dict(zip(("length", "rank", "base", "start", "times"), np.array(rows, np.int64).reshape(-1, 5).T))


# --- on Spark ----------------------------------------------------------------------------------------------------


class Cutter:
    """The pieces of texts: (piece, start, length, crc32 of its ids) of each."""

    def __init__(self, json_path: str, ranks_path: str, capacity: int, end: int) -> None:
        self.capacity, self.end = capacity, np.array([end], "<u4").tobytes()
        self.coder = ChunkCoder(byte_bpe(json_path, ranks_path))
        self.whole = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def ids(self, texts: list[str]) -> list[bytes]:
        out = self.coder.encode(texts, False)
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):  # the library finds these strings before it splits a text
                out[i] = np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        return out

    def __call__(self, texts: list[str | None]) -> Iterator[list[tuple[int, int, int, int]]]:
        for ids in self.ids([t or "" for t in texts]):
            ids += self.end
            n = len(ids) // 4
            first = n % self.capacity or self.capacity
            starts = [0, *range(first, n, self.capacity)]
            yield [(k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(starts, [*starts[1:], n]))]


def cut_pieces(docs: DataFrame, json_path: str, ranks_path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece; the first piece of a document has what is no whole sequence."""
    names = [id_col, "piece", "start", "length", "ids_crc32"]
    schema = T.StructType([docs.schema[id_col]] + [T.StructField(n, T.IntegerType() if n == "piece" else T.LongType()) for n in names[1:]])
    key = (json_path, ranks_path, capacity, end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = once(key, lambda: Cutter(*key))
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                cut = list(cutter(b.column(1).to_pylist()))
                line = np.repeat(np.arange(b.num_rows), [len(x) for x in cut])
                values = np.array([p for x in cut for p in x], np.int64).reshape(-1, 4).T
                arrays = [b.column(0).take(pa.array(line)), *(pa.array(v, pa.int32() if n == "piece" else pa.int64()) for n, v in zip(names[1:], values))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def ranked(rows: DataFrame, counts: dict[int, int], id_col: str) -> DataFrame:
    """rows with `rank`, from 0, among those of their length. Equal rows are ranked in any order: they are the same."""
    total = max(1, sum(counts.values()))
    of = [(s, max(-(-n * BUCKET_SHARE // total), -(-n // BUCKET_ROWS))) for s, n in counts.items()]
    buckets = rows.sparkSession.createDataFrame(of, "length bigint, _buckets bigint")  # a row for each length
    dealt = rows.join(F.broadcast(buckets), "length").withColumn("_bucket", F.pmod(F.xxhash64(id_col, "piece", "start", "ids_crc32"), F.col("_buckets"))).drop("_buckets")
    sizes = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("length", "_bucket", F.coalesce(before, F.lit(0)).alias("_first"))
    inner = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(id_col, "piece", "start", "ids_crc32"))
    return dealt.withColumn("_inner", inner).join(firsts, ["length", "_bucket"]).withColumn("rank", F.col("_first") + F.col("_inner") - 1).drop("_bucket", "_inner", "_first")


def pack(docs: DataFrame, json_path: str, ranks_path: str, capacity: int = CAPACITY, end: int = END, groups: int = GROUPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's tokens end with `end`; null and empty texts are that token alone. Documents of more tokens than
    `capacity` are cut, others stay whole. Rows without an id and repeated rows are documents like others, further
    columns are ignored, an empty table has no pieces.

    Texts are encoded once and only the small rows of pieces move. The driver sees the histogram of lengths (`capacity`
    entries) and plans on it; the plan's size follows from the number of lengths and groups, not from the corpus.
    """
    pieces = written(cut_pieces(docs, json_path, ranks_path, capacity, end, id_col, text_col))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(places(plan(counts, capacity, groups)))
    names = [id_col, "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        first, to = np.searchsorted(p["length"], np.arange(capacity + 1)), np.searchsorted(p["length"], np.arange(capacity + 1), "right")
        for b in batches:
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            at = np.empty(len(rank), np.int64)
            for s in np.unique(length).tolist():
                mine = length == s
                at[mine] = first[s] + np.searchsorted(p["rank"][first[s] : to[s]], rank[mine], "right") - 1
            i = rank - p["rank"][at]
            sequence, offset = p["base"][at] + i // p["times"][at], p["start"][at] + i % p["times"][at] * length
            yield pa.RecordBatch.from_arrays([*(b[n] for n in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = T.StructType([pieces.schema[n] for n in names] + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")])
    return ranked(pieces, counts, id_col).select(*names, "rank").mapInArrow(run, schema)
