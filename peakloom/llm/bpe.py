"""Byte-level BPE encoding and decoding in length-bucketed, padded numpy matrices.

Pieces (matches of the split pattern) of a batch that are not known yet are put into matrices by length class. In each
round every row finds its leftmost pair of minimum rank, merges it and is compacted; the ranks of the new neighbours
come from a hash table of pairs. Very long pieces are matrices of one row, which merges all occurrences of its minimum
pair in a round unless the new token takes part in a pair of lower rank: without one no lower rank can arise in
between, so the result is that of single merges.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_columns

NONE = (1 << 31) - 1  # rank of a pair that is not in the vocabulary
LONG_PIECE = 96  # bytes; longer pieces have a matrix of their own
CACHE_PIECES = 150_000  # known pieces of a worker; it then forgets all
MATRIX_CELLS = 1 << 20  # of one padded matrix


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """(token, rank) of a .tiktoken vocabulary file."""
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]


class PairTable:
    """Open addressing over (left id, right id) -> rank of the joined bytes, with vectorised probes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs: dict[int, int] = {}
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = r
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs))
        #: Tokens that form some pair of lower rank than their own.
        self.lowering = frozenset(x for part in (keys >> 32, keys & 0xFFFFFFFF) for x in part[part > values].tolist())
        self.bits = max(4, int(4 * max(1, len(keys))).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        todo, slot, self.probes = np.arange(len(keys)), self._slot(keys), 1
        while len(todo):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[todo[free]]  # of several for one slot, one stays
            mine = self.keys[slot] == keys[todo]
            self.values[slot[mine]] = values[todo[mine]]
            todo, slot = todo[~mine], (slot[~mine] + 1) & ((1 << self.bits) - 1)
            self.probes += bool(len(todo))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = (keys.astype(np.uint64) ^ (keys.astype(np.uint64) >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        out, slot = np.full(len(key), NONE, np.int32), self._slot(key)
        todo = np.arange(len(key))
        for _ in range(self.probes):
            there = self.keys[slot]
            same = there == key[todo]
            out[todo[same]] = self.values[slot[same]]
            more = ~same & (there != -1)
            todo, slot = todo[more], (slot[more] + 1) & ((1 << self.bits) - 1)
            if not len(todo):
                break
        return out


class Codec:
    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str) -> None:
        self.ranks = dict(ranks)
        self.tokens = dict((r, t) for t, r in ranks)
        self.table = PairTable(self.ranks)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(p) > LONG_PIECE:
                out[i] = self._merge_long(p)
            else:
                classes.setdefault((len(p) + 1) // 2, []).append(i)
        for width, of in classes.items():
            step = max(1, MATRIX_CELLS // (2 * width))
            for a in range(0, len(of), step):
                part = of[a : a + step]
                for i, ids in zip(part, self._merge([pieces[i] for i in part])):
                    out[i] = ids
        return out

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        """A row for each piece, padded with -1; a round merges the leftmost pair of minimum rank of every row."""
        size = np.array([len(p) for p in pieces])
        width = int(size.max())
        inside = np.arange(width) < size[:, None]
        m = np.full((len(pieces), width), -1, np.int32)
        m[inside] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((len(pieces), width), NONE, np.int32)  # of the pair that begins here
        pair = inside[:, 1:]
        rank[:, :-1][pair] = self.table.ranks(m[:, :-1][pair], m[:, 1:][pair])
        rows, done = np.arange(len(pieces)), [b""] * len(pieces)
        while True:
            first = rank.argmin(axis=1)
            line = np.arange(len(m))
            least = rank[line, first]
            over = least == NONE
            if over.any():
                left = m[over]
                size = (left >= 0).sum(axis=1) * 4
                flat, end = left[left >= 0].astype("<u4").tobytes(), np.cumsum(size).tolist()
                for r, a, b in zip(rows[over].tolist(), [0, *end], end):
                    done[r] = flat[a:b]
                if over.all():
                    return done
                rows, m, rank, least, first = rows[~over], m[~over], rank[~over], least[~over], first[~over]
                line = line[: len(m)]
            m[line, first] = least
            source = np.arange(m.shape[1])[None, :-1] + (np.arange(m.shape[1] - 1) > first[:, None])
            m, rank = np.take_along_axis(m, source, axis=1), np.take_along_axis(rank, source, axis=1)
            self._renew(m, rank, line, first)
            some = first > 0
            self._renew(m, rank, line[some], first[some] - 1)

    def _renew(self, m: np.ndarray, rank: np.ndarray, line: np.ndarray, at: np.ndarray) -> None:
        """The ranks of the pairs that begin at these places."""
        has = at + 1 < m.shape[1]
        right = m[line, np.minimum(at + 1, m.shape[1] - 1)]
        has &= right >= 0
        new = np.full(len(line), NONE, np.int32)
        new[has] = self.table.ranks(m[line[has], at[has]], right[has])
        rank[line, at] = new

    def _merge_long(self, piece: bytes) -> bytes:
        """A matrix of one row: all occurrences of the minimum pair, unless its token may form a pair of lower rank."""
        m = self.byte[np.frombuffer(piece, np.uint8)]
        rank = np.append(self.table.ranks(m[:-1], m[1:]), NONE)
        while (least := int(rank.min())) != NONE:
            at = np.flatnonzero(rank == least)
            if least in self.table.lowering:
                at = at[:1]
            else:  # of neighbours (as in aaa) every second one from the left
                run = np.concatenate([[0], np.flatnonzero(np.diff(at) != 1) + 1])
                start = np.repeat(at[run], np.diff(np.append(run, len(at))))
                at = at[(at - start) % 2 == 0]
            m[at] = least
            keep = np.ones(len(m), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))
            m, rank = m[keep], rank[keep]
            for x in (at, at[at > 0] - 1):
                inner = x[x + 1 < len(m)]
                rank[x] = NONE
                rank[inner] = self.table.ranks(m[inner], m[inner + 1])
        return m.astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        known, pieces = self.known, [self.find(t) for t in texts]
        if len(known) > CACHE_PIECES:
            known.clear()
        new = list({p for x in pieces for p in x if p not in known})
        known.update(zip(new, self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new])))
        return [b"".join(map(known.__getitem__, x)) for x in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codec: tuple[object, Codec] | None = None


def codec_of(key: str, value, pattern: str) -> Codec:
    """One codec per worker process: building the pair table takes a part of a second."""
    global _codec
    if _codec is None or _codec[0] != key:
        _codec = (key, Codec(value(), pattern))
    return _codec[1]


def encode_decode(docs: DataFrame, ranks: list[tuple[bytes, int]], pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per input row: token count, hash of the ids, hash of the decoded bytes, and the ids if asked for.

    Null and empty texts have no tokens. Repeated rows give repeated results, other columns are ignored. The
    vocabulary (bounded by its file) is broadcast; there is no shuffle, and memory is a slice of rows and the cache.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    key = hashlib.sha256(repr((pattern, len(ranks), hash(tuple(ranks)))).encode()).hexdigest()

    def make():
        codec = codec_of(key, lambda: shared.value, pattern)

        def f(texts):
            ids = codec.encode([t or "" for t in texts])
            got = [[len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(codec.decode(x)).hexdigest() for x in ids]]
            return [*got, [np.frombuffer(x, "<u4").tolist() for x in ids]] if with_ids else got

        return f

    out = [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")] + [("ids", "array<bigint>")] * with_ids
    return map_columns(docs, [id_col], [text_col], out, make)
