"""Token ids of whole texts from the ids of their chunks, for vocabularies whose tokens never span a blank before a word.

A chunk begins at a blank (U+0020) between two characters that are no white space. Tokens of such vocabularies hold a
blank at their beginning only, and the split patterns before their merges cut there too, so a text's ids are those of
its chunks in a row. Most chunks of a corpus are known ones: a lookup each. What is not known goes to the tokenizer's
own library; chunks that begin or end with other white space are never kept.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from .bpe import read_ranks

CACHE_CHUNKS = 700_000  # known chunks of a worker; it then forgets all
_cut = re.compile(r"(?<=\S)(?= \S)").split


class ChunkCoder:
    """make(chunks) -> the ids of each chunk, a list of ints; several vocabularies share one split of a text.

    tokens: the bytes of each vocabulary's ids, where it is to be known which texts are the joined bytes of their tokens.
    """

    def __init__(self, *makes: Callable[[list[str]], list[list[int]]], tokens: list[list[bytes]] | None = None) -> None:
        self.makes, self.tokens = makes, tokens
        self.known: list[dict[str, bytes]] = [{} for _ in makes]  # of chunks without their blank
        self.unsound: set[str] = set()  # known chunks that are not the joined bytes of their tokens

    def _ids(self, chunks: list[str]) -> list[list[bytes]]:
        """The ids of each chunk by each vocabulary, as little-endian unsigned 32-bit integers."""
        return [[array("I", x).tobytes() for x in make(chunks)] for make in self.makes]

    def joined(self, number: int, ids: bytes) -> bytes:
        return b"".join(map(self.tokens[number].__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _learn(self, split: list[list[str]]) -> set[str]:
        """Makes the chunks known; those are returned that begin or end with white space, which never are."""
        if len(self.known[0]) > CACHE_CHUNKS:
            for k in self.known:
                k.clear()
            self.unsound.clear()
        known = self.known[0]
        new = {p for x in split for p in x if p not in known}
        odd = {p for p in new if not p or p[0].isspace() or p[-1].isspace()}
        new = list(new - odd)
        got = self._ids([" " + p for p in new])
        for k, ids in zip(self.known, got):
            k.update(zip(new, ids))
        if self.tokens:
            for number, ids in enumerate(got):
                self.unsound.update(p for p, x in zip(new, ids) if self.joined(number, x) != (" " + p).encode("utf-8", "surrogatepass"))
        return odd

    def encode_all(self, texts: list[str], after_blank: bool) -> tuple[list[list[bytes]], list[bool]]:
        """The ids of each text by each vocabulary, and whether it is surely the joined bytes of its tokens (False: it has
        to be looked at); after_blank: of a blank and the text."""
        split = [t.split(" ") for t in texts]
        heads = [None if after_blank else parts.pop(0) for parts in split]
        odd = self._learn(split)
        out: list[list[bytes]] = [[b""] * len(texts) for _ in self.makes]
        sure, first = [False] * len(texts), []
        for i, (head, parts) in enumerate(zip(heads, split)):
            if (odd and not odd.isdisjoint(parts)) or (head is not None and (not head or head[0].isspace() or head[-1].isspace())):
                for o, ids in zip(out, self._slow(" " + texts[i] if after_blank else texts[i])):
                    o[i] = ids
                continue
            for o, known in zip(out, self.known):
                o[i] = b"".join(map(known.__getitem__, parts))
            sure[i] = head is None and (not self.unsound or self.unsound.isdisjoint(parts))
            if head is not None:
                first.append(i)
        for o, of in zip(out, self._ids([heads[i] for i in first])):
            for i, ids in zip(first, of):
                o[i] = ids + o[i]
        return out, sure

    def encode(self, texts: list[str], after_blank: bool) -> list[bytes]:
        """The ids of each text by the first vocabulary."""
        return self.encode_all(texts, after_blank)[0][0]

    def _slow(self, text: str) -> list[bytes]:
        chunks = [c for c in _cut(text) if c]
        new = [c for c in dict.fromkeys(chunks) if not (c[0] == " " and c[1:] in self.known[0])]
        of = [dict(zip(new, ids)) for ids in self._ids(new)]
        return [b"".join(made[c] if c in made else known[c[1:]] for c in chunks) for made, known in zip(of, self.known)]


#: Letters and signs below this place have had their class since Unicode began, so that both libraries split them alike.
_SETTLED = "ɐ"


def byte_bpe(json_path: str, ranks_path: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids by the vocabulary of json_path, strings of special tokens being plain text.

    ranks_path: the same vocabulary as ranks, by which the quicker library encodes chunks of settled characters; the
    others are encoded by the file's own library.
    """
    import public_tokenizers

    own = Tokenizer.from_file(json_path)
    own.encode_special_tokens = True
    quick = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(read_ranks(ranks_path)), special_tokens={})

    def make(chunks: list[str]) -> list[list[int]]:
        out = [quick.encode_ordinary(c) if c.isascii() or max(c) < _SETTLED else None for c in chunks]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, own.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    return make


def pieces(model_path: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids by a sentencepiece model that adds a blank before what it is given: a chunk's own is taken off first.

    Refuses a model whose pieces hold a blank after another character, for it could not be encoded chunk by chunk.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    if any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(len(model))):
        raise ValueError(f"{model_path}: pieces go on after a blank")
    return lambda chunks: model.encode([c[1:] for c in chunks], num_threads=1)


_made: dict[tuple, object] = {}


def once(key: tuple, make: Callable[[], object]):
    """One object per worker process and key: vocabularies take a part of a second to load."""
    if key not in _made:
        _made[key] = make()
    return _made[key]
