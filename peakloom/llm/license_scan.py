"""Licence scan: matching statistics of each text against a generalised suffix automaton of licence templates.

The automaton is over words. Streaming a text through it gives, at each word, the longest run ending there that occurs
in some template; the suffix-link path from there gives, for every place in every template, the longest run that ends at
both. Such matches of at least `MIN_RUN` words that go no further are chained, template by template, into the chain of
greatest cover: text order and template order both advance, overlaps count once, and no more than `MAX_GAP` words of
text lie between two matches. A chain that covers enough of its template, and of the words that tell its label from all
others, is a span; a span inside another one that covers more words gives way to it. The base phrases are strings of the
same automaton: a phrase stands at a word when its state is on the suffix-link path of the current match.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame

from .common import map_columns, words
from .license_texts import EXPRESSIONS, TEMPLATES

# Base phrases with their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

MIN_RUN = 3  # words of a match that is long enough to chain
MAX_GAP = 6  # words of text between two chained matches
SHORT = 14  # words of a template that must be covered whole and without gaps
MIN_COVER, MIN_TELLING = 0.75, 0.5  # shares of a longer template's words, and of its telling words, that a span covers


class Automaton:
    """Generalised suffix automaton; a state of MIN_RUN words or more knows all (template, end) of its occurrences.

    Strings of `whole` count only where they stand from end to end: like phrases, whose numbers they follow on.
    """

    def __init__(self, strings: list[list[bytes]], phrases: list[list[bytes]], whole: tuple[int, ...] = ()) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.strings = strings
        ends: dict[int, set[tuple[int, int]]] = {}
        only = frozenset(whole)
        for t, s in enumerate([*strings, *phrases]):
            last = 0
            for i, w in enumerate(s):
                last = self._extend(last, w)
                if t < len(strings) and t not in only:
                    ends.setdefault(last, set()).add((t, i + 1))
        for v in sorted(range(1, len(self.len)), key=lambda v: -self.len[v]):  # occurrences pass to shorter suffixes
            if self.len[self.link[v]] >= MIN_RUN:
                ends.setdefault(self.link[v], set()).update(ends.get(v, ()))
        self.ends = [tuple(sorted(ends.get(v, ()))) if self.len[v] >= MIN_RUN else () for v in range(len(self.len))]
        own: dict[int, list[int]] = {}
        standing = [*phrases, *(strings[t] for t in whole)]
        for p, s in enumerate(standing):
            v = 0
            for w in s:
                v = self.next[v][w]
            own.setdefault(v, []).append(p)
        self.phrase_len = [len(s) for s in standing]
        self.whole = whole
        self.phrases: list[tuple[int, ...]] = [()] * len(self.len)  # phrases that are suffixes of a state's longest string
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.phrases[v] = (*own.get(v, ()), *self.phrases[self.link[v]])
        self.vocabulary = frozenset(w for s in [*strings, *phrases] for w in s)

    def _state(self, length: int, moves: dict[bytes, int], link: int) -> int:
        self.len.append(length)
        self.next.append(moves)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, q: int, w: bytes) -> int:
        if self.len[q] == self.len[p] + 1:
            return q
        copy = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:
            return self._split(last, self.next[last][w], w)
        new, p = self._state(self.len[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self._split(p, self.next[p][w], w)
            self.link[new] = q
        return new

    def statistics(self, tokens: list[bytes]):
        """(position, state, length) at each word where the match is two words or longer."""
        vocabulary, nxt, link, length = self.vocabulary, self.next, self.link, self.len
        known = [i for i, w in enumerate(tokens) if w in vocabulary]
        v = n = 0
        before = -2
        for i in known:
            if i != before + 1:
                v = n = 0
            w = tokens[i]
            while v and w not in nxt[v]:
                v = link[v]
                n = length[v]
            v, n = (nxt[v][w], n + 1) if w in nxt[v] else (0, 0)
            before = i
            if n >= 2:
                yield i, v, n

    def ending(self, v: int, n: int, after: bytes | None) -> list[tuple[int, int, int]]:
        """(template, end in it, words) of the matches that end here, as long as they can be, and don't go on with `after`."""
        found, seen = [], set()
        while n >= MIN_RUN:
            for t, e in self.ends[v]:
                if (t, e) not in seen:
                    seen.add((t, e))
                    s = self.strings[t]
                    if e == len(s) or s[e] != after:
                        found.append((t, e, n))
            v = self.link[v]
            n = self.len[v]
        return found


class Template:
    """What chaining needs of a template: its label, and how much of it and of its telling words a span must cover."""

    def __init__(self, label: str, tokens: list[bytes], telling: set[bytes]) -> None:
        self.label, self.size = label, len(tokens)
        self.least = self.size if self.size < SHORT else MIN_COVER * self.size
        self.told = [0]
        for w in tokens:
            self.told.append(self.told[-1] + (w in telling))
        self.gap = 0 if self.size < SHORT else MAX_GAP
        self.least_told = 0 if self.size < SHORT else MIN_TELLING * self.told[-1]


def templates_of(pairs, silent=frozenset(EXPRESSIONS)) -> list[Template]:
    """Telling words of a label stand in no template of another label; the templates of `silent` don't count."""
    labels: dict[bytes, set[str]] = {}
    split = [(label, words(text)) for label, text in pairs]
    for pair, (label, tokens) in zip(pairs, split):
        for w in () if pair in silent else tokens:
            labels.setdefault(w, set()).add(label)
    return [Template(label, tokens, {w for w in tokens if len(labels.get(w, ())) == 1}) for label, tokens in split]


def chains(runs: list[tuple[int, int, int]], told: list[int], gap: int = MAX_GAP) -> list[tuple[int, int, int, int]]:
    """For each run the chain of greatest cover that ends with it: (text start, text end, words covered, telling words).

    runs: (text start, template start, words), sorted. In a chain starts and ends advance both in the text and in the
    template; what a run shares with the one before it counts once. Of equal chains the one that begins last counts.
    """
    out: list[tuple[int, int, int, int]] = []
    near: list[int] = []  # runs that one still to come can follow
    for k, (s, p, n) in enumerate(runs):
        best = (s, s + n, n, told[p + n] - told[p])
        near = [j for j in near if s - (runs[j][0] + runs[j][2]) <= gap]
        for j in near:
            a, b, m = runs[j]
            if a < s and b < p and a + m < s + n and b + m < p + n:
                shared = max(0, a + m - s, b + m - p)
                if shared < n:
                    start, _, covered, telling = out[j]
                    new = (start, s + n, covered + n - shared, telling + told[p + n] - told[p + shared])
                    if (new[2], new[0]) > (best[2], best[0]):
                        best = new
        out.append(best)
        near.append(k)
    return out


def apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (start, end, worth) those that don't overlap and are worth most together; by end."""
    spans = sorted(spans, key=lambda x: (x[1], x[0], x[2]))
    ends = [e for _, e, _ in spans]
    worth, before = [0], []
    for k, (s, _, w) in enumerate(spans):
        before.append(bisect_right(ends, s, 0, k))
        worth.append(max(worth[k], worth[before[k]] + w))
    out, k = [], len(spans)
    while k:
        if worth[k] == worth[k - 1]:
            k -= 1
        else:
            out.append(spans[k - 1])
            k = before[k - 1]
    return out[::-1]


def covered(runs: list[tuple[int, int, int]], t: Template) -> list[tuple[int, int, int]]:
    """Spans (text start, text end, words covered) of one template, apart from each other."""
    return apart([(a, b, n) for a, b, n, told in chains(runs, t.told, t.gap) if n >= t.least and told >= t.least_told])


def outermost(spans: list[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Spans (start, end, covered, label, share) without those inside a kept one that covers more words or has their label."""
    out: list[tuple[int, int, int, str, float]] = []
    open_: list[tuple[int, int, int, str, float]] = []  # spans that reach beyond the present start
    for x in sorted(set(spans), key=lambda x: (x[0], -x[1], -x[2], x[3], -x[4])):
        open_ = [y for y in open_ if y[1] > x[0]]
        if not any(y[1] >= x[1] and (y[2] > x[2] or y[3] == x[3]) for y in open_):
            open_.append(x)
            out.append(x)
    return out


def scan(tokens: list[bytes], a: Automaton, templates: list[Template], base: list[str]) -> tuple:
    starts, found = [], set()
    stands: dict[int, list[tuple[int, int, int]]] = {}
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for i, v, n in a.statistics(tokens):
        for p in a.phrases[v]:
            if a.phrase_len[p] <= n and p < len(base):
                starts.append(i + 1 - a.phrase_len[p])
                found.add(base[p])
            elif a.phrase_len[p] <= n:
                stands.setdefault(a.whole[p - len(base)], []).append((i + 1 - a.phrase_len[p], i + 1, a.phrase_len[p]))
        if n >= MIN_RUN:
            for t, e, m in a.ending(v, n, tokens[i + 1] if i + 1 < len(tokens) else None):
                runs.setdefault(t, []).append((i + 1 - m, e - m, m))
    spans = [(s, e, n, templates[t].label, n / templates[t].size) for t, r in runs.items() for s, e, n in covered(sorted(r), templates[t])]
    spans = outermost(spans + [(s, e, n, templates[t].label, 1.0) for t, r in stands.items() for s, e, n in apart(r)])
    score = max([1.0 if starts else 0.0, *(x[4] for x in spans)])
    return len(tokens), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(found)), ",".join(sorted(found | {x[3] for x in spans})), score, [f"{x}:{s}:{e}" for s, e, _, x, _ in spans]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=BASE_PHRASES) -> DataFrame:
    """One row per input row: word and base-phrase counts, labels, score and the covered template spans (words).

    Null and empty texts have no words, no labels and score 0. Repeated rows give repeated results; other columns are
    ignored. Templates that cover equally much of the same place are all reported. A long text is streamed word by word,
    no shuffle.
    """
    known, base = templates_of(templates), [x for _, x in phrases]
    strings, short = [words(x) for _, x in templates], [words(x) for x, _ in phrases]

    def make():
        a = Automaton(strings, short, tuple(t for t, s in enumerate(strings) if len(s) < SHORT))
        return lambda texts: list(zip(*(scan(words(t), a, known, base) for t in texts), strict=True)) or [[]] * 8

    out = [("n_words", "bigint"), ("n_base", "bigint"), ("first_word", "bigint"), ("last_word", "bigint"), ("base_labels", "string"), ("labels", "string"), ("score", "double"), ("template_spans", "array<string>")]
    return map_columns(docs, [id_col], [text_col], out, make)
