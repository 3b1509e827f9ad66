"""Secret scan with multipart credential linking.

Strong parts (the base kinds) are reported on sight. Weak parts - identifiers (accounts, mail addresses), secrets and
endpoints (addresses of hosts) that mean little alone - are interval-joined inside their scope and reported only when
complementary parts co-occur there: an identifier next to a secret, a weak secret next to an identifier or endpoint, an
endpoint next to a secret. A strong part is a complement too, but for hex that is digits only, which may be any number.

A scope is a block of consecutive non-blank lines. Each part's interval is widened by `reach` characters; the nearest
complementary part whose interval it meets inside the scope is its link. Bare mail addresses and addresses of hosts,
which stand in texts for many reasons, are parts only of a run of keys and values: on one line with their complement,
and no words but joining ones (`JOINING`) between the two. Both sides are sorted by start, so the join
is a bisection per weak part and emits at most one link per weak part and complementary class, never all pairs.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame

from .common import map_columns

# Fixed patterns of the base kinds, in their listed order.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # runs of 18 characters or more; a shorter run fails at each later start too
HEX = re.compile(r"[0-9a-f]{16,}")

WEAK = ("weak_id", "weak_secret", "endpoint", "mail", "address")
BARE = ("mail", "address")  # parts that no key word names
WEAK_ID = re.compile(r"""(?<![A-Za-z0-9])(?:access_?key(?:_?id)?|client_?id|account(?:_?id)?|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""", re.I | re.A)
WEAK_ASSIGN = re.compile(r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase)|pwd|secret|token|credential|signature|private_?key|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=!@#$%^&*-]{6,})""", re.I | re.A)
WEAK_BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}")
MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
ADDRESS = re.compile(r"(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{2,5})?+(?![0-9A-Za-z]|\.[0-9])")
HOST_PORT = re.compile(r"(?<![A-Za-z0-9.@-])[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++:[0-9]{2,5}(?![0-9])")
ENDPOINT = re.compile(r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,20}+://[^\s"'<>]+|(?<![A-Za-z0-9_])(?:host|endpoint|server|url)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.:/_-]{4,})""", re.I | re.A)
BLANK_LINES = re.compile(r"\n[^\S\n]*\n")
ID_WORDS, SECRET_WORDS = ("key", "client", "account", "user", "login"), ("pass", "pwd", "secret", "token", "credential", "signature", "key")

# Words that may stand between a bare part and its complement.
JOINING = "and with at on as for via using port user username login account host server ip pass password passwd pwd email mail key secret token id client db database".split()
_JOINED = re.compile(rf"(?:[^A-Za-z0-9\n]++|(?:{'|'.join(JOINING)})(?![A-Za-z0-9]))*+", re.I | re.A)

REACH = 400  # characters between two parts of one credential
MIN_ENTROPY = 3.5  # bits a character of a bare weak secret


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], BASE.index(x[2]), x[1]))


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) if n else 0.0


def _bare(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in WEAK_BARE.finditer(text):
        s = m[0]
        if any("0" <= c <= "9" for c in s) and any(c.isalpha() for c in s) and entropy(s) >= MIN_ENTROPY:
            out.append((m.start(), m.end(), "weak_secret"))
    return out


def weak_parts(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Weak parts that overlap no base span and no earlier, longer part, by start."""
    low = text.lower()
    found = _bare(text)
    if ":" in text or "=" in text:
        if any(w in low for w in SECRET_WORDS):
            found += [(m.start(), m.end(), "weak_secret") for m in WEAK_ASSIGN.finditer(text)]
        if any(w in low for w in ID_WORDS):
            found += [(m.start(), m.end(), "weak_id") for m in WEAK_ID.finditer(text)]
        if "://" in text or any(w in low for w in ("host", "endpoint", "server", "url")):
            found += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
        if ":" in text:
            found += [(m.start(), m.end(), "endpoint") for m in HOST_PORT.finditer(text)]
    if "@" in text:
        found += [(m.start(), m.end(), "mail") for m in MAIL.finditer(text)]
    found += [(m.start(), m.end(), "address") for m in ADDRESS.finditer(text)]
    if not found:
        return found
    out, j, top = [], 0, 0
    for s, e, kind in sorted(found, key=lambda x: (x[0], -x[1], WEAK.index(x[2]))):
        while j < len(base) and base[j][0] < e:
            top = max(top, base[j][1])
            j += 1
        # base spans are read in order of start, so the largest end so far decides the overlap
        if top <= s and (not out or out[-1][1] <= s):
            out.append((s, e, kind))
    return out


_CLASS = {"assign": "secret", "hex": "secret", "access": "id", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint", "mail": "id", "address": "endpoint"}
_NEEDS = {"weak_id": ("secret",), "weak_secret": ("id", "endpoint"), "endpoint": ("secret",), "mail": ("secret",), "address": ("secret",)}


def fits(text: str, p: tuple[int, int, str], q: tuple[int, int, str]) -> bool:
    """Whether nothing stands between two parts that keeps them from being one credential: only bare parts are choosy."""
    if p[2] not in BARE and q[2] not in BARE:
        return True
    return _JOINED.fullmatch(text, min(p[1], q[1]), max(p[0], q[0], min(p[1], q[1]))) is not None


def link(text: str, base: list[tuple[int, int, str]], weak: list[tuple[int, int, str]], reach: int = REACH) -> list[tuple[tuple, tuple]]:
    """(weak part, its nearest complementary part) for every weak part that has one in its scope and reach.

    Of equally near parts the first counts.
    """
    if not weak:
        return []
    cuts = [m.start() for m in BLANK_LINES.finditer(text)]
    # Bare parts are lists of their own. What keeps the nearest of a list from fitting keeps those beyond it too.
    sides: dict[tuple[str, bool], list[tuple[int, int, str]]] = {(k, bare): [] for k in ("id", "secret", "endpoint") for bare in (False, True)}
    for p in sorted([*base, *weak]):
        if p[2] != "hex" or not text[p[0] : p[1]].isdigit():
            sides[_CLASS[p[2]], p[2] in BARE].append(p)
    starts = {k: [p[0] for p in v] for k, v in sides.items()}
    # The running maximum of ends finds the nearest part that starts before.
    upto: dict[tuple[str, bool], list[int]] = {}
    for k, v in sides.items():
        best, at = [], -1
        for i, p in enumerate(v):
            at = i if at < 0 or p[1] > v[at][1] else at
            best.append(at)
        upto[k] = best
    links = []
    for p in weak:
        for need in _NEEDS[p[2]]:
            near = []
            for side in ((need, False), (need, True)):
                at = bisect_left(starts[side], p[0])
                if at:
                    near.append(sides[side][upto[side][at - 1]])
                if at < len(starts[side]):
                    near.append(sides[side][at])
            near = [q for q in near if max(q[0] - p[1], p[0] - q[1], 0) <= reach and bisect_left(cuts, p[0]) == bisect_left(cuts, q[0]) and fits(text, p, q)]
            if near:
                links.append((p, min(near, key=lambda q: (max(q[0] - p[1], p[0] - q[1], 0), q))))
    return links


def digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(text: str | None) -> tuple:
    text = text or ""
    base = base_spans(text)
    links = link(text, base, weak_parts(text, base))
    added = sorted({p for p, _ in links})
    order = (*BASE, *WEAK)
    both = sorted([*base, *added], key=lambda x: (x[0], order.index(x[2]), x[1]))
    n = Counter(k for _, _, k in base)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(digest(base).encode()).hexdigest(), digest(both), [f"{digest([p])}~{digest([q])}" for p, q in links], len(links)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of base kinds, the digest of base spans, all spans, the links and their number.

    Null and empty texts give zero counts, the hash of the empty string and no spans. Repeated rows give repeated
    results. Columns other than the two named ones are ignored. No shuffle: memory is a slice of rows.
    """
    out = [("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string"), ("links", "array<string>"), ("n_links", "bigint")]
    return map_columns(docs, [id_col], [text_col], out, lambda: lambda texts: list(zip(*map(scan, texts), strict=True)) or [[]] * 7)
