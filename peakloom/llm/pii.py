"""Personal data: candidate spans, gradient-boosted trees over their format and context, calibrated thresholds.

Everything on the main path is DataFrame expressions. Generators propose overlapping spans, positions are running sums
of the lengths of matches and of the pieces between them, features are expressions over a span and its surroundings, and
the trees - fitted by `boost` on annotated passages - are compiled to one nested CASE expression. Their margins become
probabilities by a scale that is fitted on passages of other sentences, where each generator also gets its threshold.
Base spans always stay; an added span stays if its probability reaches the threshold, it meets no base span, and no
better candidate is in its cluster of overlapping ones. Running sums and maxima go block by block, so a text takes time
in proportion to its length and number of spans.

Patterns are possessive and anchored at run starts, so long runs of digits or letters take linear time and no stack.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of
from .pii_passages import passages

# Base kinds in their listed order. Each pattern finds the same spans as the plain one in the comment, given the later filter.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ : a match begins where a run does, or where the last one ended
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ : 16 digits or more
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "phone": "+"}  # without it a text has no match

# Generators of added spans: high recall, overlapping.
GENERATORS = {
    "contact": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]++\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z]{2,10}+",
    "number": r"(?<![0-9A-Za-z+.])\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,18}+(?![0-9A-Za-z])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "street": r"(?<![0-9A-Za-z])[0-9]{1,4}\x20(?:[A-Z][a-z]++\x20){1,2}(?:Street|Road|Avenue|Lane|Drive|Court)(?![A-Za-z])",
    "document": r"(?<![0-9A-Za-z])[A-Z][0-9]{7,9}+(?![0-9A-Za-z])",
    "national": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local": r"(?<![0-9])\(?[0-9]{3}\)?[\x20./-]{1,2}[0-9]{3}[\x20./-][0-9]{4}(?![0-9])",
}
GUARDS = {"contact": r"(?i)\(at\)|\[at\]|\x20at\x20", "street": r"\x20(?:Street|Road|Avenue|Lane|Drive|Court)(?![A-Za-z])"}
BEFORE, AFTER = 24, 8  # code points of context, as far as to the match before or after
TREES, DEPTH, RATE, PASSAGES, PRECISION = 24, 4, 0.3, 1200, 0.95
BLOCK = 64  # elements of an array whose running value is found one by one
_FAR = (1 << 31) - 1

# Expressions are SQL text: thousands of nodes are parsed at once.


def _let(value: str, name: str, body: str) -> str:
    """body with `name` for a value that is worked out once, however often body uses it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(values: str, start: int, fold: str) -> str:
    """For each of an array of ints what `fold` (of acc and x) makes of all before it; start is neutral to it. Block by block, so
    that the steps don't grow with the square of the array's size."""
    upto = lambda a, i, first: f"aggregate(slice({a}, 1, {i}), {first}, (acc, x) -> {fold})"
    cut = f"transform(sequence(0, int((size(v_) - 1) div {BLOCK})), b_ -> slice(v_, b_ * {BLOCK} + 1, {BLOCK}))"
    heads = _let(f"transform(k_, b_ -> aggregate(b_, {start}, (acc, x) -> {fold}))", "t_", f"transform(t_, (y_, i_) -> {upto('t_', 'i_', start)})")
    inside = f"flatten(zip_with(k_, {heads}, (b_, h_) -> transform(b_, (y_, i_) -> {upto('b_', 'i_', 'h_')})))"
    return _let(values, "v_", f"if(size(v_) > 0, {_let(cut, 'k_', inside)}, array())")


def _luhn(m: str) -> str:
    """Whether the digits of m pass Luhn's check."""
    twice = "(d_, i_) -> if(i_ % 2 = 0, int(d_), int(d_) * 2 % 10 + int(d_) * 2 div 10)"
    return f"aggregate(transform(filter(split(reverse(regexp_replace({m}, '[^0-9]', '')), ''), d_ -> d_ <> ''), {twice}), 0L, (acc, x) -> acc + x) % 10 = 0"


_DIGITS = "length(regexp_replace(x.m, '[^0-9]', ''))"
VALID = {
    "ip": "forall(split(x.m, r'\\.'), p_ -> length(ltrim('0', p_)) <= 3 and int(concat('0', substring(ltrim('0', p_), 1, 3))) <= 255)",
    "card": f"{_DIGITS} between 16 and 19 and {_luhn('x.m')}",
    "phone": f"{_DIGITS} between 8 and 15",
}


def _spans(text: str, pattern: str, kind: str, when: str | None = None) -> str:
    """Matches as an array of (s, e, kind, m, before, after), by start, in code points.

    The pieces between matches and the matches themselves alternate, so the running sum of their lengths gives places.
    """
    p = f"r'{pattern}'"
    steps = "zip_with(a_.m, slice(a_.gap, 1, size(a_.m)), (m_, g_) -> length(m_) + length(g_))"
    start = "at_[j_] + length(a_.gap[j_])"
    one = f"struct({start} as s, {start} + length(m_) as e, '{kind}' as kind, m_ as m, right(a_.gap[j_], {BEFORE}) as before, left(a_.gap[j_ + 1], {AFTER}) as after)"
    place = _let(_running(steps, 0, "acc + x"), "at_", f"transform(a_.m, (m_, j_) -> {one})")
    found = _let(f"struct(regexp_extract_all({text}, {p}, 0) as m, split({text}, {p}, -1) as gap)", "a_", place)
    return f"coalesce(if({when or f'{text} rlike {p}'}, {found}, null), array())"


#: Words that stand before personal data or other numbers, by the kind of data.
CONTEXT = {"call": "phone|call|tel|mobile|cell|fax|ring|text|reach", "pay": "card|visa|pay|credit|debit|cost|total|budget", "id": "ssn|social|passport|tax|license no|national|citizen|patient", "bank": "iban|account|bank|transfer|acct", "mail": "mail|write|contact|try", "other": "order|invoice|version|page|isbn|ref|part|serial|build|ticket|receipt|case|score|track", "live": "live|address|ship|deliver|moved|grew"}


def _left_out(p: str) -> str:
    return f"length(x.m) - length(regexp_replace(x.m, r'{p}', ''))"


def _group(p: str) -> str:
    return f"length(regexp_extract(x.m, r'{p}', 1))"


#: Features of a span x: its format, then its generator, then the words before it.
FEATURES = {
    "length": "length(x.m)",
    "digits": _DIGITS,
    "share": f"{_DIGITS} / length(x.m)",
    "groups": "size(split(x.m, '[^0-9A-Za-z]+'))",
    "first": _group("^[^0-9]*([0-9]+)"),
    "last": _group("([0-9]+)[^0-9]*$"),
    "widest": "case when x.m rlike '[0-9]{7}' then 7 when x.m rlike '[0-9]{5}' then 5 when x.m rlike '[0-9]{4}' then 4 else 0 end",
    "parens": _left_out("[()]"),
    "dots": _left_out(r"\."),
    "slashes": _left_out("/"),
    "dashes": _left_out("-"),
    "blanks": _left_out(r"\x20"),
    "brackets": _left_out(r"[\[\]]"),
    "luhn": f"int({_luhn('x.m')})",
    "upper": _left_out("[A-Z]"),
    "zero": r"int(x.m rlike r'^\(?0')",
    "date": "int(x.m rlike '^(?:(?:19|20)[0-9]{2}[-/.][01]?[0-9][-/.][0-3]?[0-9]|[0-3]?[0-9][-/.][0-3]?[0-9][-/.](?:19|20)[0-9]{2})')",
    "year": "int(x.m rlike '^(?:18|19|20)[0-9]{2}[^0-9]')",
    "tail": r"int(x.after rlike r'^[\x20]?[%$€£]|^[\x20](?:mm|cm|kg|km|usd|eur|USD|EUR|items|hectares|points)')",
    "goes_on": r"int(x.after rlike r'^\x20[a-z]')",
    "capital": r"int(x.m rlike r'\.\x20[A-Z]')",  # what looks like an ending is the next sentence
    "ending": rf"greatest({_group(r'\.\x20?([A-Za-z]+)$')}, {_group(r'dot[)\]]?\x20?([A-Za-z]+)$')})",
    **{f"is_{k}": f"int(x.kind = '{k}')" for k in GENERATORS},
    **{k: f"int(lower(x.before) rlike '{p}')" for k, p in CONTEXT.items()},
}


def candidates(text: str) -> str:
    """All spans of all generators. What `national` and `local` find lies in or beside what `number` finds."""
    spans = lambda k, when=None: _spans(text, GENERATORS[k], k, f"{text} rlike r'{GUARDS[k]}'" if k in GUARDS else when)
    more = f"concat(n_, {spans('national', 'size(n_) > 0')}, {spans('local', 'size(n_) > 0')})"
    return f"concat({', '.join(spans(k) for k in ('contact', 'account', 'street', 'document'))}, {_let(spans('number'), 'n_', more)})"


def _clear(found: str, base: str) -> str:
    """Spans of found, by start, that meet none of base: the base before ends by then, the base after begins no sooner."""
    both = f"array_sort(concat(transform({found}, x -> struct(x.s as s, x.e as e, 0 as b, x as x)), transform({base}, x -> struct(x.s as s, x.e as e, 1 as b, cast(null as struct<s:int,e:int,kind:string,m:string,before:string,after:string>) as x))))"
    reach = _running("transform(a_, y -> if(y.b = 1, y.e, 0))", 0, "greatest(acc, x)")
    next_ = f"reverse({_running(f'reverse(transform(a_, y -> if(y.b = 1, y.s, {_FAR})))', _FAR, 'least(acc, x)')})"
    free = _let(f"struct({reach} as r, {next_} as n)", "g_", "filter(transform(a_, (y, i) -> if(y.b = 0 and g_.r[i] <= y.s and g_.n[i] >= y.e, y.x, null)), y -> y is not null)")
    return f"if(size({found}) > 0 and size({base}) > 0, {_let(both, 'a_', free)}, array_sort({found}))"


def _best(found: str) -> str:
    """Of each cluster of overlapping spans (s, e, kind, score) the one that scores most; the first, longest of equals."""
    new = _let(_running("transform(a_, y -> y.e)", 0, "greatest(acc, x)"), "r_", "transform(a_, (y, i) -> if(r_[i] <= y.s, 1, 0))")
    number = _let(_running("n_", 0, "acc + x"), "c_", "array_sort(transform(a_, (y, i) -> struct(c_[i] + n_[i] as c, -y.score as score, y.s as s, -y.e as e, y.kind as kind)))")
    first = "filter(z_, (y, i) -> i = 0 or z_[greatest(i - 1, 0)].c <> y.c)"
    best = _let(_let(_let(f"array_sort({found})", "a_", _let(new, "n_", number)), "z_", first), "w_", "array_sort(transform(w_, y -> struct(y.kind as kind, y.s as s, -y.e as e, round(-y.score, 6) as score)))")
    return f"if(size({found}) > 0, {best}, cast(array() as array<struct<kind:string,s:int,e:int,score:double>>))"


# --- training ---------------------------------------------------------------------------------------------------


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> tuple[float, list]:
    """(bias, trees): logistic gradient boosting, splits at 32 quantiles of a feature's values at most.

    A tree is a leaf value or (feature, cut, low, high).
    """
    bias = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    score, out = np.full(len(y), bias), []
    cuts = []
    for f in range(x.shape[1]):
        v = np.unique(x[:, f])
        mid = (v[1:] + v[:-1]) / 2
        cuts.append(mid[np.unique(np.linspace(0, len(mid) - 1, min(32, len(mid))).astype(int))] if len(mid) else mid)
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int):
        leaf = round(float(rate * g[rows].sum() / (h[rows].sum() + 1.0)), 6)
        if level == 0 or len(rows) < 20:
            return leaf
        best = (1e-6, None, None)
        gs, hs = g[rows].sum(), h[rows].sum()
        for f, c in enumerate(cuts):
            if len(c):
                b = bins[f][rows]
                low_g, low_h, low_n = (np.cumsum(np.bincount(b, w, len(c) + 1))[:-1] for w in (g[rows], h[rows], None))
                gain = low_g**2 / (low_h + 1.0) + (gs - low_g) ** 2 / (hs - low_h + 1.0) - gs**2 / (hs + 1.0)
                gain[(low_n < 5) | (len(rows) - low_n < 5)] = 0
                if gain.max() > best[0]:
                    best = (float(gain.max()), f, int(gain.argmax()))
        if best[1] is None:
            return leaf
        low = bins[best[1]][rows] <= best[2]
        return best[1], float(cuts[best[1]][best[2]]), grow(rows[low], g, h, level - 1), grow(rows[~low], g, h, level - 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = grow(np.arange(len(y)), y - p, p * (1 - p), depth)
        out.append(tree)
        score = score + np.array([value(tree, row) for row in x])
    return bias, out


def value(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree


def _compiled(tree, names: list[str]) -> str:
    if not isinstance(tree, tuple):
        return f"{float(tree)!r}D"
    return f"case when f_.{names[tree[0]]} < {tree[1]!r}D then {_compiled(tree[2], names)} else {_compiled(tree[3], names)} end"


def _given() -> str:
    return ", ".join(f"double({v}) as {k}" for k, v in FEATURES.items())


def _scored(spans: str, fitted) -> str:
    """(s, e, kind, score) of each span of the array; the score is a calibrated probability."""
    (bias, trees), (slope, shift), _ = fitted
    margin = " + ".join([f"{bias!r}D", *(f"({_compiled(t, list(FEATURES))})" for t in trees)])
    return f"transform({spans}, x -> struct(x.s as s, x.e as e, x.kind as kind, 1 / (1 + exp(-({slope!r}D * {_let(f'struct({_given()})', 'f_', margin)} + {shift!r}D))) as score))"


def _labelled(spark: SparkSession, which: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(features, labels, kinds) of the candidates of n passages.

    A candidate is personal data if it shares nine tenths of what it and an annotated span cover together.
    """
    made = passages(which, n, seed)
    rows = spark.createDataFrame([(i, t) for i, t, _ in made], "i int, t string")
    each = rows.select("i", F.explode(F.expr(candidates("t"))).alias("x"))
    got = each.select("i", "x.s", "x.e", "x.kind", F.expr(f"array({', '.join(f'double({v})' for v in FEATURES.values())})").alias("f")).orderBy("i", "s", "e", "kind").collect()
    spans = {i: x for i, _, x in made}
    y = [float(any(_alike(r, a, b) for a, b in spans[r["i"]])) for r in got]
    return np.array([r["f"] for r in got]), np.array(y), [r["kind"] for r in got]


def _alike(x, a: int, b: int) -> bool:
    return min(x["e"], b) - max(x["s"], a) >= 0.9 * (max(x["e"], b) - min(x["s"], a))


def _margins(model, x: np.ndarray) -> np.ndarray:
    return np.array([model[0] + sum(value(t, row) for t in model[1]) for row in x])


def calibrate(margin: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """(slope, shift) of the likeliest logistic curve from margins to probabilities, drawn a little towards (1, 0)."""
    prior = np.array([1.0, 0.0])
    w, x = prior.copy(), np.stack([margin, np.ones(len(margin))], axis=1)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))  # no certainty from few rows
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (p - target) + w - prior)
        w = w - np.clip(step, -0.5, 0.5)
        if np.abs(step).max() < 1e-9:
            break
    return float(round(w[0], 6)), float(round(w[1], 6))


_FITTED: dict[tuple, tuple] = {}


def fit(spark: SparkSession, n: int = PASSAGES, seed: int = 11) -> tuple[tuple, tuple[float, float], dict[str, float]]:
    """(trees, scale, threshold of each generator). The first set of passages fits the trees; on the second, of other
    sentences, margins are scaled to probabilities, and each generator gets the least threshold (a half at least) from
    which on its precision is PRECISION. The passages are few and generated: they do not depend on the corpus."""
    if (n, seed) not in _FITTED:
        x, y, _ = _labelled(spark, 0, n, seed)
        model = boost(x, y)
        x, y, kinds = _labelled(spark, 1, n, seed)
        scale = calibrate(_margins(model, x), y)
        p, kind = 1 / (1 + np.exp(-(scale[0] * _margins(model, x) + scale[1]))), np.array(kinds)
        thresholds = {}
        for k in GENERATORS:
            s, label = p[kind == k], y[kind == k]
            good = [c for c in np.unique(s) if label[s >= c].mean() >= PRECISION]
            thresholds[k] = float(max(0.5, min(good) - 1e-9)) if good else 2.0
        _FITTED[n, seed] = (model, scale, thresholds)
    return _FITTED[n, seed]


# --- the operator -----------------------------------------------------------------------------------------------


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of base kinds, the digest of base spans, all spans, and the added spans with scores.

    Null and empty texts have no spans. Repeated rows give repeated results; equal scores go to the earlier, longer span;
    other columns are ignored. No shuffle.
    """
    fitted = fit(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t"))
    found = {}
    for k, p in BASE.items():
        spans = _spans("_t", p, k, f"contains(_t, '{NEEDS[k]}')" if k in NEEDS else None)
        spans = f"filter({spans}, x -> {VALID[k]})" if k in VALID else spans
        found[f"_{k}"] = F.expr(f"transform({spans}, x -> struct(x.s as s, x.e as e, x.kind as kind))")
    out = out.withColumns(found | {"_more": F.expr(candidates("_t"))})
    out = out.withColumn("_base", F.concat(*(f"_{k}" for k in BASE)))
    out = out.withColumn("_more", F.expr(f"if(size(_more) > 0, {_let('struct(_more as c, _base as b)', 'q_', _clear('q_.c', 'q_.b'))}, _more)"))
    enough = " or ".join(f"x.kind = '{k}' and x.score >= {c!r}D" for k, c in fitted[2].items())
    out = out.withColumn("_more", F.expr(_let(f"filter({_scored('_more', fitted)}, x -> {enough})", "o_", _best("o_"))))
    base, more = (F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])) for c in ("_base", "_more"))
    return out.select(
        F.col("_id").alias(id_col),
        *(F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in BASE),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, more), ",").alias("spans"),
        F.size("_more").cast("bigint").alias("n_added"),
        F.col("_more").alias("added"),
    )


def quality(spark: SparkSession, n: int = PASSAGES, seed: int = 11) -> tuple[float, float]:
    """(precision, recall) of the added spans on the third set of passages, whose sentences the model has not seen.

    A span is right if it shares nine tenths with an annotated one; an annotated span that no generator proposes is lost.
    """
    made = passages(2, n, seed)
    rows = {r["doc_id"]: r["added"] for r in find_pii(spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id int, text string")).select("doc_id", "added").collect()}
    right = sum(any(_alike(x, a, b) for a, b in spans) for i, _, spans in made for x in rows[i])
    caught = sum(any(_alike(x, a, b) for x in rows[i]) for i, _, spans in made for a, b in spans)
    return right / max(1, sum(map(len, rows.values()))), caught / max(1, sum(len(spans) for _, _, spans in made))
