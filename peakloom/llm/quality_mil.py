"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of 64 words. Each passage is encoded from its bytes and words; a gated attention layer,
learned from document labels only, weighs the passages, and the weighted representation is scored. Training runs on the
driver over at most `TRAIN_ROWS` labelled documents, chosen by the hash of their id, and `TRAIN_PASSAGES` passages of
each; scoring maps over whole texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, map_columns, packed, text_of, unpacked

PASSAGE = 64  # words
TRAIN_ROWS = 4000  # labelled documents that a model is fitted on, at most
TRAIN_PASSAGES = 256  # passages of a document that a model is fitted on, at most; scores are of all passages
HIDDEN, ATTENTION = 24, 12
EPOCHS, BATCH, RATE, DECAY = 40, 128, 0.01, 1e-4
THRESHOLD = 0.3

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _classes() -> np.ndarray:
    """A class for each byte: lower, upper, digit, blank, newline, control, from 0x80, and each ASCII sign by itself."""
    of, sign = np.zeros(256, np.int64), 7
    for b in range(256):
        c = chr(b)
        if b >= 128:
            of[b] = 6
        elif c.islower():
            of[b] = 0
        elif c.isupper():
            of[b] = 1
        elif c.isdigit():
            of[b] = 2
        elif c == " ":
            of[b] = 3
        elif c == "\n":
            of[b] = 4
        elif b < 32 or b == 127:
            of[b] = 5
        else:
            of[b], sign = sign, sign + 1
    return of


_CLASS = _classes()
N_CLASSES = int(_CLASS.max()) + 1
N_FEATURES = N_CLASSES + 6


def encode(text: str | None, hashes: WordHashes) -> np.ndarray:
    """A row of features for every passage of the whole text; a text without words is one passage of zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    tokens = raw.split()
    if not tokens:
        return np.zeros((1, N_FEATURES), np.float32)
    b = np.frombuffer(raw, np.uint8)
    space = _SPACE[b]
    starts = ~space
    starts[1:] &= space[:-1]
    n = (len(tokens) - 1) // PASSAGE + 1
    passage = np.maximum(np.cumsum(starts) - 1, 0) // PASSAGE
    counts = np.bincount(passage * N_CLASSES + _CLASS[b], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    size = counts.sum(axis=1, keepdims=True)
    h = hashes.of(tokens)
    padded = np.arange(n * PASSAGE, dtype=np.uint64)  # pads differ from each other
    padded[: len(h)] = h
    rows = np.sort(padded.reshape(n, PASSAGE), axis=1)
    have = np.full(n, PASSAGE)
    have[-1] = len(h) - (n - 1) * PASSAGE
    same = np.zeros(n * PASSAGE, bool)
    same[1 : len(h)] = h[1:] == h[:-1]
    first = b[starts]
    upper = np.bincount(np.arange(len(h)) // PASSAGE, weights=(first >= 65) & (first <= 90), minlength=n)
    repeated = (rows[:, 1:] == rows[:, :-1]).sum(axis=1) / have
    words = np.stack([np.log1p(size[:, 0] / have), repeated, same.reshape(n, PASSAGE).sum(axis=1) / have, upper / have, np.log1p(have), np.full(n, np.log1p(len(h)))], axis=1)
    return np.concatenate([np.sqrt(counts / size), words], axis=1).astype(np.float32)


class Model:
    """h = tanh(x W + b); a = softmax over the bag of u . (tanh(h V) * sigmoid(h G)); score = sigmoid(c . sum a h + d)."""

    def __init__(self, rng: np.random.Generator) -> None:
        s = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float64)
        self.p = {"W": s(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": s(HIDDEN, ATTENTION), "G": s(HIDDEN, ATTENTION), "u": s(ATTENTION), "c": s(HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.prior: float | None = None

    def forward(self, x: np.ndarray, at: np.ndarray) -> dict:
        """x: passages of all bags, one bag after the other; at: where each begins."""
        p = self.p
        of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(x))))
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["G"])))
        e = (t * g) @ p["u"]
        e = np.exp(e - np.maximum.reduceat(e, at)[of])
        a = e / np.add.reduceat(e, at)[of]
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        return {"x": x, "of": of, "h": h, "t": t, "g": g, "a": a, "z": z, "y": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}

    def gradients(self, x: np.ndarray, at: np.ndarray, label: np.ndarray) -> dict:
        p, f = self.p, self.forward(x, at)
        of, h, t, g, a = f["of"], f["h"], f["t"], f["g"], f["a"]
        dy = (f["y"] - label) / len(label)
        dz = dy[:, None] * p["c"]
        da = (dz[of] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, at)[of])
        dt, dg = de[:, None] * p["u"] * g * (1 - t * t), de[:, None] * p["u"] * t * g * (1 - g)
        dh = (a[:, None] * dz[of] + dt @ p["V"].T + dg @ p["G"].T) * (1 - h * h)
        return {"W": f["x"].T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "G": h.T @ dg, "u": (t * g).T @ de, "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> "Model":
        if len(bags) == 0 or labels.min() == labels.max():
            self.prior = float(labels.mean()) if len(bags) else 0.5
            return self
        everything = np.concatenate(bags)
        self.mean, self.scale = everything.mean(axis=0), everything.std(axis=0) + 1e-2
        m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                part = order[i : i + BATCH]
                size = [len(bags[j]) for j in part]
                grad = self.gradients(np.concatenate([bags[j] for j in part]), np.cumsum([0, *size[:-1]]), labels[part])
                step += 1
                for k, v in self.p.items():
                    one, two = m[k]
                    d = grad[k] + DECAY * v
                    one += 0.1 * (d - one)
                    two += 0.001 * (d * d - two)
                    v -= RATE * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, bags: list[np.ndarray]) -> list[float]:
        if not bags:
            return []
        if self.prior is not None:
            return [self.prior] * len(bags)
        size = [len(b) for b in bags]
        return self.forward(np.concatenate(bags), np.cumsum([0, *size[:-1]]))["y"].tolist()


def held_out(id_col: str):
    """Rows whose crc32 of the id as text is divisible by 5 never train a model."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = TRAIN_ROWS, seed: int = 7) -> Model:
    """Fits on labelled documents that are not held out, at most `train_rows`, the first by the hash of their id.

    Rows without an id or a label are left out; of several labels for an id the least counts, and of several documents
    the one of the least text by hash. Of a document of more than TRAIN_PASSAGES passages as many are taken, evenly
    spaced, so what reaches the driver is bounded. Without labels of both kinds the model gives their mean (0.5 if there
    are none).
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(F.col(label_col).cast("double")).alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(train_rows)
    )
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    texts = texts.groupBy("_id", "_label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))

    def make():
        hashes = WordHashes()
        spaced = lambda x: x if len(x) <= TRAIN_PASSAGES else x[np.linspace(0, len(x) - 1, TRAIN_PASSAGES).astype(int)]
        return lambda texts: [[spaced(encode(t, hashes)).ravel().tolist() for t in texts]]

    rows = map_columns(texts, ["_id", "_label"], ["_text"], [("bag", "array<float>")], make).toPandas()
    rows = rows.sort_values("_id", kind="stable")
    bags = [np.asarray(b, np.float32).reshape(-1, N_FEATURES) for b in rows["bag"]]
    rng = np.random.default_rng(seed)
    return Model(rng).fit(bags, rows["_label"].to_numpy(np.float64), rng)


def _scored(docs: DataFrame, model: Model, keep: list[str], text_col: str) -> DataFrame:
    def make():
        hashes = WordHashes()
        return lambda texts: [model.score([encode(t, hashes) for t in texts])]

    return map_columns(docs, keep, [text_col], [("_score", "double")], make)


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: whether its label is held out, the score of the whole text, and the verdict.

    Only the text is an input of the score. Null and empty texts are one empty passage; repeated rows give repeated
    results; other columns are ignored.
    """
    out = _scored(docs, model, [id_col], text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The input's rows and columns whose score reaches the threshold."""
    rows = docs.select(packed(docs), F.col(text_col).alias("text"))
    return unpacked(_scored(rows, model, ["row"], "text").where(F.col("_score") >= threshold))
