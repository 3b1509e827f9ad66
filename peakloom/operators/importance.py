"""Which features explain a target: gradient-boosted importances and rank correlations, a row for each candidate pair."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32


def _packed(entries: DataFrame, name: str) -> DataFrame:
    """(name, obs, value) to one row a name, with the arrays of its places and values."""
    return entries.groupBy(name).agg(F.collect_list(F.struct("at", "value")).alias("e")).select(name, F.col("e.at").alias("at"), F.col("e.value").alias("value"))


def _dense(at, value, n: int) -> np.ndarray:
    out = np.zeros(n)
    out[np.asarray(at, np.int64)] = value
    return out


def _ranks(x: np.ndarray) -> np.ndarray:
    """Average ranks."""
    seen, place, count = np.unique(x, return_inverse=True, return_counts=True)
    return (np.cumsum(count) - (count - 1) / 2)[place]


def spearman(x: np.ndarray, y: np.ndarray) -> float | None:
    a, b = _ranks(x), _ranks(y)
    a, b = a - a.mean(), b - b.mean()
    scale = float(np.sqrt((a * a).sum() * (b * b).sum()))
    return float((a * b).sum() / scale) if scale > 0 else None


def binned(x: np.ndarray) -> np.ndarray:
    """Codes of at most BINS quantile bins; equal values share a bin."""
    edges = np.unique(np.quantile(x, np.arange(1, BINS) / BINS))
    return np.searchsorted(edges, x, side="left").astype(np.int64)


def boosted_gains(codes: np.ndarray, y: np.ndarray, seed: int, trees: int = 500, rate: float = 0.01, depth: int = 3, share: float = 0.9, tried: float = 0.1, window: int = 25) -> np.ndarray:
    """Squared-error gains of each column of codes (rows x columns) in boosted histogram trees, summing to 1, or all 0.

    Each tree sees `share` of the rows and each node `tried` of the columns; boosting stops when the rows a tree has not
    seen gained nothing in the mean over the last `window` trees.
    """
    rows, columns = codes.shape
    gains, rest = np.zeros(columns), y - y.mean() if rows else y
    if not columns or rows < 4 or not np.any(rest):
        return gains
    draw, unseen_gain = np.random.default_rng(seed), []
    k = max(1, round(tried * columns))
    for _ in range(trees):
        used = draw.random(rows) < share
        step, nodes = np.zeros(rows), [np.arange(rows)]
        for level in range(depth + 1):
            below = []
            for node in nodes:
                own = node[used[node]]
                if len(own) == 0:
                    continue
                total = rest[own].sum()
                step[node] = total / len(own)
                if level == depth or len(own) < 2:
                    continue
                cols = draw.choice(columns, k, replace=False)
                flat = (codes[np.ix_(own, cols)] + np.arange(k) * BINS).ravel()
                n = np.bincount(flat, minlength=k * BINS).reshape(k, BINS).cumsum(1)[:, :-1]
                s = np.bincount(flat, np.repeat(rest[own], k), k * BINS).reshape(k, BINS).cumsum(1)[:, :-1]
                right = len(own) - n
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where((n > 0) & (right > 0), s * s / n + (total - s) ** 2 / right - total * total / len(own), 0.0)
                best = int(gain.argmax())
                if gain.flat[best] <= 1e-12:
                    continue
                c, at = divmod(best, BINS - 1)
                gains[cols[c]] += gain.flat[best]
                left = codes[node, cols[c]] <= at
                below += [node[left], node[~left]]
            nodes = below
        out = ~used
        unseen_gain.append(float((rest[out] ** 2).sum() - ((rest[out] - rate * step[out]) ** 2).sum()))
        rest = rest - rate * step
        if len(unseen_gain) >= window and np.mean(unseen_gain[-window:]) <= 0:
            break
    return gains / gains.sum() if gains.sum() > 0 else gains


def importances(pairs: DataFrame, targets: DataFrame, features: DataFrame, obs: DataFrame, blocks: int = 256, near: float = 0.03, **boosting) -> DataFrame:
    """(target, feature, importance, rho, sign, signed): importance of each candidate, and its Spearman correlation.

    pairs (target, feature); targets (target, obs_id, value) and features (feature, obs_id, value), absent is zero, one row
    an entry; obs (obs_id), all observations. sign is 1 or -1 beyond `near`, else 0; signed = importance * rho.
    A null rho (a constant side) has sign 0 and signed null. Repeated pairs count once.

    Targets are dealt to blocks, and a feature's values go once to each block that asks for it, not to each pair. A task
    holds a block's features packed, and one target's candidates dense: observations here are metacells, not cells, so
    both are bounded by metacells x candidates; more blocks make a block smaller.
    """
    place = obs.select("obs_id").distinct().select("obs_id", F.xxhash64("obs_id").alias("_h"))
    # Places are positions within the sorted observations: metacells, which one task may sort.
    order = place.agg(F.transform(F.array_sort(F.collect_list(F.struct("_h", "obs_id"))), lambda x: x["obs_id"]).alias("all"))
    at = order.select(F.posexplode("all").alias("at", "obs_id"))
    n_obs = place.agg(F.count(F.lit(1)).alias("n_obs"))
    packed = _packed(features.join(at, "obs_id"), "feature")
    asked = pairs.select("target", "feature").distinct().withColumn("block", F.pmod(F.xxhash64("target"), F.lit(blocks)).cast("int"))
    wanted = asked.groupBy("block", "target").agg(F.array_sort(F.collect_list("feature")).alias("candidates"))
    left = wanted.join(_packed(targets.join(at, "obs_id"), "target"), "target", "left").join(n_obs).select("block", "target", "candidates", "at", "value", "n_obs")  # n_obs: one row
    right = asked.select(F.col("block").alias("part"), "feature").distinct().join(packed, "feature").select("part", "feature", "at", "value")

    def fit(l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        held = dict(zip(r["feature"], zip(r["at"], r["value"])))
        out = []
        for target, names, where, value, n in zip(l["target"], l["candidates"], l["at"], l["value"], l["n_obs"]):
            y = _dense(where, value, n) if where is not None else np.zeros(n)
            x = [_dense(*held[f], n) if f in held else np.zeros(n) for f in names]
            codes = np.stack([binned(c) for c in x], 1) if n else np.zeros((0, len(x)), np.int64)
            gain = boosted_gains(codes, y, zlib.crc32(str(target).encode()), **boosting)
            out += [(target, f, float(g), spearman(c, y) if n else None) for f, g, c in zip(names, gain, x)]
        return pd.DataFrame(out, columns=["target", "feature", "importance", "rho"])

    kind = {f.name: f.dataType.simpleString() for f in pairs.schema}
    got = left.groupBy("block").cogroup(right.groupBy("part")).applyInPandas(fit, f"target {kind['target']}, feature {kind['feature']}, importance double, rho double")
    got = got.withColumn("rho", F.when(~F.isnan("rho"), F.col("rho")))
    sign = F.when(F.col("rho") > near, 1).when(F.col("rho") < -near, -1).otherwise(0)
    return got.select("*", sign.alias("sign"), (F.col("importance") * F.col("rho")).alias("signed"))
