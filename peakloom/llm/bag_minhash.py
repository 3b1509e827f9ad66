"""BagMinHash signatures for the weighted Jaccard likeness of multisets of word shingles.

Weights are shingle counts, discretised at the integers. The weight axis of a shingle is cut at 0, 1, 2, 4, 8 ..., and
each cut [low, high) has a Poisson process of rate high - low, seeded by shingle and cut. A point has a time, one of m
signature components, and a place in its cut, found by halving the cut over and over, each half by a bit of its hash;
only points below the shingle's weight count. A component of the signature is the least time of its points. Two
multisets share the point of a component with a chance of their weighted Jaccard likeness. Points are made in order of
time, and a process ends when its time passes the largest component, so few of them are made.
"""

from __future__ import annotations

import math

import numpy as np

from .common import mix

BANDS, ROWS = 25, 5  # a pair of likeness 0.8 shares a band with a chance of 1 - 5e-5
M = BANDS * ROWS
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _processes(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(seed, low, width, weight) of all cuts that a weight reaches into."""
    seeds, lows, widths, tops = [elements], [np.zeros(len(elements))], [np.ones(len(elements))], [weights]
    low, cut = 1, 1
    while (reach := weights > low).any():
        elements, weights = elements[reach], weights[reach]
        seeds.append(mix(elements + np.uint64(cut)))
        lows.append(np.full(len(elements), float(low)))
        widths.append(np.full(len(elements), float(low)))
        tops.append(weights)
        low, cut = 2 * low, cut + 1
    return np.concatenate(seeds), np.concatenate(lows), np.concatenate(widths), np.concatenate(tops)


def signature(elements: np.ndarray, weights: np.ndarray, m: int = M) -> np.ndarray:
    """m least times; elements: distinct 64-bit hashes (one at least), weights: their positive counts."""
    seed, low, width, top = _processes(elements, weights)
    out = np.full(m, np.inf)
    time = np.zeros(len(seed))
    # Enough points at first to fill all components, in most cases; more only of processes that are not over.
    block, done = max(1, math.ceil(m * (math.log(m) + 1) / len(seed))), 0
    while len(seed):
        number = (np.arange(done, done + block, dtype=np.uint64) + np.uint64(1)) * _GOLD
        bits = mix(seed[:, None] ^ number)
        gap = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width[:, None]
        gap[:, 0] += time
        times = np.cumsum(gap, axis=1)
        bits = mix(bits)
        component = (bits >> np.uint64(32)) % np.uint64(m)
        place = low[:, None] + np.floor((bits & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * width[:, None])
        counts = place < top[:, None]
        np.minimum.at(out, component[counts].astype(np.int64), times[counts])
        time = times[:, -1]
        on = time < out.max()
        seed, low, width, top, time = seed[on], low[on], width[on], top[on], time[on]
        done, block = done + block, max(1, min(64, math.ceil(2 * m / max(1, len(seed)))))
    return out


def bands(sig: np.ndarray, count: int = BANDS, rows: int = ROWS) -> list[int]:
    """A signed 64-bit hash of each band, with its number in it."""
    parts = sig[: count * rows].view(np.uint64).reshape(count, rows)
    h = np.arange(1, count + 1, dtype=np.uint64) * _GOLD
    for i in range(rows):
        h = mix(h ^ parts[:, i])
    return h.view(np.int64).tolist()


def multiset_likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of least over sum of largest counts; 0 where both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    both = int(a[1].sum() + b[1].sum()) - least
    return least / both if both else 0.0
