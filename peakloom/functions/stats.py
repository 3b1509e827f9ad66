"""Scalar statistics: normal tail and quantile, binomial tail, detection floors, effect sizes."""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def norm_sf(z) -> Column:
    """P(Z > z) from expressions alone: the series of erf near 0, the continued fraction of erfc beyond; null for NaN."""
    z = F.col(z) if isinstance(z, str) else z
    x = F.abs(z) / math.sqrt(2)
    down = lambda n: F.sequence(F.lit(n), F.lit(1))
    series = F.aggregate(down(60), F.lit(1.0), lambda a, k: 1 + a * 2 * x * x / (2 * k + 1))
    erf = 2 / math.sqrt(math.pi) * x * F.exp(-x * x) * series
    fraction = F.aggregate(down(80), x, lambda a, k: x + k / 2 / a)
    upper = F.when(x < 2, 1 - erf).otherwise(F.exp(-x * x) / (fraction * math.sqrt(math.pi))) / 2
    return F.when(~F.isnan(z), F.when(z < 0, 1 - upper).otherwise(upper))


def student_p(t: Column, df: Column) -> Column:
    """Two-sided p of Student's t for whole degrees of freedom from 1: the finite sums over powers of the cosine."""
    theta = F.atan(F.abs(t) / F.sqrt(df))
    c2, odd = F.cos(theta) * F.cos(theta), df % 2
    steps = F.floor((df - 2 - odd) / 2).cast("int")  # of the sum after its first term
    ratio = lambda k: F.when(odd == 1, 2 * k / (2 * k + 1)).otherwise((2 * k - 1) / (2 * k))
    total = F.when(steps >= 1, F.aggregate(F.sequence(steps, F.lit(1)), F.lit(1.0), lambda a, k: 1 + a * c2 * ratio(k))).otherwise(1.0)
    one = F.when(df == 1, 2 * theta / math.pi).when(odd == 1, 2 / math.pi * (theta + F.sin(theta) * F.cos(theta) * total)).otherwise(F.sin(theta) * total)
    return F.greatest(F.lit(0.0), 1 - one)


@F.pandas_udf(T.DoubleType())
def binomial_tail(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    """P(X >= k) of a binomial, summed in logarithms."""

    def one(k, n, p):
        if k <= 0:
            return 1.0
        term = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        return min(1.0, math.fsum(math.exp(term(i)) for i in range(int(k), int(n) + 1)))

    return pd.Series([one(*x) for x in zip(k, n, p)])


def detectable_rho(n: Column, alpha: float = 0.05, power: float = 0.8) -> Column:
    """tanh((z of 1 - alpha / 2 + z of power) / sqrt(n - 3)); null for n <= 3."""
    z = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    return F.when(n > 3, F.tanh(F.lit(z) / F.sqrt(n - 3)))


def histogram10(x: Column) -> Column:
    """Bin 0..9 of a fraction, the last one closed."""
    return F.least(F.floor(x * 10), F.lit(9)).cast("int")
