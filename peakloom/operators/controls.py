"""Controls: pairs matched on a covariate, and nulls from decoy features."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats


def components_by_gap(df: DataFrame, tol: float, window: int) -> DataFrame:
    """df (stratum, x, is_dropped, ...) with `part`: rows of different parts can't be matched within tol, relatively.

    Values fall in buckets that are tol wide; where a bucket is empty, no dropped row on one side is within tol of a kept
    one on the other. A dropped row that is not positive takes any of its neighbours, so the least of the kept ones,
    `window` of them, stay in its part. Only buckets are sorted, never rows.
    """
    bucket = F.when(F.col("x") > 0, F.floor(F.log("x") / -(F.log(F.lit(1 - tol)) * (1 + 1e-9)))).cast("bigint")
    rows = df.withColumn("_b", bucket)
    low = rows.where(~F.col("is_dropped") & F.col("_b").isNotNull()).withColumn("_k", F.row_number().over(Window.partitionBy("stratum").orderBy("x"))).where(F.col("_k") <= window)
    free = rows.where(F.col("is_dropped") & F.col("_b").isNull()).select("stratum").distinct()
    reach = low.join(free, "stratum", "left_semi").groupBy("stratum").agg(F.max("_b").alias("_reach"))
    seen = rows.where(F.col("_b").isNotNull()).select("stratum", "_b").distinct().join(reach, "stratum", "left")
    up = Window.partitionBy("stratum").orderBy("_b")
    cut = (F.col("_b") - F.lag("_b").over(up) > 1) & F.coalesce(F.col("_b") > F.col("_reach"), F.lit(True))
    parts = seen.withColumn("_cut", F.coalesce(cut, F.lit(False)).cast("int")).select("stratum", "_b", F.sum("_cut").over(up).alias("part"))
    # What is not positive goes with the least positive values: part 0.
    return rows.join(parts, ["stratum", "_b"], "left").withColumn("part", F.coalesce("part", F.lit(0))).drop("_b")


def greedy_pairs(df: DataFrame, tol: float = 0.02, window: int = 40) -> DataFrame:
    """(stratum, dropped, kept): one-to-one matches on a covariate, without replacement; df: (stratum, id, x, is_dropped).

    Dropped rows come in the order of their id's md5; each takes the nearest unused kept row among `window` sorted
    neighbours on either side, if their difference is at most tol times its own x (any, where that is not positive).
    Sequential by nature, but only among rows that gaps of x don't part: such a part of a stratum is one task and holds
    two numbers a row. Rows with a null or NaN x take no part.
    """
    ids = df.schema["id"].dataType.simpleString()
    ready = df.where(F.col("x").isNotNull() & ~F.isnan("x")).select("stratum", "id", F.col("x").cast("double").alias("x"), "is_dropped", F.md5(F.col("id").cast("string")).alias("h"))

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        kept = pdf[~pdf["is_dropped"]].sort_values(["x", "id"])
        lost = pdf[pdf["is_dropped"]].sort_values(["h", "id"])
        at, free = kept["x"].to_numpy(), np.ones(len(kept), bool)
        pairs = []
        for i, x, k in zip(lost["id"], lost["x"], np.searchsorted(at, lost["x"].to_numpy())):
            low, high = max(0, k - window), min(len(at), k + window)
            far = np.where(free[low:high], np.abs(at[low:high] - x), np.inf)
            if not len(far) or np.isinf(best := far.min()) or (x > 0 and best > tol * x):
                continue
            chosen = low + int(far.argmin())
            free[chosen] = False
            pairs.append((pdf["stratum"].iloc[0], i, kept["id"].iloc[chosen]))
        return pd.DataFrame(pairs, columns=["stratum", "dropped", "kept"])

    kind = df.schema["stratum"].dataType.simpleString()
    return components_by_gap(ready, tol, window).groupBy("stratum", "part").applyInPandas(match, f"stratum {kind}, dropped {ids}, kept {ids}")


def matched_effect(df: DataFrame, tol: float = 0.02, window: int = 40, least: int = 200) -> DataFrame:
    """(stratum, n_pairs, effect, z, x_ratio) of strata with `least` matched pairs: the rank effect of dropped against kept
    on y, and the ratio of their medians of x, which shows how well they match; df: (stratum, id, x, is_dropped, y)."""
    pairs = greedy_pairs(df.drop("y"), tol, window)
    own = df.select("stratum", "id", F.col("x").cast("double").alias("cov"), F.col("y").cast("double").alias("y"))
    side = lambda c, dropped: pairs.select("stratum", F.col(c).alias("id")).join(own, ["stratum", "id"]).withColumn("is_dropped", F.lit(dropped))
    both = side("dropped", True).unionByName(side("kept", False))
    middle = lambda test: F.median(F.when(test, F.col("cov")))
    held = both.groupBy("stratum").agg(F.count_if("is_dropped").alias("n_pairs"), F.try_divide(middle(F.col("is_dropped")), middle(~F.col("is_dropped"))).alias("x_ratio")).where(F.col("n_pairs") >= least)
    effect = rank_biserial(both.select("stratum", F.col("y").alias("x"), "is_dropped"))
    return held.join(effect, "stratum").select("stratum", "n_pairs", "effect", "z", "x_ratio")


def decoy_null(markers: DataFrame, features: DataFrame, entries: DataFrame, targets: DataFrame, obs: DataFrame, window: int, draws: int = 30) -> DataFrame:
    """Per marker: the rank correlation of its nearby features with its target, against draws of decoys.

    markers (marker, chrom, tss): a curated table, small enough to broadcast; features (var_id, chrom, mid); entries
    (obs_id, var_id, value), absent is zero; targets (marker, obs_id, y), absent is zero; obs (obs_id).
    Decoys lie on other chromosomes and their mean is within the 10 % to 90 % range of the nearby features' means. A draw
    takes as many of them as there are nearby features, by hash order. Too few decoys, or no variance: no null.
    """
    n_obs = F.broadcast(obs.agg(F.count(F.lit(1)).alias("n_obs")))  # one row
    means = entries.groupBy("var_id").agg(F.sum("value").alias("s"))
    known = features.join(means, "var_id", "left").join(n_obs).select("var_id", "chrom", "mid", (F.coalesce("s", F.lit(0.0)) / F.col("n_obs")).alias("mean"))
    near = known.join(F.broadcast(markers), "chrom").where(F.abs(F.col("mid") - F.col("tss")) <= window)
    range_ = near.groupBy("marker").agg(F.first("chrom").alias("home"), F.count(F.lit(1)).alias("n_near"), F.percentile("mean", F.lit(0.1)).alias("low"), F.percentile("mean", F.lit(0.9)).alias("high"))
    away = known.join(F.broadcast(range_), (F.col("chrom") != F.col("home")) & F.col("mean").between(F.col("low"), F.col("high")))
    away = away.select("marker", "var_id", "n_near", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw"))
    order = Window.partitionBy("marker", "draw").orderBy(F.xxhash64("marker", "draw", "var_id"), "var_id")
    picks = away.withColumn("k", F.row_number().over(order)).where("k <= n_near").select("marker", "draw", "var_id")
    sets = near.select("marker", F.lit(0).alias("draw"), "var_id").unionByName(picks)
    full = sets.groupBy("marker", "draw").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(range_.select("marker", "n_near")), "marker").where("n = n_near")
    # Dealt before they are summed: a task's rows are bounded by their own size, not by that of entries, which sets multiply.
    sums = sets.join(entries, "var_id").repartition("marker", "draw", "obs_id").groupBy("marker", "draw", "obs_id").agg(F.sum("value").alias("a"))
    # Every observation of every draw, since zeros have ranks too: at most markers x (draws + 1) rows an observation.
    dense = obs.join(F.broadcast(full.select("marker", "draw")), how="cross").join(sums, ["marker", "draw", "obs_id"], "left").join(targets, ["marker", "obs_id"], "left")
    by = Window.partitionBy("marker", "draw")

    def rank(c: str):
        x = F.coalesce(c, F.lit(0.0))
        return F.rank().over(by.orderBy(x)) + (F.count(F.lit(1)).over(Window.partitionBy("marker", "draw", x)) - 1) / 2

    rho = dense.select("marker", "draw", rank("a").alias("ra"), rank("y").alias("ry")).groupBy("marker", "draw").agg(F.try_divide(F.covar_pop("ra", "ry"), F.stddev_pop("ra") * F.stddev_pop("ry")).alias("rho"))
    null = F.when(F.col("draw") > 0, F.col("rho"))
    out = rho.groupBy("marker").agg(F.max(F.when(F.col("draw") == 0, F.col("rho"))).alias("rho_true"), F.count(null).alias("n_null"), F.median(null).alias("null_median"), F.percentile(null, F.lit(0.95)).alias("null_p95"))
    out = range_.select("marker", "n_near").join(out, "marker", "left")
    return out.withColumn("beats", F.coalesce(F.col("rho_true") > F.col("null_p95"), F.lit(False)))


def rank_biserial(df: DataFrame, least: int = 5) -> DataFrame:
    """(stratum, n1, n2, effect, z): two-sided rank test of dropped against kept; df: (stratum, x, is_dropped).

    effect = 2 U / (n1 n2) - 1, z with tie correction; null where a side has fewer than `least` rows. Ranks come from
    counts of distinct values, which meet in one window a stratum. Rows of null or NaN x take no part.
    """
    v = df.where(F.col("x").isNotNull() & ~F.isnan(F.col("x").cast("double"))).groupBy("stratum", "x").agg(F.count_if("is_dropped").alias("f"), F.count_if(~F.col("is_dropped")).alias("o"))
    below = F.coalesce(F.sum("o").over(Window.partitionBy("stratum").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    m = (F.col("f") + F.col("o")).cast("double")
    g = v.withColumn("below", below).groupBy("stratum").agg(F.sum("f").alias("n1"), F.sum("o").alias("n2"), F.sum(F.col("f") * (F.col("below") + F.col("o") / 2)).alias("u"), F.sum(m * m * m - m).alias("ties"))
    n = F.col("n1") + F.col("n2")
    pairs = (F.col("n1") * F.col("n2")).cast("double")
    ok = (F.col("n1") >= least) & (F.col("n2") >= least)
    var = pairs / 12 * (n + 1 - F.try_divide(F.col("ties"), (n * (n - 1)).cast("double")))
    return g.select("stratum", "n1", "n2", F.when(ok, 2 * F.try_divide(F.col("u"), pairs) - 1).alias("effect"), F.when(ok, F.try_divide(F.col("u") - pairs / 2, F.sqrt(var))).alias("z"))


def linkage_verdict(null: DataFrame, chance: float = 0.05) -> DataFrame:
    """(n, beats, share, p, verdict) over markers with a null: pass at p < 1e-4 and a share of 0.15, warn at p < 0.05, else fail."""
    g = null.where("n_null > 0").agg(F.count(F.lit(1)).alias("n"), F.count_if("beats").alias("beats"))
    g = g.withColumns({"share": F.try_divide("beats", "n"), "p": stats.binomial_tail("beats", "n", F.lit(chance))})
    return g.withColumn("verdict", F.when((F.col("p") < 1e-4) & (F.col("share") >= 0.15), "pass").when((F.col("n") > 0) & (F.col("p") < 0.05), "warn").otherwise("fail"))
