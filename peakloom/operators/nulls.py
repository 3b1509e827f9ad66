"""Permutation nulls of running enrichment: drawn sets of the same sizes, scored down the same ranked list.

Draw d orders all items by md5 of its number and the item; its set of size h is the first h of them. So one order serves
every size, a draw never depends on how data are dealt, and a set of another size costs no new hashes. An item's draws
are found as one array column (the draws in which its hash is low enough to come among the first), so items are never
multiplied by draws: what becomes rows are the hits of drawn sets, about draws x the largest size of them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .regulons import places, walk

HEX = 13  # digits of a hash that a cut is compared with


def _hash(draw, item):
    return F.md5(F.concat_ws("_", draw.cast("string"), item.cast("string")))


def first_of_draws(items: DataFrame, n: int, most: int, draws: int) -> DataFrame:
    """(draw, item, k): the first `most` items of each draw's order. items: (item), n of them, distinct.

    An item is looked at further only in draws where its hash lies below a cut that leaves `most` and seven
    deviations more. Draws that come short of it all the same (one in 10^11) are drawn again without a cut, so that
    sets always have their sizes; only a list that is shorter than a size has less.
    """
    top = min(most, n)
    share = (top + 7 * math.sqrt(top) + 50) / max(n, 1)
    cut = "g" if share >= 1 else f"{int(share * 16**HEX):0{HEX}x}"  # "g" comes after all hashes
    low = items.select("item", F.explode(F.filter(F.sequence(F.lit(0), F.lit(draws - 1)), lambda d: _hash(d, F.col("item")) < cut)).alias("draw"))
    enough = low.groupBy("draw").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= top)
    short = items.sparkSession.range(draws).select(F.col("id").cast("int").alias("draw")).join(enough, "draw", "left_anti")
    again = items.select("item").join(F.broadcast(short)).select("item", "draw")  # no draw, but for bad luck; `draws` at most
    found = low.join(F.broadcast(short), "draw", "left_anti").unionByName(again) if share < 1 else low
    k = F.row_number().over(Window.partitionBy("draw").orderBy(_hash(F.col("draw"), F.col("item")), "item"))
    return found.select("draw", "item", k.alias("k")).where(F.col("k") <= top)


def of_sizes(first: DataFrame, sizes: list[int]) -> DataFrame:
    """The rows of first (k, ...) once for each `size` that takes them."""
    return first.withColumn("size", F.explode(F.filter(F.array(*map(F.lit, sorted(sizes))), lambda h: h >= F.col("k")))).drop("k")


def drawn_hits(items: DataFrame, n: int, sizes: list[int], draws: int) -> DataFrame:
    """(size, draw, item): the items of each draw's set of each size. items: (item), n of them, distinct."""
    return of_sizes(first_of_draws(items, n, max(sizes, default=0), draws), sizes).select("size", "draw", "item")


def enrichment_null(ranked: DataFrame, sets: DataFrame, draws: int = 1000) -> DataFrame:
    """(set, n_hits, score, n_null, n_beyond, p, normalised) of running enrichment against `draws` drawn sets of its size.

    ranked: (item, weight), items distinct; sets: (set, item). n_null: drawn sets whose score has the same sign (zero
    counts as positive); n_beyond: those at least as far from zero; p = n_beyond / n_null; normalised: score over the
    mean distance of those. Where no drawn set has the sign, or the set has no score, p and normalised are null.

    A set's drawn scores come as one array of its size. The driver sees the distinct sizes of sets (some hundreds).
    """
    at = places(ranked).hint("merge")  # as long as the list: never broadcast, though its file may look small
    n = ranked.agg(F.count(F.lit(1)).alias("n"))
    scored = walk(sets.join(at, "item"), n, ["set"])
    sizes = [r["n"] for r in sets.join(ranked.select("item").hint("merge"), "item").groupBy("set").agg(F.count(F.lit(1)).alias("n")).select("n").distinct().collect()]
    if not sizes:
        sizes = [1]  # no set is scored, and none will be joined
    first = first_of_draws(ranked.select("item"), ranked.count(), max(sizes), draws)
    hits = of_sizes(first.join(at, "item"), sizes)
    null = walk(hits, n, ["size", "draw"]).where("score is not null").groupBy("size").agg(F.collect_list("score").alias("_null"))
    j = scored.join(null, F.col("n_hits") == F.col("size"), "left")
    side = F.filter("_null", lambda x: (x >= 0) == (F.col("score") >= 0))
    j = j.withColumn("_same", F.coalesce(side, F.array().cast("array<double>")))
    beyond = F.size(F.filter("_same", lambda x: F.abs(x) >= F.abs("score") - 1e-12))
    mean = F.aggregate(F.array_sort("_same"), F.lit(0.0), lambda a, x: a + F.abs(x)) / F.size("_same")
    j = j.withColumns({"n_null": F.size("_same").cast("bigint"), "n_beyond": F.when(F.col("score").isNull(), 0).otherwise(beyond).cast("bigint")})
    some = (F.col("n_null") > 0) & F.col("score").isNotNull()
    return j.select("set", "n_hits", "score", "n_null", "n_beyond", F.when(some, F.col("n_beyond") / F.col("n_null")).alias("p"), F.when(some, F.try_divide(F.col("score"), mean)).alias("normalised"))

