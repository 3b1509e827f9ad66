"""Pairing in a shared latent space: anchors, nearest neighbours, metacells, diagnostics."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ANCHORS, REFERENCES = 1024, 4096  # of a block, about
SLICE = 128  # anchors whose distances to a block are held at a time
NAN, NULL = 3.0, 4.0  # ranks of distances that aren't numbers: beyond all that are


def metacell_count(n_limiting: Column, k: int = 50, oversample: int = 8, floor: int = 60, most: int = 16) -> Column:
    """max(1, int(n / k * oversample)), raised to the floor but not beyond int(n / k * most)."""
    base = F.greatest(F.lit(1), F.floor(n_limiting / k * oversample))
    return F.when(base < floor, F.greatest(base, F.least(F.lit(floor), F.floor(n_limiting / k * most)))).otherwise(base).cast("bigint")


def independent_equivalent(n_limiting: Column, k: int = 50) -> Column:
    return F.greatest(F.lit(1), F.floor(n_limiting / k)).cast("bigint")


def maximin_anchors(latents: DataFrame, per_group: int) -> DataFrame:
    """(grp, anchor_no, obs_id): farthest-point sampling per group from the smallest id; ties by the smaller id.

    Sequential by nature: one task per group keeps two vectors per observation. A group is a set of labelled cells.
    """

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("obs_id").reset_index(drop=True)
        z = np.stack(pdf["z"].to_numpy()).astype(float)
        z /= np.where((n := np.linalg.norm(z, axis=1, keepdims=True)) == 0, 1, n)
        chosen, far = [0], np.full(len(z), np.inf)
        while len(chosen) < min(per_group, len(z)):
            far = np.minimum(far, np.round(((z - z[chosen[-1]]) ** 2).sum(axis=1), 9))
            far[chosen] = -1
            chosen.append(int(far.argmax()))
        return pd.DataFrame({"grp": pdf["grp"][: len(chosen)], "anchor_no": range(len(chosen)), "obs_id": pdf["obs_id"].iloc[chosen].to_numpy()})

    return latents.select("grp", "obs_id", "z").groupBy("grp").applyInPandas(pick, f"grp {latents.schema['grp'].dataType.simpleString()}, anchor_no int, obs_id bigint")


def _vectors(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows, padded with zeros, and their lengths (-1: null); a zero vector is divided by 1."""
    size = pc.fill_null(pc.list_value_length(column), -1).to_numpy()
    z = np.zeros((len(size), max(0, size.max(initial=0))))
    z[np.arange(z.shape[1]) < size[:, None]] = pc.list_flatten(column).to_numpy()
    norm = np.sqrt((z * z).sum(axis=1, keepdims=True))
    return z / np.where(norm == 0, 1, norm), size


def nearest(anchors: DataFrame, latents: DataFrame, k: int, most_anchors: int = ANCHORS, most_references: int = REFERENCES) -> DataFrame:
    """(grp, anchor, obs_id, dist, rank): the k nearest of the anchor's group by 1 - cosine, ties by id.

    Anchors and references of a group are dealt into blocks by hash, and each pair of blocks is one product of two
    matrices, of which an anchor's k nearest remain: only these are rows, and sorted. A task holds a few blocks, whatever
    the size of a group. Distances of vectors with nulls or of other lengths are null; null and NaN come last.
    """
    whole = F.when(~F.exists("z", lambda x: x.isNull()), F.col("z"))
    a = anchors.select("grp", F.lit(True).alias("_anchor"), "obs_id", whole.alias("z"))
    r = latents.select("grp", F.lit(False).alias("_anchor"), "obs_id", whole.alias("z"))
    blocks = lambda d, most, name: d.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))
    sizes = F.broadcast(blocks(anchors, most_anchors, "_na").join(blocks(latents, most_references, "_nr"), "grp"))  # one row a group
    own = lambda n: F.pmod(F.xxhash64("obs_id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    names = ("grp", "_a", "_r", "_anchor", "obs_id", "z")
    a = a.join(sizes, "grp").withColumn("_a", own("_na")).withColumn("_r", each("_nr")).select(*names)
    r = r.join(sizes, "grp").withColumn("_r", own("_nr")).withColumn("_a", each("_na")).select(*names)
    dealt = a.union(r)
    grp, obs_id = dealt.schema["grp"].dataType, dealt.schema["obs_id"].dataType

    def compare(table: pa.Table) -> pa.Table:
        mine = pc.field("_anchor")
        a, r = table.filter(mine), table.filter(~mine)
        r = r.take(pc.sort_indices(r["obs_id"], null_placement="at_start"))
        (za, na), (zr, nr) = _vectors(a["z"]), _vectors(r["z"])
        width = max(za.shape[1], zr.shape[1])
        za, zr = (np.pad(z, ((0, 0), (0, width - z.shape[1]))) for z in (za, zr))
        found = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
        for at in range(0, len(za), SLICE):
            far = np.floor((1 - za[at : at + SLICE] @ zr.T) * 1e9 + 0.5) / 1e9  # halves up, as in SQL
            far[np.isnan(far)] = NAN
            far[(na[at : at + SLICE, None] != nr) | (nr < 0)] = NULL
            last = np.partition(far, min(k, len(zr)) - 1, axis=1)[:, min(k, len(zr)) - 1] if len(zr) else np.empty(len(far))
            i, j = np.nonzero(far <= last[:, None])
            order = np.lexsort((j, far[i, j], i))
            i, j = i[order], j[order]
            first = np.arange(len(i)) - np.searchsorted(i, i) < k
            found.append((i[first] + at, j[first], far[i[first], j[first]]))
        i, j, dist = (np.concatenate(x) for x in zip(*found, strict=True))
        dist = pa.array(np.where(dist == NAN, np.nan, dist), mask=dist == NULL)
        return pa.table({"grp": a["grp"].take(pa.array(i)), "anchor": a["obs_id"].take(pa.array(i)), "obs_id": r["obs_id"].take(pa.array(j)), "dist": dist})

    out = T.StructType([T.StructField("grp", grp), T.StructField("anchor", obs_id), T.StructField("obs_id", obs_id), T.StructField("dist", T.DoubleType())])
    pairs = dealt.groupBy("grp", "_a", "_r").applyInArrow(compare, out)
    w = Window.partitionBy("grp", "anchor").orderBy(F.asc_nulls_last("dist"), "obs_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def diagnostics(members: DataFrame) -> DataFrame:
    """Per group: nearest and k-th distances, distinct members, largest reuse. Members, which are a search, are read once."""
    used = members.withColumn("_u", F.count(F.lit(1)).over(Window.partitionBy("grp", "obs_id")))
    return used.groupBy("grp").agg(
        F.countDistinct("anchor").alias("n_metacells"), F.round(F.avg(F.when(F.col("rank") == 1, F.col("dist"))), 6).alias("mean_nearest"), F.round(F.expr("percentile(dist, 0.95)"), 6).alias("p95_dist"),
        F.countDistinct("obs_id").alias("n_used"), F.max("_u").alias("max_reuse"),
    )


def cross_modal(anchors: DataFrame, latents: DataFrame, k: int) -> DataFrame:
    """Per group of anchors (grp, obs_id, z) against both modalities of latents (modality 0 or 1, grp, obs_id, z):
    n_metacells; for each modality m the cells there are, the mean and greatest distance of the k nearest, how often a cell
    is used and which share is used at all; and median and 95th percentile of the cross-modal gap.

    The gap of an anchor is the difference of the distances of its nearest cells: where it is large, the modalities don't
    share that place, and pairing there extrapolates. Groups without cells of both modalities have no row.
    """
    sides, first = [], []
    for m in (0, 1):
        own = latents.where(F.col("modality") == m)
        near = nearest(anchors, own, k)
        size = own.groupBy("grp").agg(F.count(F.lit(1)).alias(f"n_{m}"))
        use = near.groupBy("grp").agg(F.avg("dist").alias(f"mean_{m}"), F.max("dist").alias(f"max_{m}"), F.count(F.lit(1)).alias("_u"), F.countDistinct("obs_id").alias("_d"), F.countDistinct("anchor").alias(f"_a_{m}"))
        sides.append(use.join(size, "grp").select("grp", f"_a_{m}", f"n_{m}", f"mean_{m}", f"max_{m}", (F.col("_u") / F.col(f"n_{m}")).alias(f"reuse_{m}"), (F.col("_d") / F.col(f"n_{m}")).alias(f"used_{m}")))
        first.append(near.where("rank = 1").select("grp", "anchor", F.col("dist").alias(f"_d{m}")))
    gap = F.abs(F.col("_d1") - F.col("_d0"))
    gaps = first[0].join(first[1], ["grp", "anchor"]).groupBy("grp").agg(F.median(gap).alias("median_gap"), F.percentile(gap, F.lit(0.95)).alias("p95_gap"))
    return sides[0].join(sides[1], "grp").join(gaps, "grp").withColumnRenamed("_a_0", "n_metacells").drop("_a_1")


def plan(groups: DataFrame, n_vars: int, k: int = 25, least: int = 50) -> DataFrame:
    """groups (grp, n0, n1) with metacells = max(1, 2 round(limiting / k)), halves to even, bytes when dense, and whether dropped."""
    limiting = F.least("n0", "n1")
    cells = F.greatest(F.lit(1), F.bround(limiting / k) * 2).cast("bigint")
    return groups.withColumns({"metacells": cells, "bytes": cells * n_vars * 8, "dropped": limiting < least})


def worst(groups: DataFrame, gap: str, n: int) -> DataFrame:
    """The n groups of the largest gap, ties by group, each with the total of metacells."""
    total = F.broadcast(groups.agg(F.sum("n_metacells").alias("total")))  # one row
    return groups.join(total).orderBy(F.desc(gap), "grp").limit(n)
