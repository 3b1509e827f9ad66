"""Products of two sparse factors, cells x topics by topics x regions, of which only each cell's largest entries are kept."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OBS_BLOCK, VAR_BLOCK = 2048, 4096  # a task's product has this many entries


def _dense(t: pa.Table, names: pa.Array) -> np.ndarray:
    lists = t["w"].combine_chunks()
    m = np.zeros((t.num_rows, len(names)))
    line = np.repeat(np.arange(t.num_rows), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = pa.compute.list_flatten(lists)
    np.add.at(m, (line, pa.compute.index_in(flat.field("topic"), names).to_numpy(zero_copy_only=False)), flat.field("weight").to_numpy(zero_copy_only=False))
    return m


def reduced_product(cells: DataFrame, regions: DataFrame, keep: int, scale: float = 1e6, max_gb: float = 200.0) -> DataFrame:
    """(obs_id, var_id, value): the `keep` largest of floor(scale x the sum over topics of both weights) of each cell, ties by
    var_id; zeros are dropped.

    cells: (obs_id, topic, weight); regions: (var_id, topic, weight), weights not negative, repeated ones add up; topics
    are few. What comes out is estimated first, and refused where it has more than `max_gb` (the dense product, which is
    never made, is named too). Both sides are dealt to blocks, a pair of blocks is one task's dense product of OBS_BLOCK x
    VAR_BLOCK, and a cell's largest entries in each block meet for the last choice.
    """
    n_obs, n_var = cells.agg(F.countDistinct("obs_id")).first()[0], regions.agg(F.countDistinct("var_id")).first()[0]
    if (gb := n_obs * min(keep, n_var) * 24 / 1e9) > max_gb:
        raise MemoryError(f"{n_obs} cells x {min(keep, n_var)} of {n_var} regions are {gb:.1f} GB (dense: {n_obs * n_var * 8 / 1e9:.1f} GB), more than {max_gb} GB")
    names = cells.select("topic").distinct().orderBy("topic").toArrow()["topic"].combine_chunks()  # topics are few
    deal = lambda n, size: max(1, math.ceil(n / size))
    rows, columns = deal(n_obs, OBS_BLOCK), deal(n_var, VAR_BLOCK)

    def side(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        packed = df.where("weight <> 0").groupBy(key).agg(F.collect_list(F.struct("topic", F.col("weight").cast("double").alias("weight"))).alias("w"))
        return packed.withColumns({own: F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int"), other: F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))})

    regions = regions.join(F.broadcast(cells.select("topic").distinct()), "topic", "left_semi")
    a, b = side(cells, "obs_id", "i", rows, "j", columns), side(regions, "var_id", "j", columns, "i", rows)

    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        p = np.floor(_dense(left, names) @ _dense(right, names).T * scale + 1e-9)
        if p.size and p.shape[1] > keep:
            least = np.partition(p, p.shape[1] - keep, axis=1)[:, p.shape[1] - keep]  # ties with the last stay for now
            p = np.where(p >= least[:, None], p, 0)
        r, c = np.nonzero(p > 0)
        return pa.table({"obs_id": left["obs_id"].take(pa.array(r)), "var_id": right["var_id"].take(pa.array(c)), "value": pa.array(p[r, c])})

    schema = f"obs_id {cells.schema['obs_id'].dataType.simpleString()}, var_id {regions.schema['var_id'].dataType.simpleString()}, value double"
    best = a.groupBy("i", "j").cogroup(b.groupBy("i", "j")).applyInArrow(multiply, schema)
    k = F.row_number().over(Window.partitionBy("obs_id").orderBy(F.desc("value"), "var_id"))
    return best.withColumn("_k", k).where(F.col("_k") <= keep).drop("_k")
