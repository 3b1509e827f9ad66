"""Labelled sparse matrices on disk: blocks of compressed sparse rows, in Parquet folders that Spark prunes by variable.

A matrix is three tables: `obs`, `var` (with the block and the place in it of every variable) and `blocks`, a row for each
block of observations and block of variables, with the observations' ids, the offsets of their entries, and the entries'
places and values. Blocks of variables are partitions, so that reading a few variables opens their blocks alone.

A set of matrices over the same observations is committed by a numbered manifest, written last: what a killed job left
behind is never seen, and the set before stays readable. A chunked export pins its variables' order by a digest that
every later chunk must bear.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files

ROWS, COLUMNS = 4096, 1024  # observations and variables of a block, about


def _deal(df: DataFrame, key: str, size: int) -> int:
    return max(1, -(-df.select(key).distinct().count() // size))


def write_matrix(entries: DataFrame, obs: DataFrame, var: DataFrame, path: str, rows: int = ROWS, columns: int = COLUMNS) -> None:
    """A matrix at a path that is not there yet. entries: (obs_id, var_id, value), absent is zero; obs: (obs_id, ...), var:
    (var_id, ...), ids unique, further columns kept. Entries of unknown ids, nulls and zeros are left out; repeated ones
    are kept apart and add up where they are read.
    """
    n_rows, n_columns = _deal(obs, "obs_id", rows), _deal(var, "var_id", columns)
    block = F.pmod(F.xxhash64("var_id"), F.lit(n_columns)).cast("int")
    place = F.row_number().over(Window.partitionBy("var_block").orderBy("var_id")) - 1
    var.withColumn("var_block", block).withColumn("var_place", place).write.parquet(f"{path}/var")
    obs.withColumn("obs_block", F.pmod(F.xxhash64("obs_id"), F.lit(n_rows)).cast("int")).write.parquet(f"{path}/obs")
    spark = entries.sparkSession
    known = entries.where("value <> 0").join(spark.read.parquet(f"{path}/var").select("var_id", "var_block", "var_place"), "var_id")
    known = known.join(spark.read.parquet(f"{path}/obs").select("obs_id", "obs_block"), "obs_id").select("obs_block", "var_block", "obs_id", "var_place", F.col("value").cast("double").alias("value"))
    kind = obs.schema["obs_id"].dataType.simpleString()

    def compress(t: pa.Table) -> pa.Table:
        t = t.sort_by([("obs_id", "ascending"), ("var_place", "ascending")])
        ids = t["obs_id"].combine_chunks()
        runs = pc.run_end_encode(ids, run_end_type=pa.int64())
        offsets = np.concatenate([[0], runs.run_ends.to_numpy()])
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.table({
            "obs_block": t["obs_block"][:1], "var_block": t["var_block"][:1], "obs_ids": one(runs.values.to_pylist(), runs.values.type),
            "offsets": one(offsets, pa.int64()), "places": one(t["var_place"].to_numpy(), pa.int32()), "entries": one(t["value"].to_numpy(), pa.float64()),
        })

    out = known.groupBy("obs_block", "var_block").applyInArrow(compress, f"obs_block int, var_block int, obs_ids array<{kind}>, offsets array<bigint>, places array<int>, entries array<double>")
    out.write.partitionBy("var_block").parquet(f"{path}/blocks")


def read_axis(spark: SparkSession, path: str, axis: str) -> DataFrame:
    """obs or var as it was given."""
    return spark.read.parquet(f"{path}/{axis}").drop("obs_block", "var_block", "var_place")


def read_matrix(spark: SparkSession, path: str, variables: list | None = None, observations: list | None = None) -> DataFrame:
    """(obs_id, var_id, value), of all or of some variables and observations.

    Chosen variables are looked up first, so that only their blocks are opened; of chosen observations the blocks of
    the others are skipped by their number.
    """
    kind = spark.read.parquet(f"{path}/obs").schema["obs_id"].dataType.simpleString()
    var = spark.read.parquet(f"{path}/var").select("var_id", "var_block", "var_place")
    blocks = spark.read.schema(f"obs_block int, obs_ids array<{kind}>, offsets array<bigint>, places array<int>, entries array<double>, var_block int").parquet(f"{path}/blocks") if files.exists(spark, f"{path}/blocks") else None
    if variables is not None:
        var = var.where(F.col("var_id").isin(variables))
        wanted = sorted({r["var_block"] for r in var.select("var_block").distinct().collect()})  # as many as are chosen at most
        blocks = blocks.where(F.col("var_block").isin(wanted))
    if observations is not None:
        of = spark.read.parquet(f"{path}/obs").where(F.col("obs_id").isin(observations)).select("obs_block").distinct()
        blocks = blocks.where(F.col("obs_block").isin([r["obs_block"] for r in of.collect()]))

    def expand(batches):
        for b in batches:
            ids, places = pc.list_flatten(b["obs_ids"]), pc.list_flatten(b["places"])
            offsets, n = pc.list_flatten(b["offsets"]).to_numpy(), pc.list_value_length(b["obs_ids"]).to_numpy()
            ends = np.cumsum(n + 1)
            counts = np.delete(np.diff(offsets), ends[:-1] - 1)  # not from a block's last offset to the next one's first
            per = pc.list_value_length(b["places"]).to_numpy()
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.repeat(np.arange(len(ids)), counts))), pa.array(np.repeat(b["var_block"].to_numpy(), per)), places, pc.list_flatten(b["entries"])], names=["obs_id", "var_block", "var_place", "value"])

    rows = blocks.select("obs_ids", "offsets", "places", "entries", "var_block").mapInArrow(expand, f"obs_id {kind}, var_block int, var_place int, value double")
    if observations is not None:
        rows = rows.where(F.col("obs_id").isin(observations))
    named = F.broadcast(var) if variables is not None else var
    return rows.join(named, ["var_block", "var_place"]).select("obs_id", "var_id", "value")


def read_columns(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """obs_id and a column for each of the variables, zero where there is no entry; a variable that is not there is fatal."""
    have = {r[0] for r in spark.read.parquet(f"{path}/var").where(F.col("var_id").isin(variables)).select("var_id").collect()}
    if lack := [v for v in variables if v not in have]:
        raise ValueError(f"{path} has no {lack}")
    wide = read_matrix(spark, path, variables).groupBy("obs_id").pivot("var_id", variables).agg(F.sum("value"))
    return read_axis(spark, path, "obs").select("obs_id").join(wide, "obs_id", "left").select("obs_id", *(F.coalesce(F.col(f"`{v}`"), F.lit(0.0)).alias(v) for v in variables))


# --- sets of matrices --------------------------------------------------------------------------------------------


def _id_digest(df: DataFrame, *columns: str) -> list[str]:
    """A digest of rows that does not depend on how they are dealt: their number and two sums of hashes."""
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).cast("string").alias(f"h{seed}") for seed in (0, 1)]
    one = df.agg(F.count(F.lit(1)).cast("string").alias("n"), *sums).first()
    return [x or "0" for x in one]


def write_set(path: str, parts: dict[str, tuple[DataFrame, DataFrame, DataFrame]], provenance: dict) -> int:
    """A new version of the set at `path`: parts (name to entries, obs, var) with the same observations; its number.

    Parts are written to a folder of their own and become the set by the manifest, which a second writer of the same
    number can't make.
    """
    spark = next(iter(parts.values()))[0].sparkSession
    axes = {name: _id_digest(obs, "obs_id") for name, (_, obs, _) in parts.items()}
    if len({tuple(a) for a in axes.values()}) > 1:
        raise ValueError(f"the parts have other observations: {axes}")
    number = max((int(n.split(".")[0]) for n in files.names(spark, f"{path}/manifests") if n.endswith(".json")), default=0) + 1
    folder = f"data/{uuid.uuid4().hex}"
    for name, (entries, obs, var) in parts.items():
        write_matrix(entries, obs, var, f"{path}/{folder}/{name}")
    manifest = {"parts": {name: f"{folder}/{name}" for name in parts}, "obs_digest": next(iter(axes.values())), "provenance": provenance}
    files.write_new(spark, f"{path}/manifests/{number:08d}.json", json.dumps(manifest, sort_keys=True, indent=1))
    return number


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest, its parts as whole paths."""
    have = [n for n in files.names(spark, f"{path}/manifests") if n.endswith(".json")]
    if not have:
        raise FileNotFoundError(f"no set has been committed at {path}")
    out = json.loads(files.read_text(spark, f"{path}/manifests/{have[-1]}"))
    return out | {"number": int(have[-1].split(".")[0]), "parts": {k: f"{path}/{v}" for k, v in out["parts"].items()}}


# --- chunks with a pinned axis -----------------------------------------------------------------------------------


def write_chunk(entries: DataFrame, var: DataFrame, path: str, chunk: str) -> None:
    """A chunk of observations of an export: entries (obs_id, var_id, value) over var (place, var_id).

    The first chunk pins the axis: its names, in their order, as a digest. A chunk whose axis differs in a name or in two
    that are swapped, whose places are not 0 to n - 1, or that has been written, is refused before any of it can be seen.
    """
    spark = entries.sparkSession
    digest = _id_digest(var, "place", "var_id")
    span = var.agg(F.min("place"), F.max("place"), F.countDistinct("place"), F.countDistinct("var_id"), F.count(F.lit(1))).first()
    if span[4] and (span[0] != 0 or span[1] != span[4] - 1 or span[2] != span[4] or span[3] != span[4]):
        raise ValueError(f"chunk {chunk}: places and names of the axis must be 0 to {span[4] - 1} and unique")
    pin = f"{path}/axis.json"
    if files.exists(spark, pin):
        if (pinned := json.loads(files.read_text(spark, pin))) != digest:
            raise ValueError(f"chunk {chunk} has another axis than the chunks before: {digest}, not {pinned}")
    staged = f"{path}/_staged/{uuid.uuid4().hex}"
    entries.join(var, "var_id").select("obs_id", "place", "value").write.parquet(staged)
    if not files.exists(spark, pin):
        var.select("place", "var_id").write.mode("overwrite").parquet(f"{path}/axis")
        files.write_new(spark, pin, json.dumps(digest))
    files.rename(spark, staged, f"{path}/chunks/chunk={chunk}")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, obs_id, var_id, value) of all chunks."""
    return spark.read.parquet(f"{path}/chunks").join(spark.read.parquet(f"{path}/axis"), "place").select("chunk", "obs_id", "var_id", "value")
