"""From signature bands to verified links and classes of near-duplicates, for any signature and likeness.

Equal texts are one node, named by the text's md5, so groups of exact copies never meet each other. Nodes that share a
band are candidates. First each is held against the leader of its bucket, which joins the usual family of copies in
time linear in its size; then, in buckets that still hold several components, pairs across components are verified block
by block, so that no link between different texts is lost. Pairs never become rows unless they are alike, and then one
for each pair of components.

Joins with texts or features are merge joins by hint: the plan, and so what is moved, is the same at every size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, discard, map_columns, text_of, written

LIKENESS = 0.8
BLOCK_ROWS, BLOCK_FEATURES = 512, 1 << 20  # texts and features of a block, about
HOT_SHARE = 1024  # a key of more than 1 / HOT_SHARE of the rows is hot; there can be no more than HOT_SHARE of them


def _hot(counts: DataFrame, on: str) -> DataFrame:
    """(on, _parts) of the hot keys of counts (on, n): as many parts as a key has shares of all rows.

    At most HOT_SHARE rows of one key and one number, whatever the input, so it may be broadcast.
    """
    total = counts.agg(F.ceil(F.sum("n") / HOT_SHARE).alias("_share"))  # one row
    return counts.join(F.broadcast(total)).where(F.col("n") > F.col("_share")).select(on, F.ceil(F.col("n") / F.col("_share")).cast("int").alias("_parts"))


def _dealt(big: DataFrame, hot: DataFrame, on: str) -> DataFrame:
    """big with `_part`: a hot key's rows go to its parts by their hash, so that a task that runs again deals alike."""
    parts = F.coalesce("_parts", F.lit(1))
    return big.join(F.broadcast(hot), on, "left").withColumn("_part", F.pmod(F.xxhash64(*big.columns), parts).cast("int")).drop("_parts")


def spread_join(big: DataFrame, small: DataFrame, on: str, counts: DataFrame, how: str = "inner") -> DataFrame:
    """big joined with small, whose keys are unique, without one task for all rows of a hot key.

    counts: (on, n), the rows of big of each key. A hot key's row of small is repeated for each part of the key.
    """
    hot = _hot(counts, on)
    every = small.join(F.broadcast(hot), on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return _dealt(big, hot, on).join(every, [on, "_part"], how).drop("_part")


def _verified(star: DataFrame, texts: DataFrame, make_features: Callable, least: float) -> DataFrame:
    """Pairs (a, b) of star (a leads b) whose texts are alike at least so much.

    A leader's text goes once to each part of its star, ahead of the members' texts there; members go where it is.
    """
    hot = _hot(star.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "a")
    dealt = written(_dealt(star, hot, "a"))
    texts = texts.select(F.col("key").alias("b"), "text")
    leaders = dealt.select("a", "_part").distinct().join(texts.withColumnRenamed("b", "a").hint("merge"), "a").select("a", "_part", F.lit(None).cast("binary").alias("b"), "text")
    rows = leaders.union(dealt.join(texts.hint("merge"), "b").select("a", "_part", "b", "text")).repartition("a", "_part").sortWithinPartitions("a", "_part", F.asc_nulls_first("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, lead, own = make_features(), None, None
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                found = []
                for a, _, b, text in zip(*(c.to_pylist() for c in whole.slice(at, SLICE_ROWS).columns), strict=True):
                    if b is None:
                        lead, own = a, features(text)
                        continue
                    mine = features(text)
                    both = len(np.intersect1d(own, mine, assume_unique=True))
                    if both and both >= least * (len(own) + len(mine) - both):
                        found.append((lead, b))
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.binary())], names=["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary")


def _verified_in_blocks(members: DataFrame, texts: DataFrame, make_features: Callable, least: float) -> DataFrame:
    """(a, b): for each pair of roots that meet in a bucket, a pair of alike members, if there is one; members: (band, key, root).

    Buckets of the same members are looked at once. A bucket is cut into blocks of about BLOCK_ROWS texts or
    BLOCK_FEATURES features, whichever gives more blocks, and each pair of blocks is one group, held as a matrix of
    features: memory is bounded by a block, whatever the bucket's size. Features are made once a text.
    """
    of_texts = texts.join(members.select("key").distinct().hint("merge"), "key", "left_semi")

    def make():
        features = make_features()
        return lambda given: [[(f := features(t)).view(np.int64).tolist() for t in given]]

    features = written(map_columns(of_texts, ["key"], ["text"], [("features", "array<bigint>")], make))
    sized = members.join(features.select("key", F.size("features").alias("f")), "key")
    sizes = sized.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("f").alias("f"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("h"), F.min("key").alias("low"), F.max("key").alias("high"))
    sizes = written(sizes.groupBy("n", "f", "h", "low", "high").agg(F.min("band").alias("band")))
    blocks = sizes.select("band", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("f") / BLOCK_FEATURES)).cast("int").alias("blocks"))
    dealt = spread_join(members, blocks, "band", sizes.select("band", "n")).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.select("band", "key", "root", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "key", "root").join(features.hint("merge"), "key")

    def compare(table: pa.Table) -> pa.Table:
        keys, size = table["key"].to_pylist(), pc.list_value_length(table["features"]).to_numpy().astype(np.float32)
        number = np.unique(np.array([r.hex() for r in table["root"].to_pylist()]), return_inverse=True)[1]
        flat = pc.list_flatten(table["features"]).to_numpy()
        column, seen = np.unique(flat, return_inverse=True, return_counts=True)[1:]
        line = np.repeat(np.arange(len(keys)), size.astype(np.int64))
        shared = seen[column] > 1
        line, column = line[shared], np.unique(column[shared], return_inverse=True)[1]
        both = np.zeros((len(keys), len(keys)), np.float32)
        order = np.argsort(column, kind="stable")
        line, column = line[order], column[order]
        for c in range(0, int(column.max(initial=-1)) + 1, 2048):
            a, b = np.searchsorted(column, [c, c + 2048])
            m = np.zeros((len(keys), 2048), np.float32)
            m[line[a:b], column[a:b] - c] = 1
            both += m @ m.T
        near = (both >= np.float32(least) * (size[:, None] + size - both) - 1e-3) & (number[:, None] < number) & (both > 0)
        i, j = np.nonzero(near)
        exact = both[i, j].astype(np.float64)
        sure = exact >= least * (size[i].astype(np.float64) + size[j] - exact)
        i, j = i[sure], j[sure]
        first = np.sort(np.unique(number[i] * len(keys) + number[j], return_index=True)[1])  # one pair a pair of roots
        return pa.table({"a": pa.array([keys[x] for x in i[first].tolist()], pa.binary()), "b": pa.array([keys[x] for x in j[first].tolist()], pa.binary())})

    return dealt.groupBy("band", "low", "high").applyInArrow(compare, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(key, root) of all nodes of edges (a, b): root is the least node of the connected component.

    Alternating large-star and small-star steps, each a sum of minima and a join. Minima are written before they are
    joined, so that both sides are plain exchanges, which Spark splits where the root of a large class is hot; every
    round is written out, and what it replaces is removed.
    """
    now = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b"), F.col("a")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = written(both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct())
        lower = written(large.groupBy("b").agg(F.min("a").alias("m")))
        small = large.join(lower, "b")
        new = written(small.select(F.col("m").alias("a"), "b").union(small.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct())
        discard(now, least, large, lower)
        now = new
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("b").alias("key"), F.col("a").alias("root"))
        before = state


def classes(docs: DataFrame, make_bands: Callable, make_features: Callable, id_col: str = "doc_id", text_col: str = "text", likeness: float = LIKENESS) -> DataFrame:
    """One row per input row: id, `key` of its text, `root` of its class, `class_id` (least id of the class), `class_size`
    (rows of it), and `first`, the id and key of its representative: the least id, nulls last, then the least key.

    make_bands() -> f(texts) -> (bands, sizes): band hashes of each text and its number of shingles; a text without
    shingles has no bands and equals only its exact copies. make_features() -> f(text) -> distinct 64-bit hashes: the
    likeness of two texts is the Jaccard likeness of these sets. Null and empty texts are equal.

    `root`, the key of one of the class's texts, names the class; class_id does so only where ids are not null and unique.
    """
    keyed = docs.select(F.col(id_col), F.unhex(F.md5(text_of(text_col))).alias("key"), text_of(text_col).alias("text"))
    nodes = written(map_columns(keyed, [id_col, "key"], ["text"], [("bands", "array<bigint>"), ("size", "bigint")], make_bands))
    rows = written(nodes.groupBy("key").agg(F.first("bands").alias("bands")).select("key", F.explode("bands").alias("band")))
    buckets = written(rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = written(spread_join(rows, buckets, "band", buckets).select("band", "key", "n"))
    discard(rows)
    # The hub of a family shares more and larger buckets than its other members do: the leader is the node that meets most.
    met = written(shared.groupBy("key").agg(F.sum("n").alias("met")))
    lead = shared.join(met, "key").groupBy("band").agg(F.max(F.struct("met", "key")).alias("lead")).select("band", F.col("lead.key").alias("lead"))
    star = written(spread_join(shared.drop("n"), lead, "band", buckets).where("key <> lead").select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct())
    # Copies are folded before anything moves: one text of a key leaves a map task, however many copies there are.
    texts = written(keyed.groupBy("key").agg(F.first("text").alias("text")).join(met.select("key").hint("merge"), "key", "left_semi"))
    discard(met)
    edges = written(_verified(star, texts, make_features, likeness))
    discard(star)
    roots = components(edges)

    # What may still link two components: pairs across the components of a bucket.
    placed = shared.join(roots, "key", "left").select("band", "key", F.coalesce("root", "key").alias("root"))
    split = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("band")
    across = written(spread_join(placed, split, "band", buckets))
    late = written(_verified_in_blocks(across, texts, make_features, likeness))
    discard(across, shared, buckets, texts)
    if late.limit(1).count():
        roots = components(edges.unionByName(late))

    of_key = written(roots)
    repeats = written(nodes.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    placed = spread_join(nodes.select(id_col, "key"), of_key, "key", repeats, "left")
    placed = written(placed.select(id_col, "key", F.coalesce("root", "key").alias("root")))
    discard(nodes, repeats, of_key, edges, late)
    rank = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "key")
    of = written(placed.groupBy("root").agg(F.min(id_col).alias("class_id"), F.count(F.lit(1)).alias("n"), F.min(rank).alias("first")))
    return spread_join(placed, of, "root", of.select("root", "n")).select(id_col, "key", "root", "class_id", F.col("n").alias("class_size"), "first")
