"""What topic models are chosen by: coherence of top words, density, divergence, and thresholds of topic weights."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .topics import PASSES, _histogram, choose_model, fitted, kept, top_regions, topic_vectors

LOWER_IS_BETTER = ("density", "divergence", "perplexity")
LEAST_FOR_COHERENCE = 5


def coherence(weights: DataFrame, cells: DataFrame, n: int = 20) -> DataFrame:
    """(topic, n_pairs, coherence): mean over pairs of a topic's n heaviest variables of ln((D(i, j) + 1) / D(i)), where D
    counts cells that have the variables and i is the heavier one. Pairs whose i is in no cell are left out.

    weights: (topic, region, weight); cells: (obs_id, var_id). The top variables are few (topics x n), so cells meet them
    where they are; pairs are made within a cell and topic only.
    """
    k = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "region"))
    top = top_regions(weights, n).select("topic", F.col("region").alias("var_id"), k.alias("k"))
    met = cells.join(F.broadcast(top), "var_id").groupBy("obs_id", "topic").agg(F.array_sort(F.collect_set("k")).alias("ks"))
    pair = lambda i: F.transform(F.filter("ks", lambda j: j >= i), lambda j: F.struct(i.alias("i"), j.alias("j")))
    counts = met.select("topic", F.explode(F.flatten(F.transform("ks", pair))).alias("p")).groupBy("topic", "p.i", "p.j").agg(F.count(F.lit(1)).alias("d"))
    places = top.select("topic", "k")
    grid = places.withColumnRenamed("k", "i").join(places.withColumnRenamed("k", "j"), "topic").where("i < j")  # topics x n x n
    alone = counts.where("i = j").select("topic", "i", F.col("d").alias("di"))
    g = grid.join(alone, ["topic", "i"]).join(counts, ["topic", "i", "j"], "left")
    return g.groupBy("topic").agg(F.count(F.lit(1)).alias("n_pairs"), F.avg(F.log((F.coalesce("d", F.lit(0)) + 1) / F.col("di"))).alias("coherence"))


def gram(weights: DataFrame) -> DataFrame:
    """(i, j, value): the scalar product of the weights of each two topics, i <= j; weights: (topic, region, weight).

    A region's weights are one short row; tasks sum the products of their regions in a topics x topics matrix, and only
    these are shuffled. Topics are few, regions may be many.
    """
    topics = weights.select("topic").distinct().orderBy("topic").toArrow()["topic"]  # topics are few
    rows = weights.groupBy("region").agg(F.collect_list("topic").alias("t"), F.collect_list("weight").alias("w")).select("t", F.col("w").cast("array<double>").alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(topics), len(topics)))
        for b in batches:
            dense = np.zeros((b.num_rows, len(topics)))
            line = np.repeat(np.arange(b.num_rows), pc.list_value_length(b["t"]).to_numpy(zero_copy_only=False))
            column = pc.index_in(pc.list_flatten(b["t"]), topics.combine_chunks()).to_numpy(zero_copy_only=False)
            np.add.at(dense, (line, column), pc.list_flatten(b["w"]).to_numpy(zero_copy_only=False))
            total += dense.T @ dense
        i, j = np.triu_indices(len(topics))
        yield pa.RecordBatch.from_arrays([topics.take(pa.array(i)).combine_chunks(), topics.take(pa.array(j)).combine_chunks(), pa.array(total[i, j])], names=["i", "j", "value"])

    kind = weights.schema["topic"].dataType.simpleString()
    return rows.mapInArrow(run, f"i {kind}, j {kind}, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))


def density(products: DataFrame) -> DataFrame:
    """One row (n_topics, density): the mean cosine of two topics; products: (i, j, value) of `gram`. Null for one topic."""
    norm = products.where("i = j").select(F.col("i").alias("t"), F.sqrt("value").alias("norm"))
    pairs = products.where("i < j").join(norm.select(F.col("t").alias("i"), F.col("norm").alias("a")), "i").join(norm.select(F.col("t").alias("j"), F.col("norm").alias("b")), "j")
    mean = pairs.agg(F.avg(F.try_divide("value", F.col("a") * F.col("b"))).alias("density"))
    return norm.agg(F.count(F.lit(1)).alias("n_topics")).join(mean)


def divergence(products: DataFrame, shares: DataFrame, lengths: DataFrame) -> float:
    """Symmetric Kullback-Leibler divergence of the singular values of topics x regions from the topics' weights in cells.

    products: (i, j, value) of `gram`, whose roots of eigenvalues are the singular values; shares: (obs_id, topic,
    weight); lengths: (obs_id, n). Both sides are sorted and scaled to a sum of one. Only numbers of topics reach the driver.
    """
    g = products.toArrow().to_pandas()
    names = sorted(set(g["i"]))
    m = np.zeros((len(names), len(names)))
    for i, j, v in g.itertuples(index=False):
        m[names.index(i), names.index(j)] = m[names.index(j), names.index(i)] = v
    one = np.sort(np.sqrt(np.maximum(np.linalg.eigvalsh(m), 0)))[::-1]
    by = shares.join(lengths, "obs_id").groupBy("topic").agg(F.sum(F.col("weight") * F.col("n")).alias("w")).toArrow()["w"].to_numpy()
    other = np.sort(np.concatenate([by, np.zeros(len(names) - len(by))]))[::-1]
    p, q = (np.maximum(x / x.sum(), 1e-300) for x in (one, other))
    return float((p * np.log(p / q)).sum() + (q * np.log(q / p)).sum())


def select_topics(quality: dict[int, dict[str, float]], selected: int | None = None, least: int = LEAST_FOR_COHERENCE) -> int:
    """The number of topics: `selected` if it was fitted, or the best mean of rescaled metrics.

    Without a selection there must be two models at least, for metrics are rescaled between them, and one of them must
    have `least` topics, for coherence counts from there on.
    """
    if selected is not None:
        if selected not in quality:
            raise ValueError(f"{selected} is not among the models {sorted(quality)}")
        return selected
    if len(quality) < 2:
        raise ValueError(f"metrics can't choose among models {sorted(quality)}: give two at least, or select one")
    if max(quality) < least:
        raise ValueError(f"models {sorted(quality)} all have fewer than {least} topics, for which coherence is not judged")
    known = {k: {m: v for m, v in q.items() if m != "coherence" or k >= least} for k, q in quality.items()}
    worst = min(q["coherence"] for q in known.values() if "coherence" in q) if any("coherence" in q for q in known.values()) else None
    full = {k: q | ({"coherence": worst} if worst is not None and "coherence" not in q else {}) for k, q in known.items()}
    return choose_model(full, LOWER_IS_BETTER)


# --- the metrics of fitted models --------------------------------------------------------------------------------


def model_frames(words: CountVectorizerModel, model: LDAModel, vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """weights (topic, region, weight), each topic's summing to one, and shares (obs_id, topic, weight) of a fitted model.

    The library keeps a model's matrix on the driver, whose size is vocabulary x topics.
    """
    matrix = model.topicsMatrix().toArray()
    matrix = matrix / matrix.sum(axis=0)
    regions, topics = np.indices(matrix.shape)
    table = pa.table({"topic": topics.ravel(), "region": np.array(words.vocabulary, object)[regions.ravel()], "weight": matrix.ravel()})
    weights = vectors.sparkSession.createDataFrame(table)
    shares = model.transform(vectors).select("obs_id", F.posexplode(vector_to_array("topicDistribution")).alias("topic", "weight"))
    return weights, shares.select("obs_id", F.col("topic").cast("bigint").alias("topic"), "weight")


def model_metrics(cells: DataFrame, ks: list[int], n: int = 20, seed: int = 555, iterations: int = PASSES) -> dict[int, dict[str, float]]:
    """coherence, density, divergence and perplexity of a model of each number of topics, fitted one after the other.

    Cells and vectors are made once and kept until all models are fitted; each pass of a model reads all of them.
    """
    out = {}
    cells = kept(cells)
    words, vectors = topic_vectors(cells)  # the same for all numbers of topics
    for k in ks:
        model = fitted(vectors, k, seed, iterations)
        weights, shares = model_frames(words, model, vectors)
        products = gram(weights)
        lengths = cells.groupBy("obs_id").agg(F.count(F.lit(1)).alias("n"))
        out[k] = {
            "coherence": coherence(weights, cells, n).agg(F.avg("coherence")).first()[0],
            "density": density(products).first()["density"],
            "divergence": divergence(products, shares, lengths),
            "perplexity": model.logPerplexity(vectors),
        }
    return out


# --- thresholds --------------------------------------------------------------------------------------------------


def _arrays(weights: DataFrame, bins: int) -> DataFrame:
    """(topic, low, width, h, n, sx, sq): each topic's histogram as an array of (n, x), x the middle of a bin in bins from
    low, and its moments."""
    h = _histogram(weights, bins)
    x = F.col("bin") + 0.5
    g = h.groupBy("topic", "low", "high").agg(
        F.array_sort(F.collect_list(F.struct(x.cast("double").alias("x"), F.col("n").cast("double").alias("n")))).alias("h"),
        F.sum("n").cast("double").alias("n"), F.sum(F.col("n") * x).cast("double").alias("sx"), F.sum(F.col("n") * x * x).cast("double").alias("sq"),
    )
    return g.withColumn("width", (F.col("high") - F.col("low")) / bins)


def li(weights: DataFrame, bins: int = 100, rounds: int = 60) -> DataFrame:
    """(topic, bin, threshold) by minimum cross-entropy: the fixed point t of (a - b) / (ln a - ln b), where a and b are the
    means of the bins' middles up to t and over it, from the mean of all on. A topic of one weight only has none.

    A side that is empty leaves t as it is. Weights over the threshold belong to the topic.
    """
    none = F.struct(*(F.lit(0.0).alias(c) for c in "npmq"))

    def step(t, _):
        add = lambda s, e: F.struct((s["n"] + F.when(e["x"] <= t, e["n"]).otherwise(0.0)).alias("n"), (s["p"] + F.when(e["x"] <= t, e["n"] * e["x"]).otherwise(0.0)).alias("p"), (s["m"] + F.when(e["x"] > t, e["n"]).otherwise(0.0)).alias("m"), (s["q"] + F.when(e["x"] > t, e["n"] * e["x"]).otherwise(0.0)).alias("q"))
        new = lambda s: F.coalesce(F.try_divide(F.try_divide(s["p"], s["n"]) - F.try_divide(s["q"], s["m"]), F.log(F.try_divide(s["p"], s["n"])) - F.log(F.try_divide(s["q"], s["m"]))), t)
        return F.transform(F.array(F.aggregate("h", none, add)), new)[0]

    t = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.col("sx") / F.col("n"), step)
    return _arrays(weights, bins).withColumn("t", t).select("topic", F.floor("t").alias("bin"), (F.col("low") + F.col("t") * F.col("width")).alias("threshold"))


def _normal(x, m, v):
    return F.exp(-(x - m) * (x - m) / (2 * v)) / F.sqrt(2 * np.pi * v)


def mixture(weights: DataFrame, bins: int = 100, rounds: int = 40) -> DataFrame:
    """(topic, two, bin, threshold): two normal distributions fitted to each topic's histogram by expectation and
    maximisation, from the parts below and over the mean on.

    If they explain it better than one (by Bayes' information criterion), the threshold is the middle of the first bin
    of least density between their means; otherwise it is two deviations over the mean. Variances are at least that of
    a bin. A topic of one weight only has none.
    """
    least = 1 / 12
    a = _arrays(weights, bins).withColumns({"mean": F.col("sx") / F.col("n"), "var": F.greatest(F.col("sq") / F.col("n") - F.pow(F.col("sx") / F.col("n"), F.lit(2)), F.lit(least))})
    zero = F.struct(*(F.lit(0.0).alias(c) for c in "nxq"))

    def fitted(s):
        """Weight and moments of both from those of the upper one (n, x, q); an empty one leaves all to the other."""
        n2, n1 = s["n"], F.col("n") - s["n"]
        m1, m2 = F.try_divide(F.col("sx") - s["x"], n1), F.try_divide(s["x"], n2)
        v1, v2 = F.try_divide(F.col("sq") - s["q"], n1) - m1 * m1, F.try_divide(s["q"], n2) - m2 * m2
        return F.struct((n2 / F.col("n")).alias("w"), F.coalesce(m1, F.col("mean")).alias("m1"), F.greatest(F.coalesce(v1, F.col("var")), F.lit(least)).alias("v1"), F.coalesce(m2, F.col("mean")).alias("m2"), F.greatest(F.coalesce(v2, F.col("var")), F.lit(least)).alias("v2"))

    def gather(share):
        return F.transform(F.array(F.aggregate("h", zero, lambda s, e: F.transform(F.array(e["n"] * share(e["x"])), lambda r: F.struct((s["n"] + r).alias("n"), (s["x"] + r * e["x"]).alias("x"), (s["q"] + r * e["x"] * e["x"]).alias("q")))[0])), fitted)[0]

    def both(p, x):
        return (1 - p["w"]) * _normal(x, p["m1"], p["v1"]), p["w"] * _normal(x, p["m2"], p["v2"])

    def upper(p):
        return lambda x: F.coalesce(F.try_divide(both(p, x)[1], both(p, x)[0] + both(p, x)[1]), F.lit(0.5))

    a = a.withColumn("first", gather(lambda x: F.when(x > F.col("mean"), 1.0).otherwise(0.0)))
    a = a.withColumn("fit", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.col("first"), lambda p, _: gather(upper(p))))
    tiny = F.lit(1e-300)
    fit = F.col("fit")
    one = F.aggregate("h", F.lit(0.0), lambda s, e: s + e["n"] * F.log(F.greatest(_normal(e["x"], F.col("mean"), F.col("var")), tiny)))
    two = F.aggregate("h", F.lit(0.0), lambda s, e: s + e["n"] * F.log(F.greatest(both(fit, e["x"])[0] + both(fit, e["x"])[1], tiny)))
    a = a.withColumn("two", (-2 * two + 5 * F.log("n")) < (-2 * one + 2 * F.log("n")))
    low, high = F.least(fit["m1"], fit["m2"]), F.greatest(fit["m1"], fit["m2"])
    inner = F.filter(F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: b + 0.5), lambda x: (x > low) & (x < high))
    valley = F.array_min(F.transform(inner, lambda x: F.struct(F.round(both(fit, x)[0] + both(fit, x)[1], 12).alias("d"), x.alias("x"))))["x"].cast("double")
    t = F.when(F.col("two"), F.coalesce(valley, (low + high) / 2)).otherwise(F.col("mean") + 2 * F.sqrt("var"))
    return a.select("topic", "two", F.floor(t).alias("bin"), (F.col("low") + t * F.col("width")).alias("threshold"))
