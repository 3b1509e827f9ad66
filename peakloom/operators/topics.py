"""Accessible matrices, topics and variable features."""

from __future__ import annotations

import re
import tempfile

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PASSES = 150


def accessible(entries: DataFrame, is_acc: float = 1, min_obs: int = 1, min_vars: int = 1) -> DataFrame:
    """(obs_id, var_id): entries of is_acc or more, of variables in min_obs observations and then observations with min_vars."""
    e = entries.where(F.col("value") >= is_acc).select("obs_id", "var_id")
    e = e.withColumn("_v", F.count(F.lit(1)).over(Window.partitionBy("var_id"))).where(F.col("_v") >= min_obs).drop("_v")
    return e.withColumn("_o", F.count(F.lit(1)).over(Window.partitionBy("obs_id"))).where(F.col("_o") >= min_vars).drop("_o")


def kept(df: DataFrame) -> DataFrame:
    """df computed once, in as many partitions as its size needs, in the folder of spark.checkpoint.dir, which a cluster must set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None and re.fullmatch(r"local(\[.*\])?", context.master):
        context.setCheckpointDir(f"{tempfile.gettempdir()}/peakloom-checkpoints")
    return df.checkpoint()


def topic_vectors(cells: DataFrame) -> tuple[CountVectorizerModel, DataFrame]:
    """Vocabulary and vectors (obs_id, features) of (obs_id, var_id). Cells are read once, and the vectors, over which a
    model passes many times, are kept."""
    rows = kept(cells.groupBy("obs_id").agg(F.array_sort(F.collect_list("var_id")).alias("vars")))
    # The vectorizer keeps 2^18 words unless told: no variable is left out, however many there are.
    every = max(1, rows.select(F.explode("vars").alias("v")).agg(F.countDistinct("v")).first()[0])
    words = CountVectorizer(inputCol="vars", outputCol="features", binary=True, vocabSize=every).fit(rows)
    return words, kept(words.transform(rows).select("obs_id", "features"))


def fitted(vectors: DataFrame, k: int, seed: int = 555, iterations: int = PASSES) -> LDAModel:
    """The model of k topics by expectation and maximisation, each pass of which reads every entry of every cell.

    The online optimiser draws one cell in twenty a pass and moves its random start by three hundredths of the way. Priors are
    the library's, 50 / k on a cell's topics and 0.1 on a topic's variables (each and one, as a mode is sought).
    """
    return LDA(k=k, seed=seed, maxIter=iterations, optimizer="em").fit(vectors).toLocal()


def fit_topics(cells: DataFrame, k: int, seed: int = 555, iterations: int = PASSES) -> tuple[CountVectorizerModel, LDAModel, DataFrame]:
    """Vocabulary, model, and the kept vectors of (obs_id, var_id); a sampler's topics differ in number and order."""
    words, vectors = topic_vectors(cells)
    return words, fitted(vectors, k, seed, iterations), vectors


def heaviest(model: LDAModel, words: CountVectorizerModel, n: int) -> DataFrame:
    """(topic, vars, weights) of the n heaviest variables of each topic; names are a table that meets these few rows."""
    top = model.describeTopics(n).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "t"))
    names = top.sparkSession.createDataFrame(list(enumerate(words.vocabulary)), "i int, name string")
    named = names.join(F.broadcast(top.select("topic", "place", F.col("t.termIndices").alias("i"), F.col("t.termWeights").alias("w"))), "i")
    g = named.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("place", "name", "w"))).alias("x"))
    return g.select("topic", F.col("x.name").alias("vars"), F.col("x.w").alias("weights"))


def choose_model(quality: dict[int, dict[str, float]], lower_is_better: tuple[str, ...] = ("perplexity",)) -> int:
    """The topic number with the best mean of metrics rescaled to 0..1; one model is itself, equal metrics do not count."""
    if not quality:
        raise ValueError("no models to choose from")
    names = sorted(set.intersection(*(set(q) for q in quality.values())))
    total = dict.fromkeys(quality, 0.0)
    for m in names:
        low, high = min(q[m] for q in quality.values()), max(q[m] for q in quality.values())
        for k, q in quality.items():
            if high > low:
                x = (q[m] - low) / (high - low)
                total[k] += 1 - x if m in lower_is_better else x
    return max(sorted(total), key=lambda k: total[k])


def top_regions(weights: DataFrame, n: int) -> DataFrame:
    """(topic, region) of the n heaviest regions of each topic, ties by region; weights: (topic, region, weight)."""
    return weights.withColumn("_k", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "region"))).where(F.col("_k") <= n).select("topic", "region", "weight")


def _histogram(weights: DataFrame, bins: int) -> DataFrame:
    """(topic, low, high, bin, n): weights in equal bins of the topic's range. A topic of one weight only has none."""
    r = weights.groupBy("topic").agg(F.min("weight").alias("low"), F.max("weight").alias("high")).where("high > low")
    b = F.least(F.floor((F.col("weight") - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1))
    return weights.join(r, "topic").groupBy("topic", "low", "high", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def otsu(weights: DataFrame, bins: int = 64) -> DataFrame:
    """(topic, bin, threshold): the split of each topic's weights of largest variance between the classes; the first of equals.

    A region is in the topic if its weight is over the threshold.
    """
    h = _histogram(weights, bins)
    w = Window.partitionBy("topic")
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumns({"w0": F.sum("n").over(upto).cast("double"), "s0": F.sum(F.col("n") * F.col("bin")).over(upto).cast("double"), "w": F.sum("n").over(w).cast("double"), "s": F.sum(F.col("n") * F.col("bin")).over(w).cast("double")})
    d = F.col("s0") * F.col("w") - F.col("s") * F.col("w0")
    return _split(h.where("w0 < w").withColumn("v", -(d * d / (F.col("w0") * (F.col("w") - F.col("w0"))))), bins, 1.0)


def yen(weights: DataFrame, bins: int = 64) -> DataFrame:
    """(topic, bin, threshold) by Yen's criterion of maximum correlation; the first of equals. The threshold is a bin's middle."""
    h = _histogram(weights, bins)
    w = Window.partitionBy("topic")
    upto, after = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0), w.orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    f = F.col("n") / F.sum("n").over(w)
    h = h.withColumn("f", f).withColumns({"p": F.sum("f").over(upto), "p2": F.sum(F.col("f") * F.col("f")).over(upto), "q2": F.sum(F.col("f") * F.col("f")).over(after)})
    v = F.log(F.pow(F.col("p") * (1 - F.col("p")), F.lit(2)) / (F.col("p2") * F.col("q2")))
    return _split(h.where("q2 is not null").withColumn("v", -F.round(v, 9)), bins, 0.5)


def _split(scored: DataFrame, bins: int, at: float) -> DataFrame:
    """The bin of the least v of each topic; the threshold lies `at` in it (1 is its end)."""
    best = scored.groupBy("topic").agg(F.min(F.struct("v", "bin", "low", "high")).alias("b"))
    return best.select("topic", F.col("b.bin").alias("bin"), (F.col("b.low") + (F.col("b.bin") + at) * (F.col("b.high") - F.col("b.low")) / bins).alias("threshold"))


def topic_quality(weights: DataFrame) -> DataFrame:
    """(topic, n_regions, total, top, share_top, entropy): how many regions a topic has, its heaviest, and how evenly it spreads."""
    w = Window.partitionBy("topic")
    f = weights.where("weight > 0").withColumn("f", F.col("weight") / F.sum("weight").over(w))
    return f.groupBy("topic").agg(F.count(F.lit(1)).alias("n_regions"), F.sum("weight").alias("total"), F.max("weight").alias("top"), F.max("f").alias("share_top"), (-F.sum(F.col("f") * F.log("f"))).alias("entropy"))


def variable_features(entries: DataFrame, obs: DataFrame, bins: int = 20) -> DataFrame:
    """(var_id, mean, dispersion, score): variance over mean, standardised within equal bins of the mean; zeros count.

    A bin of one variable scores 1; a bin without deviation scores null.
    """
    n = F.broadcast(obs.agg(F.count(F.lit(1)).alias("n")))  # one row
    v = entries.groupBy("var_id").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q")).join(n).where("s > 0")
    mean = F.col("s") / F.col("n")
    v = v.select("var_id", mean.alias("mean"), (((F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)) / mean).alias("dispersion"))
    r = F.broadcast(v.agg(F.min("mean").alias("low"), F.max("mean").alias("high")))  # one row
    b = F.when(F.col("high") > F.col("low"), F.least(F.floor((F.col("mean") - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1))).otherwise(0)
    w = Window.partitionBy("_b")
    score = F.when(F.count(F.lit(1)).over(w) == 1, 1.0).otherwise(F.try_divide(F.col("dispersion") - F.avg("dispersion").over(w), F.stddev_samp("dispersion").over(w)))
    return v.join(r).withColumn("_b", b).withColumn("score", score).select("var_id", "mean", "dispersion", "score")
