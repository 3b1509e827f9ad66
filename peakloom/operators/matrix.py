"""Sparse matrices as COO tables (obs_id, var_id, value) with obs (obs_id, grp). An absent entry is zero everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-6


def group_sizes(obs: DataFrame) -> DataFrame:
    return obs.groupBy("grp").agg(F.count(F.lit(1)).alias("n_g"))


def group_means(entries: DataFrame, obs: DataFrame) -> DataFrame:
    """(var_id, grp, n_g, total, mean, nnz) for every variable and group, zeros included. Groups are few: a bounded set."""
    sums = entries.join(obs, "obs_id").groupBy("var_id", "grp").agg(F.sum("value").alias("t"), F.count_if(F.col("value") != 0).alias("c"))
    grid = entries.select("var_id").distinct().join(group_sizes(obs))
    out = grid.join(sums, ["var_id", "grp"], "left")
    total = F.coalesce("t", F.lit(0.0))
    return out.select("var_id", "grp", "n_g", total.alias("total"), (total / F.col("n_g")).alias("mean"), F.coalesce("c", F.lit(0)).alias("nnz"))


def profile(entries: DataFrame, obs: DataFrame) -> DataFrame:
    """(var_id, prevalence, strength, specificity): shares over all observations; specificity = max / mean of group means."""
    g = group_means(entries, obs).groupBy("var_id").agg(F.sum("nnz").alias("nnz"), F.sum("total").alias("total"), F.sum("n_g").alias("n"), F.max("mean").alias("top"), F.avg("mean").alias("avg"))
    return g.select("var_id", (F.col("nnz") / F.col("n")).alias("prevalence"), (F.col("total") / F.col("n")).alias("strength"), F.try_divide("top", "avg").alias("specificity"))


def fold_change(entries: DataFrame, obs: DataFrame) -> DataFrame:
    """(var_id, grp, eff): log2 of the group's mean over the mean of the rest."""
    m = group_means(entries, obs)
    w = Window.partitionBy("var_id")
    rest = (F.sum("total").over(w) - F.col("total")) / (F.sum("n_g").over(w) - F.col("n_g"))
    return m.withColumn("rest", rest).select("var_id", "grp", (F.log2(F.col("mean") + EPS) - F.log2(F.col("rest") + EPS)).alias("eff"))


def log_cp10k(entries: DataFrame) -> DataFrame:
    """log1p(value / row sum * 1e4); a zero stays zero, a row sum of zero counts as 1."""
    total = F.sum("value").over(Window.partitionBy("obs_id"))
    return entries.select("obs_id", "var_id", F.log1p(F.col("value") / F.when(total == 0, 1.0).otherwise(total) * 1e4).alias("value"))


def unit(z: Column) -> Column:
    """L2-normalised array; a zero vector is divided by 1."""
    norm = F.sqrt(F.aggregate(z, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(z, lambda x: x.cast("double") / F.when(norm == 0, 1.0).otherwise(norm))


def metacell_means(members: DataFrame, entries: DataFrame, mean: bool = True) -> DataFrame:
    """(metacell, var_id, value): sum over members (a multiset) by their number; zeros of members count."""
    size = members.groupBy("metacell").agg(F.count(F.lit(1)).alias("k"))
    s = members.join(entries, "obs_id").groupBy("metacell", "var_id").agg(F.sum("value").alias("value"))
    return s.join(size, "metacell").select("metacell", "var_id", (F.col("value") / F.col("k") if mean else F.col("value")).alias("value"))


def ranks(entries: DataFrame, n: DataFrame, by: list[str]) -> DataFrame:
    """Average ranks of the non-zeros of each variable within `by`, shifted so that a zero has rank 0.

    entries: positive values; n: (by, n) observations. Adds n0 zeros' count, r0 = (n0 + 1) / 2 and the tie size.
    """
    keys = [*by, "var_id"]
    e = entries.where("value > 0")
    # Values are counted and ranked once each, then met by the rows that have them: no variable is one task of all its rows.
    w = Window.partitionBy(*keys)
    v = e.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("tie"))
    v = v.withColumns({"_m": F.sum("tie").over(w), "_r": F.sum("tie").over(w.orderBy("value")) - F.col("tie") + 1})
    e = e.join(v, [*keys, "value"])
    e = (e.join(n, by) if by else e.join(F.broadcast(n))).withColumn("n0", F.col("n") - F.col("_m"))  # without `by`, n is one row
    r0 = (F.col("n0") + 1) / 2
    return e.withColumns({"r0": r0, "rank": F.col("n0") + F.col("_r") + (F.col("tie") - 1) / 2}).withColumn("shifted", F.col("rank") - F.col("r0")).drop("_m", "_r")


def rank_sum_test(entries: DataFrame, obs: DataFrame) -> DataFrame:
    """One-sided Mann-Whitney of each group against the rest: (var_id, grp, n1, u, z, eff) with tie correction, zeros
    algebraic; eff is the log2 fold change of the group's mean over that of the rest.

    Entries are counted by variable, value and group first; ranks, ties and sums come from these counts, so a variable
    that all observations have is as many rows as it has values. Groups are few.
    """
    c = entries.where("value > 0").join(obs, "obs_id").groupBy("var_id", "value", "grp").agg(F.count(F.lit(1)).alias("c"))
    of_var = Window.partitionBy("var_id")
    c = c.withColumns({"m": F.sum("c").over(of_var), "upto": F.sum("c").over(of_var.orderBy("value")), "tie": F.sum("c").over(Window.partitionBy("var_id", "value"))})
    above_zeros = F.col("upto") - F.col("tie") + (F.col("tie") + 1) / 2
    own = c.groupBy("var_id", "grp").agg(F.sum(F.col("c") * above_zeros).alias("s"), F.sum("c").alias("c"), F.sum(F.col("c") * F.col("value")).alias("t"), F.sum(F.col("c").cast("double") * (F.col("tie") * F.col("tie") - 1)).alias("k"), F.first("m").alias("m"))
    g = own.groupBy("var_id").agg(F.map_from_entries(F.collect_list(F.struct("grp", F.struct("s", "c", "t")))).alias("own"), F.sum("k").alias("k"), F.first("m").alias("m"), F.sum("t").alias("total"))
    grid = g.join(F.broadcast(group_sizes(obs))).join(F.broadcast(obs.agg(F.count(F.lit(1)).alias("n")))).withColumn("own", F.try_element_at("own", F.col("grp")))
    grid = grid.select("var_id", "grp", "k", "n", "total", F.col("n_g").alias("n1"), (F.col("n") - F.col("n_g")).alias("n2"), (F.col("n") - F.col("m")).cast("double").alias("n0"), *(F.coalesce(F.col("own").getField(x), F.lit(0)).alias(x) for x in ("s", "c", "t")))
    n1, n2, n, n0 = (F.col(x) for x in ("n1", "n2", "n", "n0"))
    total = F.col("s") + F.col("c") * n0 + (n1 - F.col("c")) * (n0 + 1) / 2
    u = total - n1 * (n1 + 1) / 2
    var = n1 * n2 / 12 * ((n + 1) - F.coalesce(F.try_divide(F.col("k") + n0 * n0 * n0 - n0, n * (n - 1)), F.lit(0.0)))
    eff = F.log2(F.try_divide("t", n1) + EPS) - F.log2(F.try_divide(F.col("total") - F.col("t"), n2) + EPS)
    return grid.select("var_id", "grp", "n1", u.alias("u"), ((u - n1 * n2 / 2 - 0.5) / F.sqrt(F.greatest(var, F.lit(1e-12)))).alias("z"), eff.alias("eff"))


def benjamini_hochberg(df: DataFrame, p: str, by: list[str], out: str = "q") -> DataFrame:
    """q per group: the running minimum, from the largest p, of p n / rank; clipped to 0..1. Ties of p share the least.

    Equal p are counted first; ranks and running minima then go in two levels, inside buckets of the logarithm of p and
    over the buckets of a group, which are at most 64 for each power of two: no group is one task. A p that is null or NaN is no test and has no q.
    """
    v = df.where(F.col(p).isNotNull() & ~F.isnan(F.col(p))).groupBy(*by, F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("_m"))
    v = v.withColumn("_b", F.when(F.col("_p") <= 0, 1 << 20).otherwise(F.floor(-F.log2("_p") * 64)).cast("int"))
    inside, over = Window.partitionBy(*by, "_b"), Window.partitionBy(*by)
    upto = F.sum("_m").over(inside.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0))
    v = v.withColumn("_upto", upto)
    heads = v.groupBy(*by, "_b").agg(F.sum("_m").alias("_bm"))
    less = over.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(*by, "_b", F.coalesce(F.sum("_bm").over(less), F.lit(0)).alias("_before"), F.sum("_bm").over(over).alias("_n"))
    v = v.join(heads, [*by, "_b"]).withColumn("_v", F.col("_p") * F.col("_n") / (F.col("_upto") + F.col("_before")))
    more = over.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    after = v.groupBy(*by, "_b").agg(F.min("_v").alias("_bv"))
    after = after.select(*by, "_b", F.min("_bv").over(more).alias("_after"))
    back = inside.orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, 0)
    v = v.withColumn("_q", F.min("_v").over(back)).join(after, [*by, "_b"])
    q = F.least(F.greatest(F.least("_q", F.coalesce("_after", F.col("_q"))), F.lit(0.0)), F.lit(1.0))
    v = v.select(*by, F.col("_p").alias(p), q.alias(out))
    return df.join(v, [*by, p], "left")


def spearman(pairs: DataFrame, entries: DataFrame, obs: DataFrame) -> DataFrame:
    """(a, b, grp, n, rho) per pair of variables and group from shifted ranks: only co-non-zero rows meet; constant gives null."""
    n = obs.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    r = ranks(entries.join(obs, "obs_id"), n, ["grp"]).select("grp", "obs_id", "var_id", "shifted")
    one = r.groupBy("grp", "var_id").agg(F.sum("shifted").alias("s"), F.sum(F.col("shifted") * F.col("shifted")).alias("q"))
    left, right = r.select("grp", "obs_id", F.col("var_id").alias("a"), F.col("shifted").alias("x")), r.select("grp", "obs_id", F.col("var_id").alias("b"), F.col("shifted").alias("y"))
    cross = pairs.join(left, "a").join(right, ["grp", "obs_id", "b"]).groupBy("grp", "a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("xy"))
    grid = pairs.join(n)
    side = lambda v, k: one.select("grp", F.col("var_id").alias(v), F.col("s").alias(f"s{k}"), F.col("q").alias(f"q{k}"))
    g = grid.join(side("a", 1), ["grp", "a"], "left").join(side("b", 2), ["grp", "b"], "left").join(cross, ["grp", "a", "b"], "left").fillna(0.0, ["s1", "q1", "s2", "q2", "xy"])
    cov = F.col("xy") - F.col("s1") * F.col("s2") / F.col("n")
    v1, v2 = F.col("q1") - F.col("s1") * F.col("s1") / F.col("n"), F.col("q2") - F.col("s2") * F.col("s2") / F.col("n")
    return g.select("a", "b", "grp", "n", F.when((v1 > 1e-9) & (v2 > 1e-9), cov / F.sqrt(v1 * v2)).alias("rho"))


def fisher_z(rho: Column, n: Column) -> Column:
    return F.atanh(F.greatest(F.least(rho, F.lit(0.999999)), F.lit(-0.999999))) * F.sqrt(F.greatest(n - 3, F.lit(1)))


def contrast(z: DataFrame) -> DataFrame:
    """(a, b, best_grp, best_abs_z, second_abs_z, specificity_z, best_rho, n_scored) from (a, b, grp, rho, z); ties by group.

    No defined group gives best_grp -1; one group has no second.
    """
    z = z.withColumn("_az", F.abs("z"))
    w = Window.partitionBy("a", "b").orderBy(F.desc_nulls_last("_az"), "grp")
    r = z.withColumn("_k", F.row_number().over(w))
    first = lambda c, k: F.max(F.when((F.col("_k") == k) & F.col("_az").isNotNull(), F.col(c)))
    out = r.groupBy("a", "b").agg(first("grp", 1).alias("g"), first("_az", 1).alias("best_abs_z"), first("_az", 2).alias("second_abs_z"), first("rho", 1).alias("best_rho"), F.count("_az").alias("n_scored"))
    return out.select("a", "b", F.coalesce("g", F.lit(-1)).alias("best_grp"), "best_abs_z", "second_abs_z", (F.col("best_abs_z") - F.col("second_abs_z")).alias("specificity_z"), "best_rho", "n_scored")


def marker_success(markers: DataFrame, means: DataFrame) -> DataFrame:
    """(n_tested, frac_top1, frac_top3, frac_within_listed, median_rank) of markers (var_id, grp) by means (var_id, grp, mean).

    A marker listed for several groups is right if its group ranks within that many; equal means rank by group.
    """
    k = F.row_number().over(Window.partitionBy("var_id").orderBy(F.desc(F.round("mean", 9)), "grp"))
    listed = F.count(F.lit(1)).over(Window.partitionBy("var_id"))
    m = markers.distinct().withColumn("_n", listed).join(means.withColumn("_k", k).select("var_id", "grp", "_k"), ["var_id", "grp"])
    share = lambda ok: F.avg(ok.cast("double"))
    return m.agg(F.count(F.lit(1)).alias("n_tested"), share(F.col("_k") == 1).alias("frac_top1"), share(F.col("_k") <= 3).alias("frac_top3"), share(F.col("_k") <= F.col("_n")).alias("frac_within_listed"), F.median("_k").alias("median_rank"))


def tie_terms(entries: DataFrame, obs: DataFrame) -> DataFrame:
    """(var_id, ties): the sum of t^3 - t over each variable's values, its zeros included."""
    n = F.broadcast(obs.agg(F.count(F.lit(1)).alias("n")))  # one row
    cube = lambda c: c.cast("double") * c * c - c
    v = entries.where("value <> 0").groupBy("var_id", "value").agg(F.count(F.lit(1)).alias("t"))
    g = v.groupBy("var_id").agg(F.sum(cube(F.col("t"))).alias("s"), F.sum("t").alias("m")).join(n)
    return g.select("var_id", (F.col("s") + cube(F.col("n") - F.col("m"))).alias("ties"))


def group_tracks(entries: DataFrame, obs: DataFrame, least: int = 400) -> DataFrame:
    """(grp, var_id, value): means of groups of at least so many observations, where they are not zero."""
    size = group_sizes(obs).where(F.col("n_g") >= least)
    s = entries.join(obs, "obs_id").groupBy("grp", "var_id").agg(F.sum("value").alias("s"))
    return s.join(size, "grp").where("s > 0").select("grp", "var_id", (F.col("s") / F.col("n_g")).alias("value"))
