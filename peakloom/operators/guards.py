"""Guards and ladders: joins that refuse to guess, counts of what is odd, and verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labels import agree

# Names of a group that is none.
JUNK = ("nan", "", "na", "none", "unassigned", "unknown")


def zero_based(start: Column) -> Column:
    """A 1-based start as a 0-based one; what would be negative fails the query."""
    return F.when(start >= 1, start - 1).otherwise(F.raise_error(F.concat(F.lit("start below 1: "), start.cast("string"))).cast("bigint"))


def id_kind(df: DataFrame, name: str, order: str, probe: int = 2000, more: int = 100) -> DataFrame:
    """(n_probed, n_ensembl, kind): ensembl if more than `more` of the first `probe` ids begin with ENSG, else symbol."""
    n = F.count_if(F.startswith(name, F.lit("ENSG")))
    return df.orderBy(order).limit(probe).agg(F.count(F.lit(1)).alias("n_probed"), n.alias("n_ensembl"), F.when(n > more, "ensembl").otherwise("symbol").alias("kind"))


def support(independent: Column) -> Column:
    """How far a group's independent metacells carry: over 20 strong, from 6 moderate, from 3 weak, else very weak."""
    return F.when(independent > 20, "strong").when(independent >= 6, "moderate").when(independent >= 3, "weak").otherwise("very weak")


def database_verdict(specificity: Column, prevalence: Column) -> Column:
    """Whether dropped peaks (rank-biserial effects, positive where dropped ones score higher) justify a database of one's own."""
    return F.when(specificity > 0.1, "custom").when((prevalence < -0.1) & (specificity < 0.05), "precomputed").otherwise("borderline")


def pairing_verdict(names_equal: Column, n_nan: Column, n_junk: Column, within: Column, beats: Column, tested: Column, p: Column) -> Column:
    """PASS, WARN or FAIL of a paired object: structure first, then markers, then linkage against 5 % chance (p its tail).

    Null shares are not judged.
    """
    broken = ~names_equal | (n_nan > 0) | (n_junk > 0) | F.coalesce(within < 0.5, F.lit(False))
    linked = F.when(tested.isNull() | (tested == 0), "PASS").when((p < 1e-4) & (beats / tested >= 0.15), "PASS").when(p < 0.05, "WARN").otherwise("FAIL")
    return F.when(broken, "FAIL").otherwise(linked)


def structure(entries: DataFrame, obs: DataFrame) -> DataFrame:
    """One row: observations, variables, NaNs, observations without a value other than zero, groups, and junk groups.

    entries (obs_id, var_id, value), absent is zero; obs (obs_id, grp).
    """
    per = entries.groupBy("obs_id").agg(F.count_if(F.isnan("value")).alias("nan"), F.sum(F.when(~F.isnan("value"), F.col("value"))).alias("s"))
    o = obs.join(per, "obs_id", "left")
    name = F.lower(F.btrim(F.col("grp").cast("string")))
    one = o.agg(F.count(F.lit(1)).alias("n_obs"), F.coalesce(F.sum("nan"), F.lit(0)).alias("n_nan"), F.count_if((F.coalesce("s", F.lit(0.0)) == 0) & (F.coalesce("nan", F.lit(0)) == 0)).alias("n_empty"), F.countDistinct("grp").alias("n_groups"), F.countDistinct(F.when(name.isin(*JUNK), name)).alias("n_junk"))
    return one.join(entries.agg(F.countDistinct("var_id").alias("n_vars")))  # one row each


def must_hold(df: DataFrame, lacking: DataFrame, what: str) -> DataFrame:
    """df, or a failed query if `lacking` has rows; at most five of them are told."""
    few = [r[0] for r in lacking.limit(5).collect()]
    if few:
        raise ValueError(f"{what}: {few}")
    return df


def latents_for(obs: DataFrame, latents: DataFrame, key: str) -> DataFrame:
    """The numeric columns of latents for exactly the ids of obs; an id that is not there is fatal, other columns are left out."""
    numeric = [f.name for f in latents.schema if f.name != key and f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")]
    if not numeric:
        raise ValueError("no numeric columns to use as dimensions")
    want = obs.select(key).distinct()
    must_hold(want, want.join(latents, key, "left_anti"), f"{key} without a latent row")
    return want.join(latents.select(key, *numeric), key)


def positional_merge(left: DataFrame, right: DataFrame, most: float = 0.0, least: int = 3) -> DataFrame:
    """left with the columns that only right has, row by row of `row_idx`, once the columns of both prove the order.

    Row counts must be equal; every shared column must agree (as strings, or as numbers within 1e-4) but for a share `most`
    of rows, and at least `least` columns must be there to prove it. All columns are compared in one pass of one join.
    """
    shared = sorted(set(left.columns) & set(right.columns) - {"row_idx"})
    if len(shared) < least:
        raise ValueError(f"only {len(shared)} shared columns; {least} are needed to prove the order of rows")
    j = left.join(right.select("row_idx", *(F.col(c).alias(f"_r_{c}") for c in right.columns if c != "row_idx")), "row_idx", "full")
    differs = [F.count_if(~agree(F.col(c).cast("string"), F.col(f"_r_{c}").cast("string")) & ~(F.col(c).isNull() & F.col(f"_r_{c}").isNull())).alias(c) for c in shared]
    sizes = left.agg(F.count(F.lit(1)).alias("_n")).join(right.agg(F.count(F.lit(1)).alias("_m"))).first()
    if sizes["_n"] != sizes["_m"]:
        raise ValueError(f"{sizes['_n']} rows do not pair with {sizes['_m']}")
    found = j.agg(*differs).first()
    bad = {c: found[c] for c in shared if found[c] > most * max(1, sizes["_n"])}
    if bad:
        raise ValueError(f"columns disagree, so row i is not row i: {bad}")
    return left.join(right.select("row_idx", *(c for c in right.columns if c not in left.columns)), "row_idx")


def flags_of(df: DataFrame, flags: DataFrame, key: str, flag: str) -> DataFrame:
    """df with its flag; a key that flags lack is False, and `absent` tells so."""
    f = flags.groupBy(key).agg(F.bool_or(F.col(flag)).alias(flag), F.lit(True).alias("_there"))
    return df.join(f, key, "left").withColumns({flag: F.coalesce(flag, F.lit(False)), "absent": F.col("_there").isNull()}).drop("_there")


def usable_groups(sizes: DataFrame, scored: DataFrame, least: int = 400) -> DataFrame:
    """(grp) of at least so many metacells; none, or one that the scored table lacks, is fatal. sizes: (grp, n)."""
    keep = sizes.where(F.col("n") >= least).select("grp")
    if not keep.limit(1).count():
        raise ValueError(f"no group has {least} metacells")
    return must_hold(keep, keep.join(scored.select("grp").distinct(), "grp", "left_anti"), "groups pass but are not scored")


def tagged(frames: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """All frames, each row with the name of its frame; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn(tag, F.lit(k)) for k, df in frames.items()))


def peek(entries: DataFrame, obs: DataFrame) -> DataFrame:
    """One row of shapes, without a value read: observations, rows of the matrix, variables, stored entries, and whether the
    first names of both are equal.

    entries (obs_id, var_id, ...); obs (obs_id, ...).
    """
    o = obs.agg(F.count(F.lit(1)).alias("n_obs"), F.min("obs_id").alias("_first"))
    e = entries.agg(F.countDistinct("obs_id").alias("n_rows"), F.countDistinct("var_id").alias("n_vars"), F.count(F.lit(1)).alias("n_stored"), F.min("obs_id").alias("_own"))
    return o.join(e).select("n_obs", "n_rows", "n_vars", "n_stored", (F.col("_first") == F.col("_own")).alias("first_equal"))  # one row each
