"""Feature-to-target links: cleaning, sign classes, top-N, anchors, export projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import parse


def unwrap(distance: Column) -> Column:
    """'[-126154]' -> -126154; empty or malformed -> null."""
    return F.btrim(distance, F.lit("[] ")).try_cast("bigint")


def sign_of_name(name: Column) -> Column:
    """The text after the last underscore if it holds a slash, else '?'."""
    last = F.element_at(F.split(name, "_"), -1)
    return F.when(F.contains(last, F.lit("/")), last).otherwise("?")


def group_of_metacell(name: Column) -> Column:
    return F.regexp_extract(name, r"^(.*)_mc[^_]*$", 1)


# Colours of positive and of other links.
POSITIVE, NEGATIVE = "31,111,180", "201,97,31"


def safe_name(name: Column, browser: bool = False) -> Column:
    return F.translate(name, " /", "_-") if browser else F.regexp_replace(name, r"[^0-9A-Za-z_.-]+", "_")


def sign_counts(links: DataFrame) -> DataFrame:
    r = F.when(~F.isnan("rho"), F.col("rho"))
    return links.select(r.alias("rho")).agg(F.count_if(F.col("rho") > 0).alias("n_positive"), F.count_if(F.col("rho") < 0).alias("n_negative"), F.count_if(F.col("rho") == 0).alias("n_zero"), F.count_if(F.col("rho").isNull()).alias("n_undefined"))


def top_per(links: DataFrame, by: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group in a total order; n = 0 keeps all. Spark prunes with a partial group limit."""
    if n == 0:
        return links
    return links.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_k") <= n).drop("_k")


def topn_report(effects: DataFrame, tops: list[int], share: float = 0.005) -> DataFrame:
    """(top_n, n_short, cutoff_lo, cutoff_hi, fold_lo, fold_hi, expected, n_lines) of sets of equal size; effects: (grp, var_id, eff).

    A group of fewer variables is short and takes them all; its last effect is its cutoff. expected: regions that would
    land in a window of `share` of the ranks by chance.
    """
    w = Window.partitionBy("grp")
    most = max(tops)
    k = effects.withColumns({"_m": F.count(F.lit(1)).over(w), "_k": F.row_number().over(w.orderBy(F.desc("eff"), "var_id"))}).where(F.col("_k") <= most)
    x = k.withColumn("top_n", F.explode(F.array(*map(F.lit, tops)))).where(F.col("_k") == F.least("top_n", "_m"))
    g = x.groupBy("top_n").agg(F.count_if(F.col("_m") < F.col("top_n")).alias("n_short"), F.min("eff").alias("cutoff_lo"), F.max("eff").alias("cutoff_hi"), (F.count(F.lit(1)) * F.col("top_n")).alias("n_lines"))
    return g.withColumns({"fold_lo": F.pow(F.lit(2.0), "cutoff_lo"), "fold_hi": F.pow(F.lit(2.0), "cutoff_hi"), "expected": F.col("top_n") * F.lit(share)})


def strong(links: DataFrame, n: int = 20, least: float = 0.05) -> DataFrame:
    """The top n links of each target by importance among those of |rho| >= least (null and NaN fail)."""
    ok = links.where(F.col("rho").isNotNull() & ~F.isnan("rho") & (F.abs("rho") >= least))
    return top_per(ok, "target", [F.desc("importance"), F.asc("region")], n)


def bedpe(links: DataFrame, strands: DataFrame) -> DataFrame:
    """One BEDPE row per link: region, target site, score = round(1000 |rho|) clipped, strand from `strands` or '.'."""
    at = parse(F.col("region"))
    j = links.withColumn("_p", at).where("_p is not null").join(strands, "target", "left")
    score = F.bround(1000 * F.least(F.greatest(F.abs(F.coalesce("rho", F.lit(0.0))), F.lit(0.0)), F.lit(1.0))).cast("int")
    return j.select(F.col("_p.chrom").alias("chrom1"), F.col("_p.start").alias("start1"), F.col("_p.end").alias("end1"), F.coalesce("chrom", F.lit(".")).alias("chrom2"), F.coalesce("tss", F.lit(-1)).alias("start2"), F.concat_ws("|", "target", "region").alias("name"), score.alias("score"), F.coalesce("strand", F.lit(".")).alias("strand2"))


def placed(links: DataFrame) -> DataFrame:
    """Links whose region and distance can be read."""
    return links.where(parse(F.col("region")).isNotNull() & unwrap(F.col("distance")).isNotNull())


def _grid(sites: DataFrame) -> DataFrame:
    """(target, _sites, _low, _width, _at) of sites (target, row_idx, tss): a target's starts in order, transcripts of one
    start being one site, that of the first row; as many bins as starts, of _width from _low; starts that lie before each bin.
    """
    one = sites.where("tss is not null").groupBy("target", "tss").agg(F.min("row_idx").alias("row_idx"))
    of = one.groupBy("target").agg(F.array_sort(F.collect_list(F.struct("tss", "row_idx"))).alias("_sites"), F.min("tss").alias("_low"), F.max("tss").alias("_high"), F.count(F.lit(1)).alias("_n"))
    of = of.withColumn("_width", F.floor((F.col("_high") - F.col("_low")) / F.col("_n")) + 1)
    before = lambda b: F.size(F.filter("_sites", lambda s: F.floor((s["tss"] - F.col("_low")) / F.col("_width")) < b))
    return of.select("target", "_sites", "_low", "_width", F.transform(F.sequence(F.lit(0), F.col("_n").cast("int")), before).alias("_at"))


def anchors(links: DataFrame, sites: DataFrame, keep: tuple = ()) -> DataFrame:
    """The transcription start whose distance to the region's middle is closest to |distance|; first row on a tie.

    sites: (target, row_idx, tss). A target without sites is placed at middle - |distance| with a null error. A target's
    starts travel as one array, so a link stays one row; it looks only at those in, next before and next after the bins
    of its two places, middle - |distance| and middle + |distance|. `keep`: more columns of links.
    """
    l = links.withColumns({"_p": parse(F.col("region")), "d": unwrap(F.col("distance"))}).where("_p is not null and d is not null")
    l = l.withColumn("mid", F.floor((F.col("_p.start") + F.col("_p.end")) / 2)).select("target", "region", F.abs("d").alias("d"), "mid", *keep).join(_grid(sites), "target", "left")

    def about(place: Column) -> Column:
        b = F.least(F.greatest(F.floor((place - F.col("_low")) / F.col("_width")), F.lit(0)), F.size("_at") - 2).cast("int")
        first = F.greatest(F.get("_at", b), F.lit(1))
        return F.slice("_sites", first, F.get("_at", b + 1) - first + 2)

    near = F.transform(F.concat(about(F.col("mid") - F.col("d")), about(F.col("mid") + F.col("d"))), lambda s: F.struct(F.abs(F.abs(s["tss"] - F.col("mid")) - F.col("d")).alias("e"), s["row_idx"].alias("i"), s["tss"].alias("t")))
    return l.withColumn("b", F.array_min(near)).select("target", "region", F.coalesce("b.t", F.col("mid") - F.col("d")).alias("anchor"), F.col("b.e").alias("err"), *keep)


def interact(links: DataFrame, group: str, z: str, n: int = 50000) -> DataFrame:
    """Browser rows: the top n of a group by z, score 0-1000 relative to the group's largest z, colour as r,g,b by sign of rho."""
    top = top_per(links, group, [F.desc(z), F.asc("region"), F.asc("target")], n)
    score = F.least(F.greatest(F.bround(F.col(z) / F.max(z).over(Window.partitionBy(group)) * 1000), F.lit(0.0)), F.lit(1000.0)).cast("int")
    return top.select("target", "region", F.col(group), score.alias("score"), F.when(F.col("rho") > 0, POSITIVE).otherwise(NEGATIVE).alias("color"))


def specific(links: DataFrame, z: str, rho: str, distance: str, least_z: float, least_rho: float) -> DataFrame:
    """Links of a z of least_z or more, an absolute rho of least_rho or more, and a known distance; null and NaN are neither.

    distance may be a number or a list written as text.
    """
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    known = unwrap(F.col(distance)) if links.schema[distance].dataType.simpleString() == "string" else number(distance)
    return links.where((number(z) >= least_z) & (F.abs(number(rho)) >= least_rho) & known.isNotNull())


def present(links: DataFrame, regions: DataFrame, targets: DataFrame) -> DataFrame:
    """Links whose region and target both exist; regions: (region), targets: (target). None left is fatal."""
    kept = links.join(regions.select("region").distinct(), "region", "left_semi").join(targets.select("target").distinct(), "target", "left_semi")
    if not kept.limit(1).count():
        raise ValueError("no link has both its region and its target: another object, or ids of another form")
    return kept
