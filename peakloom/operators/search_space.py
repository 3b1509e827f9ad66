"""The search space of genes: peaks near a gene's body, with strand-relative distances, optionally up to the next gene."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import intervals

STRIPE = 10_000_000  # base pairs of a chromosome whose genes are sorted in one task


def neighbours(genes: DataFrame, stripe: int = STRIPE) -> DataFrame:
    """genes (gene, chrom, start, end, ...) with prev_end, the furthest end of genes that begin before, and next_start, the
    beginning of the next gene; genes are in order of start, end and name. Null where there is none.

    Genes are sorted in stripes; what lies over a stripe's ends comes from the stripes' own extremes.
    """
    g = genes.withColumn("_s", F.floor(F.col("start") / stripe))
    inside = Window.partitionBy("chrom", "_s").orderBy("start", "end", "gene")
    g = g.withColumns({"_p": F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1)), "_n": F.lead("start").over(inside)})
    heads = g.groupBy("chrom", "_s").agg(F.max("end").alias("_e"), F.min("start").alias("_b"))
    over = Window.partitionBy("chrom").orderBy("_s")
    heads = heads.select("chrom", "_s", F.max("_e").over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"), F.lead("_b").over(over).alias("_after"))
    g = g.join(heads, ["chrom", "_s"])
    return g.select(*genes.columns, F.greatest("_p", "_before").alias("prev_end"), F.coalesce("_n", "_after").alias("next_start"))


def spaces(genes: DataFrame, upstream: tuple[int, int] = (1000, 150_000), downstream: tuple[int, int] = (1000, 150_000), boundaries: bool = False) -> DataFrame:
    """genes (gene, chrom, start, end, strand) with the span (left, right) of their search space.

    (least, most) of a side: up to `most`, or with `boundaries` up to the neighbouring gene, but `least` always, even
    with another gene there. A gene that another one reaches into, or lies in, has no room on that side.
    """
    plus = F.col("strand") != "-"
    side = lambda a, b: (F.when(plus, a[0]).otherwise(b[0]), F.when(plus, a[1]).otherwise(b[1]))
    (least_left, most_left), (least_right, most_right) = side(upstream, downstream), side(downstream, upstream)
    if not boundaries:
        return genes.withColumns({"left": F.col("start") - F.greatest(least_left, most_left), "right": F.col("end") + F.greatest(least_right, most_right)})
    g = neighbours(genes)
    open_ = lambda room: F.when(room < 0, 0).otherwise(room)  # noqa: E731  null: no gene on that side
    room_left = open_(F.col("start") - F.col("prev_end"))
    room_right = F.when(F.col("prev_end") > F.col("end"), 0).otherwise(open_(F.col("next_start") - F.col("end")))
    reach = lambda room, least, most: F.greatest(least, F.least(most, F.coalesce(room, most)))
    out = g.withColumns({"left": F.col("start") - reach(room_left, least_left, most_left), "right": F.col("end") + reach(room_right, least_right, most_right)})
    return out.select(*genes.columns, "left", "right")


def search_space(
    peaks: DataFrame,
    genes: DataFrame,
    upstream: tuple[int, int] = (1000, 150_000),
    downstream: tuple[int, int] = (1000, 150_000),
    extend_tss: tuple[int, int] = (10, 10),
    boundaries: bool = False,
) -> DataFrame:
    """(gene, chrom, start, end, distance, promoter): peaks (chrom, start, end) that meet a gene's space.

    distance: of the peak's middle to the gene's body, 0 inside, negative upstream. promoter: the peak meets the window
    of `extend_tss` (upstream, downstream) about the gene's start. Genes of one span are joined once.
    """
    s = spaces(genes, upstream, downstream, boundaries)
    spans = s.select("chrom", F.col("left").alias("start"), F.col("right").alias("end")).distinct()
    met = intervals.overlaps(peaks.select("chrom", "start", "end").distinct(), spans, 32768).drop("ov")
    own = s.select("gene", "chrom", F.col("start").alias("bs"), F.col("end").alias("be"), "strand", F.col("left").alias("r_start"), F.col("right").alias("r_end"))
    j = met.join(own, ["chrom", "r_start", "r_end"])
    plus, mid = F.col("strand") != "-", F.floor((F.col("start") + F.col("end")) / 2)
    along = F.when(mid < F.col("bs"), mid - F.col("bs")).when(mid > F.col("be"), mid - F.col("be")).otherwise(0)
    tss_low = F.when(plus, F.col("bs") - extend_tss[0]).otherwise(F.col("be") - extend_tss[1])
    tss_high = F.when(plus, F.col("bs") + extend_tss[1]).otherwise(F.col("be") + extend_tss[0])
    return j.select("gene", "chrom", "start", "end", F.when(plus, along).otherwise(-along).cast("bigint").alias("distance"), ((F.col("start") < tss_high) & (tss_low < F.col("end"))).alias("promoter"))
