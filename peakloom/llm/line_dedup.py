"""Line dedup by site-relative frequency.

For each host, a line's ratio is the number of its pages that contain the line over the number of its pages. Lines
beyond `ratio` (and on `min_pages` pages at least) are boilerplate and are dropped from every page of that host.

Everything is DataFrame operations. Lines are counted once a page and summed before the shuffle, so a hot line or host
is a few partial sums; rare lines go before the join with host totals. A line beyond the ratio takes a share of its
host's pages, so a host's boilerplate is at most 1/ratio times the lines of its average page: texts stay where they are
and meet their host's lines by a broadcast, as long as all hosts' lines are proven to fit `BROADCAST_BYTES`. Beyond that
pages meet the lines found on them in plain joins, which Spark splits where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, text_of, written

RATIO = 0.05  # on more than one page in twenty
MIN_PAGES = 3
BLANKS = " \t\r"
BROADCAST_BYTES = 64 << 20  # of all hosts' boilerplate; beyond it texts are joined with what was found on them


def _lines(text):
    return F.split(text, "\n", -1)


def _trimmed(line):
    return F.btrim(line, F.lit(BLANKS))


def drop_boilerplate(docs: DataFrame, host, text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(row, n_lines, n_dropped) of every input row: `row` is a struct of the input's columns with `text_col` rid of
    boilerplate lines, so that no column of the input can clash with the counts or with ours.

    host: a column expression; null counts as the host "". Lines are compared without surrounding blanks; blank lines
    are neither counted nor dropped. A line that repeats on a page counts once there and all its places are dropped.
    Null texts stay null (0 lines), empty texts are one blank line. Every row is a page, repeated rows too.
    """
    base = docs.select(F.coalesce(host, F.lit("")).alias("_host"), F.unhex(F.md5(text_of(text_col))).alias("_key"), text_of(text_col).alias("_text"))
    lines = (
        base.select("_host", "_key", F.explode(F.array_distinct(F.transform(_lines(F.col("_text")), _trimmed))).alias("_line"))
        .where(F.col("_line") != "")
        .select("_host", "_key", F.xxhash64("_line").alias("_a"), F.xxhash64(F.lit(1), "_line").alias("_b"))
    )
    counts = lines.groupBy("_host", "_a", "_b").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_pages)
    pages = base.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    boilerplate = written(counts.join(pages, "_host").where(F.col("_n") > ratio * F.col("_pages")).select("_host", "_a", "_b"))
    size = boilerplate.agg(F.sum(F.octet_length("_host") + 24).alias("n")).first()["n"] or 0
    keyed = docs.select(packed(docs), F.coalesce(host, F.lit("")).alias("_host"), F.unhex(F.md5(text_of(text_col))).alias("_key"), F.col(text_col).alias("_text"))
    if size <= BROADCAST_BYTES:
        per_host = boilerplate.groupBy("_host").agg(F.collect_set("_a").alias("_bad"))
        joined = keyed.join(F.broadcast(per_host), "_host", "left")
    else:
        hits = written(lines.join(boilerplate, ["_host", "_a", "_b"]).groupBy("_host", "_key").agg(F.collect_set("_a").alias("_bad")))
        joined = keyed.join(hits, ["_host", "_key"], "left")
    # The page's own boilerplate is found once by hash, then bound to a name that the filter of its lines sees.
    found = F.array_intersect(F.transform(_lines(F.col("_text")), lambda x: F.xxhash64(_trimmed(x))), F.col("_bad"))
    kept = F.transform(F.array(found), lambda bad: F.filter(_lines(F.col("_text")), lambda x: ~F.array_contains(bad, F.xxhash64(_trimmed(x)))))[0]
    joined = joined.withColumn("_lines", F.when(F.col("_bad").isNotNull(), kept))
    none = F.lit(0).cast("bigint")
    n = F.when(F.col("_text").isNull(), none).otherwise(F.size(_lines(F.col("_text"))).cast("bigint"))
    dropped = F.when(F.col("_lines").isNull(), none).otherwise(n - F.size("_lines"))
    cleaned = F.when(F.col("_lines").isNull(), F.col("_text")).otherwise(F.array_join("_lines", "\n"))
    columns = [cleaned.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    return joined.select(F.struct(*columns).alias("row"), n.alias("n_lines"), dropped.alias("n_dropped"))
