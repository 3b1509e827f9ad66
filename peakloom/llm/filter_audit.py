"""Filter interaction audit: what each of five filters removes, under every order of applying them.

A document's failures are a mask of five bits. Documents are counted by part and mask first, so all that follows is at
most 32 cells a part, whatever the corpus. The cells are unpivoted against the steps of all 120 orders; a running bit-or
over the steps before tells what a cell has failed already, conditional sums over cells give the counts of a step, and a
window over the steps of one filter gives its total over all orders.

The failing conditions, by letter: A fewer than 100 words; B fewer than four distinct words in five; C more than one
capital A-Z in ten characters; D a sign of `#$%&*|`; E the text of a smaller id, whether that document is removed or not.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

LETTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PCT, MAX_CAPITALS_PCT, SIGNS = 100, 80, 10, "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def failures(text: Column) -> Column:
    """Bits 0 to 3 of the mask: what the text alone decides. Words are runs of other characters than six ASCII blanks."""
    inner = F.btrim(text, F.lit(BLANKS))
    listed = F.split(inner, "[ \\t-\\r]+")
    some = inner != ""
    n = F.when(some, F.size(listed)).otherwise(0)
    distinct = F.when(some, F.size(F.array_distinct(listed))).otherwise(0)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    tests = (n < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PCT * n, 100 * capitals > MAX_CAPITALS_PCT * F.length(text), text.rlike(SIGNS))
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))


def mask_cells(docs: DataFrame, labels: DataFrame, part: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part that fail just these filters, and how many of them are labelled."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text_of(text_col), 256)).alias("key"),
        failures(text_of(text_col)).alias("mask"),
    )
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.groupBy("id", "part", "key", "mask").agg(F.count(F.lit(1)).alias("n"))
    marked = rows.join(marks, "id", "left").select("id", "part", "key", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # Copies of a text fold to a row for each part and label before they are held against the text's least id.
    copies = marked.groupBy("key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min("id").alias("low"),
        F.min_by("n", "id").alias("n_low"),
    )
    least = F.min("low").over(Window.partitionBy("key"))
    firsts = F.col("nameless") + F.when(F.col("low") == least, F.col("n_low")).otherwise(0)
    two = copies.withColumn("firsts", firsts).select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("firsts").alias("n")), F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")))).alias("c"))
    return two.where("c.n > 0").groupBy("part", "c.mask").agg(F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"), F.sum(F.col("c.n") * F.col("toxic")).alias("toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per part, order and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley.

    Null texts are empty texts, null parts the part "". A row without an id is the copy of none and nobody's first;
    repeated rows are counted as rows, and rows of one id and text are not copies of each other. Documents without a
    label are neither good nor toxic; of several labels of an id the highest count. Further columns are ignored; an
    empty table has no parts and so no rows.
    """
    cells = mask_cells(docs, labels, part, id_col, text_col)
    orders = F.array(*(F.lit("".join(p)) for p in permutations(LETTERS)))
    long = cells.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(5))))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    long = long.withColumn("filter", letter).withColumn("bit", F.expr(f"shiftleft(1, locate(filter, '{LETTERS}') - 1)"))
    steps = Window.partitionBy("part", "mask", "filter_order").orderBy("step")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    before = F.coalesce(F.bit_or(F.col("mask").bitwiseAND(F.col("bit"))).over(steps.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    long = long.select("*", fails.alias("fails"), (before != 0).alias("gone"))
    here = ~F.col("gone") & F.col("fails")
    total = lambda test, n="n": F.sum(F.when(test, F.col(n)).otherwise(0))
    counts = long.groupBy("part", "filter_order", "step", "filter").agg(
        total(~F.col("gone") & ~F.col("fails")).alias("kept"),
        total(here).alias("removed"),
        total(F.col("gone") & F.col("fails")).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return counts.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"))


OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+') AS w FROM documents),
f AS (SELECT t.doc_id, part,
        (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
        + 4 * (100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x))::INT + 8 * regexp_matches(x, '[#$%&*|]')::INT
        + 16 * (coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY x), false))::INT AS mask,
        coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
      FROM t LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id) l ON t.doc_id = l.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
a AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM a p, a q, a r, a s, a u
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
k AS (SELECT filter_order, step, 1 << (instr('ABCDE', substr(filter_order, step, 1)) - 1) AS bit FROM o, range(1, 6) g(step)),
b AS (SELECT x.filter_order, x.step, x.bit, coalesce(bit_or(y.bit), 0) AS earlier FROM k x LEFT JOIN k y
      ON x.filter_order = y.filter_order AND y.step < x.step GROUP BY ALL),
m AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & earlier <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, b GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM m
"""
