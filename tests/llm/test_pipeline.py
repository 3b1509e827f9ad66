"""Every stage against its own input, and run() from end to end."""

import corpus_pipeline
from peakloom.llm import line_dedup, quality_mil
from pyspark.sql import functions as F
from tests.llm.data import documents
from tests.llm.test_near import brute_classes
from tests.llm.test_texts import brute_hits
from peakloom.llm.common import words


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("score", F.lit("clash"))
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        kept[name] = (docs, out)
        docs = out
    before, after = kept["quality"]
    model = quality_mil.train(before, spark.read.parquet(f"{sf}/labels.parquet"))
    assert after.count() == quality_mil.score_quality(before, model).where("predicted = 1").count() < before.count()
    before, after = kept["lines"]
    assert before.count() == after.count()
    assert line_dedup.drop_boilerplate(before, F.col("source")).where("n_dropped > 0").count() > 0
    before, after = kept["near_duplicates"]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    want = {}
    for (i, _), c in zip(rows, brute_classes(rows)):
        want[c] = min(i, want.get(c, i))
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(want.values())
    before, after = kept["decontamination"]
    clean = sorted(r["doc_id"] for r in before.collect() if not (h := brute_hits(r["text"], items)[0]) or 20 * len(h) < len(words(r["text"])))
    assert sorted(r["doc_id"] for r in after.collect()) == clean
    before, after = kept["tokens"]
    assert after.count() == before.count()
    assert plain_ids(after) == plain_ids(corpus_pipeline.run(spark, sf))


def test_stages_take_awkward_documents(spark, sf):
    """Nulls, empties, repeats, an empty table, and columns that bear the names of ours."""
    docs = documents(spark).withColumns({c: F.lit(1) for c in ("_n_lines", "_n_dropped", "n_dropped", "row", "_key", "root", "first", "_text", "_spans")})
    for name, stage in corpus_pipeline.STAGES:
        if name != "near_duplicates":  # its rows are tested by test_near
            assert stage(spark, docs.where("false"), sf).count() == 0
            out = stage(spark, docs, sf)
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= docs.count()


def plain_ids(df):
    return sorted((r["doc_id"], r["ids_sha256"]) for r in df.collect())
