"""The corpus pipeline: filter by quality, drop boilerplate lines, keep one of near duplicates, decontaminate, tokenize.

Each stage takes the documents its predecessor kept and returns the columns of documents; the last returns token counts
and hashes. `run` applies them to the documents of a folder, writing every stage's result to the shared folder.

Every stage takes null as the empty text and a null source as a host of its own; an empty table goes through as one. Rows
without an id are kept as others are, and further columns travel along unread, whatever their names. Repeated rows are
one class of near duplicates, of which one row stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.llm import bpe, decontaminate, line_dedup, near_dedup, quality_mil
from peakloom.llm.common import written
from peakloom.llm.registry import VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of 0.3 or more)."""
    model = quality_mil.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_mil.accepted(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, rid of the boilerplate lines of their source; n_chars follows the text."""
    out = line_dedup.drop_boilerplate(docs, F.col("source"))
    n = F.when(F.col("n_dropped") > 0, F.length("row.text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*((n if c == "n_chars" else F.col("row").getField(c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule finds clean, their texts as they are."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids of every document."""
    return bpe.encode_decode(docs, bpe.read_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("tokens", tokens)]

#: SQL can express neither the classifier nor the signatures; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
