"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_repair, decontaminate, filter_audit, fingerprints, license_scan, line_dedup, near_dedup, packing, pii, quality_mil, secrets_scan, token_alignment

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BYTE_BPE, BYTE_RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan_secrets(_table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_links")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents"), F.col("source"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("row.text", 256).alias("text_sha256"))


def op3_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_chats(_table(spark, sf_dir, "conversations"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "class_key", "kept")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def fingerprint_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of op5: classes of documents by joined signature bands and verified Jaccard likeness."""
    return fingerprints.link_fingerprints(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents")).drop("added")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_mil.score_quality(docs, quality_mil.train(docs, _table(spark, sf_dir, "labels")))


def op9_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(vocabulary))
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents")).drop("template_spans")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(_table(spark, sf_dir, "documents"), *map(public_tokenizers.path, (BYTE_BPE, BYTE_RANKS, PIECES)))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), *map(public_tokenizers.path, (BYTE_BPE, BYTE_RANKS)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_secret_scan, op2_line_dedup, op3_chat_repair, op4_near_dedup, op5_fingerprints, op6_pii, op7_decontamination, op8_quality, op9_bpe, op10_license_scan, op11_token_alignment, op12_filter_audit, op13_packing, fingerprint_links)
    return {f.__name__: f for f in own}


OP2_SQL = f"""
WITH d AS (SELECT doc_id, text, coalesce(source, '') AS host, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
c AS (SELECT host, l, count(*) AS n FROM (
        SELECT host, unnest(list_distinct(list_transform(ls, lambda x: trim(x, ' ' || chr(9) || chr(13))))) AS l FROM d)
      WHERE l <> '' GROUP BY host, l),
t AS (SELECT host, count(*) AS pages FROM d GROUP BY host),
f AS (SELECT c.host, list(c.l) AS bad FROM c JOIN t USING (host)
      WHERE c.n >= {line_dedup.MIN_PAGES} AND c.n > {line_dedup.RATIO} * t.pages GROUP BY c.host),
k AS (SELECT d.doc_id, d.text, d.ls,
        CASE WHEN f.bad IS NULL THEN d.ls
             ELSE list_filter(d.ls, lambda x: NOT list_contains(f.bad, trim(x, ' ' || chr(9) || chr(13)))) END AS kept
      FROM d LEFT JOIN f USING (host))
SELECT doc_id,
  CASE WHEN text IS NULL THEN 0 ELSE len(ls) END AS n_lines,
  CASE WHEN text IS NULL THEN 0 ELSE len(ls) - len(kept) END AS n_dropped,
  CASE WHEN text IS NULL THEN NULL ELSE sha256(array_to_string(kept, chr(10))) END AS text_sha256
FROM k
"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the operator within the time of a check."""
    return {"op2_line_dedup": OP2_SQL, "op12_filter_audit": filter_audit.OP12_SQL}
