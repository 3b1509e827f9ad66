"""The state of runs, from manifests and logs as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def staleness(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Per run: how many outputs are older than its newest input, and the first stage to run again.

    outputs (run, stage, name, mtime); inputs (run, name, mtime). An output without an mtime is missing and is made
    again. status tells a check that could not run ("no_inputs") from one that found nothing stale ("checked").
    """
    newest = inputs.groupBy("run").agg(F.max("mtime").alias("newest"), F.count(F.lit(1)).alias("n_inputs"))
    j = outputs.join(newest, "run", "left").withColumns({"stale": F.coalesce(F.col("mtime") < F.col("newest"), F.lit(False)), "lost": F.col("mtime").isNull()})
    return j.groupBy("run").agg(
        F.when(F.max("newest").isNull(), "no_inputs").otherwise("checked").alias("status"),
        F.coalesce(F.max("n_inputs"), F.lit(0)).cast("bigint").alias("n_inputs"),
        F.count(F.lit(1)).alias("n_outputs"),
        F.count_if("stale").alias("n_stale"),
        F.count_if("lost").alias("n_missing"),
        F.min(F.when(F.col("stale") | F.col("lost"), F.col("stage"))).alias("resume_at"),
    )


def failures(lines: DataFrame) -> DataFrame:
    """(log, rule, exit, oom, enomem): the rules that failed in each log; lines: (log, line_no, line).

    A failure's block reaches from the line after the failure before it to its own "Error in rule" line. Its exit code is
    the last one told in its block. A rule that is told again counts once, by its first failure with a code. Refused
    allocations show in the text only, and are looked for in the block of the rule's first failure.
    """
    rule = F.when(F.startswith("line", F.lit("Error in rule ")), F.rtrim(F.rtrim(F.substring("line", 15, 1 << 20), F.lit(":"))))
    code = F.regexp_extract("line", r"returned non-zero exit status (\d+)", 1).try_cast("int")
    refused = F.contains("line", F.lit("Cannot allocate memory")) | F.contains("line", F.lit("[Errno 12]"))
    before = Window.partitionBy("log").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    told = lines.select("log", "line_no", rule.alias("rule"), code.alias("code"), refused.alias("refused")).where("rule is not null or code is not null or refused")
    told = told.withColumn("block", F.coalesce(F.count("rule").over(before), F.lit(0)))
    block = told.groupBy("log", "block").agg(F.max("rule").alias("rule"), F.max_by("code", F.when(F.col("code").isNotNull(), F.col("line_no"))).alias("exit"), F.bool_or("refused").alias("refused"))
    one = block.where("rule is not null").groupBy("log", "rule").agg(F.min_by("exit", F.when(F.col("exit").isNotNull(), F.col("block"))).alias("exit"), F.min_by("refused", "block").alias("enomem"))
    return one.select("log", "rule", "exit", F.coalesce(F.col("exit").isin(9, 137), F.lit(False)).alias("oom"), "enomem")


def config_gaps(config: dict, needed: list[str], placeholder: str = "CHANGE_ME") -> dict[str, str]:
    """Dotted keys that are absent ("missing") or still hold the placeholder ("placeholder"); empty when all is set."""
    out = {}
    for key in needed:
        at: object = config
        for part in key.split("."):
            at = at.get(part) if isinstance(at, dict) else None
        if at is None or at == "":
            out[key] = "missing"
        elif placeholder in str(at):
            out[key] = "placeholder"
    return out


def claims(df: DataFrame) -> DataFrame:
    """(name, fault) of summaries that contradict themselves; df: (name, least, median, most, part, rest, whole, percent).

    A median lies within its range, parts sum to the whole, a percentage agrees with its counts to half of its last place
    (one decimal). Nulls are not claimed and are not judged.
    """
    faults = F.array(
        F.when((F.col("median") < F.col("least")) | (F.col("median") > F.col("most")), "median out of range"),
        F.when(F.col("part") + F.col("rest") != F.col("whole"), "parts do not sum"),
        F.when(F.abs(F.try_divide(F.col("part") * 100.0, F.col("whole")) - F.col("percent")) > 0.05 + 1e-9, "percentage off"),
    )
    return df.select("name", F.explode(F.array_compact(faults)).alias("fault"))
