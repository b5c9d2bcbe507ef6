"""A human status to what is done with the row, and the outcome to a status. The first case that holds wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined_notes


def route(status: Column, ordinal: Column | None = None, limit: int | None = None) -> Column:
    """not_evaluated beyond the limit; failed, judge or left by status. The limit masks rows, it drops none."""
    out = F.when(F.lit(False), F.lit(""))
    if limit is not None:
        if limit <= 0:
            raise ValueError("limit must be positive")
        out = F.when(ordinal > limit, "not_evaluated")
    return out.when(status == "failed", "failed").when(status == "completed", "judge").otherwise("left")


def settle(rows: DataFrame, modes: tuple[str, ...]) -> DataFrame:
    """Final status, scores, cost and notes.

    rows have route, status, notes, error (null if all modes succeeded) and, for the modes, rubric_score and
    pairwise_score, judge_cost_usd and output_sha256. A judged row has the values of all modes or of none.
    """
    graded = (F.col("route") == "judge") & F.col("error").isNull()
    out = rows
    for mode in ("rubric", "pairwise"):
        name = f"{mode}_score"
        value = F.col(name) if name in rows.columns else F.lit(None).cast("double")
        zero = F.lit(0.0) if mode in modes else F.lit(None).cast("double")
        out = out.withColumn(name, F.when(graded, value if mode in modes else F.lit(None)).when(F.col("route") == "failed", zero))
    status = F.when(F.col("route") == "not_evaluated", "not_evaluated").when(graded, "graded").when(F.col("route") == "judge", "error").otherwise(F.col("status"))
    return (
        out.withColumn("judge_cost_usd", F.when(graded, F.col("judge_cost_usd")).when(F.col("route") == "failed", 0.0))
        .withColumn("output_sha256", F.when(graded, F.col("output_sha256")))
        .withColumn("notes", F.when(F.col("route") == "judge", joined_notes(F.coalesce("notes", F.lit("")), F.coalesce("error", F.lit("")))).otherwise(F.col("notes")))
        .withColumn("status", status)
    )
