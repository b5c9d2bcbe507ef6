"""From requests to verdicts: reuse what the log answers, ask the judge for the rest, append, read back."""

from __future__ import annotations

import re
import time
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.digests import cache_key, json_text, seeded_coin
from ..functions.prompts import PAIRWISE_SYSTEM, RUBRIC_SYSTEM, pairwise_prompt, rubric_prompt
from ..functions.verdicts import pairwise_choice, pairwise_score, rubric_met
from ..operators.scoring import reused, unjudged
from ..sources.judge import ANSWER, Judge, ask_all
from ..sources.shared import materialised
from ..sources.verdict_log import COMPACT_AFTER, append_verdicts, compact, probe_verdicts, state

SYSTEMS = (RUBRIC_SYSTEM, PAIRWISE_SYSTEM)


def rubric_requests(evidence: DataFrame, keys: list[str], judge: Judge, proof: list[Column] | None = None) -> DataFrame:
    """keys, key, item_id, score, prompt, system: one row a rubric item.

    evidence has keys, signature, prompt, rubric, document, reference. A verdict's key hangs on proof, values in canonical
    form: unless given, input_files, output_files, document and reference.
    """
    identity = _identity(judge, "rubric", proof or _proof(F.lit("")))
    each = evidence.select(*keys, identity.alias("identity"), F.col("prompt").alias("task_prompt"), "reference", "document", F.explode("rubric").alias("i"))
    return each.select(
        *keys, F.concat("identity", F.lit(":"), F.col("i.item_id")).alias("key"), F.col("i.item_id").alias("item_id"), F.col("i.score").alias("score"),
        rubric_prompt(F.col("task_prompt"), F.col("reference"), F.col("document"), F.col("i.criterion")).alias("prompt"), F.lit(RUBRIC_SYSTEM).alias("system"),
    )


def pairwise_requests(evidence: DataFrame, keys: list[str], judge: Judge, proof: list[Column] | None = None, side: Column | None = None) -> DataFrame:
    """keys, key, product_is_a, prompt, system; evidence has the expert's text too. The side is the coin that the
    signature seeds, unless one is given."""
    sided = evidence.withColumn("product_is_a", seeded_coin(F.col("signature")) if side is None else side)
    a = F.col("product_is_a")
    return sided.select(
        *keys, _identity(judge, "pairwise", proof or _proof(F.col("expert"))).alias("key"), a.alias("product_is_a"),
        pairwise_prompt(F.col("prompt"), F.col("reference"), F.col("document"), F.col("expert"), a).alias("prompt"), F.lit(PAIRWISE_SYSTEM).alias("system"),
    )


def _proof(expert: Column) -> list[Column]:
    return [F.col("input_files"), F.col("output_files"), *[json_text(c) for c in (F.col("document"), F.col("reference"), expert)]]


def _identity(judge: Judge, mode: str, proof: list[Column]) -> Column:
    return cache_key(F.col("signature"), judge.model, mode, judge.provider, SYSTEMS, *proof)


def _journal(log: str) -> Path | None:
    """The folder for answers that no verdict has been made of yet; none where the log isn't in a mounted file system."""
    path = re.sub(r"^file:(//)?(?=/)", "", log)
    return None if re.match(r"[a-z][a-z0-9+.-]*:", path) else Path(path) / "_replies" / "waiting"


def judged(requests: DataFrame, mode: str, judge: Judge, log: str, at_once: int | None = None, per_second: float | None = None) -> DataFrame:
    """requests with met (rubric) or score (pairwise), cost and error.

    Requests that no verdict answers go to the judge, at most at_once at a time and per_second a second (ask_all()).

    Every answer is in a journal beside the log before it counts: what a run that was stopped has been told is not asked
    again by the next. New replies are written to the log and read back, so a prompt is sent once however often the plan
    is read; the log is compacted when many batches wait. Replies that fail or can't be understood are errors and aren't
    kept: the next run asks again.
    """
    spark, requests = requests.sparkSession, materialised(requests)
    keys = requests.select("key").distinct()
    misses = materialised(unjudged(requests, probe_verdicts(keys, log)).dropDuplicates(["key"]))
    journal = _journal(log)
    told_before, run = spark.createDataFrame([], ANSWER), uuid.uuid4().hex
    older = list(journal.iterdir()) if journal and journal.is_dir() else []
    if older:
        found = spark.read.schema(f"{ANSWER}, _corrupt_record string").json(f"file://{journal}").where("_corrupt_record is null and key is not null").drop("_corrupt_record")
        told_before = materialised(found.dropDuplicates(["key"]).join(misses.select("key"), "key", "left_semi"))
    asked = ask_all(unjudged(misses, told_before), judge, at_once=at_once, per_second=per_second, journal=journal, run=run)
    replies = materialised(asked.unionByName(told_before))
    a = requests.select("key", *(["product_is_a"] if mode == "pairwise" else [])).dropDuplicates(["key"])
    said = replies.join(a, "key")
    none = F.lit(None)
    if mode == "rubric":
        met, score, side = rubric_met(F.col("reply")), none.cast("double"), none.cast("string")
        failed = met.isNull()
    else:
        met, side = none.cast("boolean"), F.when(F.col("product_is_a"), "product").otherwise("expert")
        score = pairwise_score(pairwise_choice(F.col("reply")), F.col("product_is_a"))
        failed = score.isNull()
    told = said.select("key", F.lit(time.time_ns()).alias("seq"), met.alias("met"), score.alias("score"), side.alias("a_side"), "cost", F.coalesce("error", F.when(failed, "the judge's last line isn't a verdict")).alias("error"))
    append_verdicts(told.where("error is null"), log)
    errors = materialised(told.where("error is not null").select("key", "error"))
    for answers in [*older, *(journal.glob(f"{run}-*") if journal else [])]:
        answers.unlink(missing_ok=True)  # all of it is in the log, or answered by it
    now = probe_verdicts(keys, log).select("key", "met", F.col("score").alias("verdict_score"), "a_side", "cost")
    # written, as two readings of the growing log in one plan would be taken for the same table
    out = materialised(reused(requests, now).withColumn("error", F.lit(None).cast("string")).unionByName(
        unjudged(requests, now).join(errors, "key", "left").withColumn("error", F.coalesce("error", F.lit("no verdict"))), allowMissingColumns=True
    ))
    if len(state(spark, log).deltas) >= COMPACT_AFTER:
        compact(spark, log)
    return out
