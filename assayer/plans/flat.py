"""The flat mode: one folder with one deliverable a task, t01.docx and so on, for one product.

It differs from the packet pipeline: no reference material, no human metrics, a missing or unreadable deliverable
scores 0 with a note, the limit cuts the list, task scores have 3 places, and only new verdicts cost.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.digests import coin, fingerprint, json_text, json_whole
from ..functions.numbers import round_exact, task_score
from ..operators.scoring import flat_totals, item_sums, unjudged, win_rate
from ..operators.validation import Invalid
from ..sources import bank, files, office
from ..sources.judge import Judge
from ..sources.shared import materialised
from ..sources.verdict_log import probe_verdicts
from . import judging, reports


def deliverables(spark: SparkSession, folder: Path, tasks: DataFrame) -> DataFrame:
    """ordinal, document, sha256, error."""
    found = materialised(files.only_matches(spark, folder, tasks))
    one = found.where("error is null").select("ordinal", F.col("name").alias("path"), "full")
    contents = files.with_digests(one, ["ordinal"])
    texts = office.extract(contents.withColumn("suffix", F.when(F.col("suffix") == "txt", "text").otherwise(F.col("suffix"))), ["ordinal"])  # plain text is no deliverable
    read = texts.join(contents.select("ordinal", "sha256"), "ordinal").select("ordinal", F.col("text").alias("document"), "sha256", "error")
    none = F.lit(None).cast("string")
    return read.unionByName(found.where("error is not null").select("ordinal", none.alias("document"), none.alias("sha256"), "error"))


def run(spark: SparkSession, tasks: DataFrame, folder: Path, product: str, mode: str, judge: Judge, results: Path, limit: int | None = None, experts: DataFrame | None = None, seed: int = 0):
    """Writes <product>.<mode>.csv and returns (total or win rate, cost of new verdicts). A judge's error stops the run."""
    own = tasks if limit is None else bank.first_tasks(tasks, limit)
    docs = materialised(deliverables(spark, folder, own))
    ready = own.join(docs.where("error is null"), "ordinal").withColumn("reference", F.lit(""))
    notes = docs.select("ordinal", "error")
    log = str(results / f"{product}.{mode}.verdicts")
    results.mkdir(parents=True, exist_ok=True)
    if mode == "rubric":
        requests = judging.rubric_requests(ready, ["ordinal"], judge, [json_text(F.col("document")), json_text(F.col("sha256"))])
    elif mode == "pairwise":
        if experts is None:
            raise Invalid("pairwise needs the experts' texts")
        notes = notes.join(experts.select("ordinal", F.col("error").alias("e")), "ordinal", "left").select("ordinal", F.coalesce("error", "e").alias("error"))
        seeded = ready.join(experts.where("error is null").select("ordinal", "expert"), "ordinal")
        proof = [json_text(F.col("document")), json_text(F.col("expert")), json_whole(F.lit(seed)), json_text(F.col("sha256"))]
        side = coin(fingerprint(json_text(F.col("signature")), json_whole(F.lit(seed))))  # by task, so that no task's side hangs on which were asked before
        requests = judging.pairwise_requests(seeded, ["ordinal"], judge, proof, side)
    else:
        raise Invalid("the mode is rubric or pairwise")
    requests = materialised(requests)
    new = materialised(unjudged(requests, probe_verdicts(requests.select("key"), log)).select("key").dropDuplicates())  # told before the judge answers
    asked = judging.judged(requests, mode, judge, log)
    failed = asked.where("error is not null").select("error").first()
    if failed:
        raise Invalid(failed["error"])
    cost = asked.dropDuplicates(["key"]).join(new, "key", "left_semi").agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("c")).first()["c"]
    listed = own.select("ordinal", "occupation", F.aggregate(F.filter("rubric", lambda x: x["score"] > 0), F.lit(0).cast("bigint"), lambda a, x: a + x["score"]).alias("base")).join(notes, "ordinal", "left")
    if mode == "rubric":
        sums = item_sums(asked, ["ordinal"]).select("ordinal", "earned")
        rows = listed.join(sums, "ordinal", "left").select("ordinal", "occupation", round_exact(task_score(F.coalesce("earned", F.lit(0)), F.col("base")), 3).alias("task_score"), F.coalesce("earned", F.lit(0)).alias("earned"), F.col("base").alias("total"), F.coalesce("error", F.lit("")).alias("notes"))
        value = flat_totals(rows.withColumn("product", F.lit(product))).first()
        out = value["total"] if value else 0.0
    else:
        rows = listed.join(asked.select("ordinal", "verdict_score", "a_side"), "ordinal", "left").select("ordinal", "occupation", F.coalesce("verdict_score", F.lit(0.0)).alias("score"), F.coalesce("a_side", F.lit("")).alias("a_side"), F.coalesce("error", F.lit("")).alias("notes"))
        out = rows.agg(win_rate(F.col("score")).alias("w")).first()["w"]
    reports.write_csv(rows.orderBy("ordinal"), results / f"{product}.{mode}.csv")
    return out, cost
