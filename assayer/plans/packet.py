"""The packet pipeline: prepare folders for products, then judge, score and rank what they hold."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from pathlib import Path, PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import round_exact, task_score
from ..functions.text import basename, is_safe_path, packet_name, path_steps, under
from ..operators import validation
from ..operators.bundles import bundle, files_digest
from ..operators.leaderboard import leaderboard
from ..operators.routing import route, settle
from ..operators.scoring import item_sums
from ..operators.validation import Invalid, require_none
from ..schemas import DELIVERABLE_SUFFIXES, METRIC_FIELDS
from ..sources import bank, download, files, office, records
from ..sources.judge import Judge
from ..sources.listing import listed
from ..sources.shared import materialised
from . import judging, reports

KEYS = ["product", "ordinal"]
REFERENCES = "reference_files/"
START = """One task for one product

prompt.txt         the task
reference_files/   what the task is based on, if anything; checked for changes before grading
output/            finished work; nothing else is graded

Graded formats: XLSX, DOCX, PPTX, PDF. Several files are graded as one piece of work.
"""


def _listed(tasks: DataFrame) -> list:
    """The listed tasks' rows; the list, not the bank, bounds them."""
    rows = tasks.orderBy("ordinal").collect()
    require_none(validation.together(validation.not_contiguous(tasks), validation.repeated(tasks, "task ids are distinct", F.col("task_id"))))
    return rows


def _attached(name: Column) -> Column:
    """Where an attachment lies in a packet: all are side by side, whatever folders their names have."""
    return F.concat(F.lit(REFERENCES), basename(name))


def _count(c: str) -> Column:
    return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))


def _attachments(tasks: DataFrame, names: str, urls: str) -> DataFrame:
    """(ordinal, i, name, url) of the tasks' attachments."""
    both = F.transform(F.col(names), lambda name, i: F.struct(name.alias("name"), F.get(F.col(urls), i).alias("url")))
    return tasks.select("ordinal", F.posexplode(both).alias("i", "x")).select("ordinal", "i", "x.name", "x.url")


def _inputs(tasks: DataFrame, attachments: DataFrame, got: DataFrame) -> DataFrame:
    """(ordinal, path, content, source, sha256) of what a packet of each task holds besides its own work."""
    none = F.lit(None)
    texts = {"prompt.txt": F.coalesce("prompt", F.lit("")), "START.txt": F.lit(START)}
    written = tasks.select("ordinal", F.explode(F.array(*[F.struct(F.lit(p).alias("path"), t.cast("binary").alias("content")) for p, t in texts.items()])).alias("x"))
    own = written.select("ordinal", "x.path", "x.content", none.cast("string").alias("source"), F.sha2("x.content", 256).alias("sha256"))
    kept = files.with_digests(got.where("error is null").select(F.lit("").alias("path"), "url", "full"), ["url"]).select("url", F.col("full").alias("source"), "sha256")
    fetched = attachments.join(kept, "url").select("ordinal", _attached(F.col("name")).alias("path"), none.cast("binary").alias("content"), "source", "sha256")
    return materialised(own.unionByName(fetched))


def _older(attachments: DataFrame, inputs: DataFrame, packets: DataFrame, listing: DataFrame) -> DataFrame:
    """KEYS, path, full, sha256 of attachments in folders of their own, from the time when packets had these; one that isn't
    what the address gives is an error."""
    name = F.col("name")
    nested = attachments.select("ordinal", F.when(under(name, REFERENCES), name).otherwise(F.concat(F.lit(REFERENCES), name)).alias("path"), _attached(name).alias("now"))
    wanted = inputs.select("ordinal", F.col("path").alias("now"), F.col("sha256").alias("wanted"))
    found, _ = files.packet_paths(listing, packets, "")
    old = found.join(nested.where("path <> now").join(wanted, ["ordinal", "now"]), ["ordinal", "path"])
    same = files.with_digests(old, [*KEYS, "wanted"])
    same = materialised(same)
    require_none(validation.violations(same.where("sha256 <> wanted"), "an attachment has been changed", F.concat_ws("/", *KEYS, "path")))
    return same


def _flatten(old: DataFrame, root: Path) -> None:
    """Removes attachments in folders of their own, and these folders if nothing else lies in them; in tasks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for full, path in zip(batch["full"], batch["path"]):
                file = Path(full)
                file.unlink(missing_ok=True)
                for folder in list(file.parents)[: len(PurePosixPath(path).parts) - 2]:
                    try:
                        folder.rmdir()
                    except OSError:  # it holds something else, or another task has removed it
                        break
            yield batch[["full"]]

    old.select("path", "full").mapInPandas(run, "full string").count()  # nothing to do without rows


def prepare(spark: SparkSession, tasks: DataFrame, root: Path, products: list[str], downloads: Path, fetch: download.Fetch = download.https_fetch) -> None:
    """Writes every product's packets: prompt, start note, attachments, an empty output folder; the manifest; a blank
    metrics.csv if there is none. Running it again changes nothing; an input with other contents is an error.

    Two phases: everything is checked, fetched, written and read back in tasks; if every file is there with the digest
    that it must have, the manifest is moved into place, and with it the packets count. A run that ends before that
    leaves an older manifest and the packets it tells of as they were. After it, older packets with attachments in
    folders of their own are flattened.
    """
    rows = _listed(tasks)
    for product in products:
        if path_steps(product) != [product]:
            raise Invalid(f"a product's name is one step of a path: {product!r}")
    uneven = tasks.where(_count("reference_names") != _count("reference_urls"))
    require_none(validation.violations(uneven, "every attachment has a name and an address", F.col("ordinal")))
    attachments = _attachments(tasks, "reference_names", "reference_urls")
    placed = attachments.select("ordinal", _attached(F.col("name")).alias("path")).unionByName(tasks.select("ordinal", F.explode(F.array(F.lit("prompt.txt"), F.lit("START.txt"))).alias("path")))
    require_none(validation.together(validation.unsafe_paths(attachments, "name"), validation.attachment_collisions(attachments), validation.covered_inputs(placed)))
    root.mkdir(parents=True, exist_ok=True)
    identities = [(t["ordinal"], t["signature"]) for t in rows]
    if files.safe_path(root, "manifest.json").exists():
        records.read_manifest(spark, root, products, identities)
    got = download.fetched(attachments, downloads, fetch)
    require_none(validation.violations(got.where("error is not null"), "attachments must be had", F.col("url"), F.col("error")))
    inputs = _inputs(tasks, attachments, got)
    packets = _expected(spark, tasks, products).select(*KEYS)
    at = lambda path: F.concat_ws("/", "product", packet_name(F.col("ordinal")), path)
    old = _older(attachments, inputs, packets, materialised(listed(spark, root)))

    every = packets.join(inputs, "ordinal").withColumn("path", at("path"))
    done = materialised(files.stored(every.repartition(spark.sparkContext.defaultParallelism, "path"), root, KEYS))
    require_none(validation.violations(done.where("error is not null"), "packets can't be written", F.col("path"), F.col("error")))
    require_none(validation.violations(every.join(done.select("path", F.col("sha256").alias("now")), "path", "left").where("now is null or now <> sha256"), "a packet isn't what it must be", F.col("path")))
    for product, ordinal in [(p, t["ordinal"]) for p in products for t in rows]:
        for folder in ("reference_files", "output"):
            files.safe_path(root, f"{product}/t_{ordinal:02d}/{folder}").mkdir(parents=True, exist_ok=True)
    held = {r["ordinal"]: dict(r["f"]) for r in inputs.groupBy("ordinal").agg(F.array_sort(F.collect_list(F.struct("path", "sha256"))).alias("f")).collect()}
    records.write_manifest(root, products, [{"ordinal": t["ordinal"], "signature": t["signature"], "files": held[t["ordinal"]]} for t in rows])
    _flatten(old, root)
    files.discard_staged(root)
    metrics = files.safe_path(root, "metrics.csv")
    if not metrics.exists():
        with metrics.open("w", newline="", encoding="utf-8-sig") as f:
            out = csv.DictWriter(f, METRIC_FIELDS, restval="")
            out.writeheader()
            out.writerows({"product": p, "task": t["ordinal"], "status": "pending"} for p in products for t in rows)
    records.read_metrics(spark, metrics, _expected(spark, tasks, products))


def _products(spark: SparkSession, products: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(products)), "product_pos int, product string")


def _expected(spark: SparkSession, tasks: DataFrame, products: list[str]) -> DataFrame:
    return bank.packets(_products(spark, products), tasks.select("ordinal"))


def _first_errors(*tables: DataFrame) -> DataFrame:
    """KEYS, error: of several tables of errors, the first table's that has one."""
    ranked = [t.select(*KEYS, F.lit(i).alias("i"), "error") for i, t in enumerate(tables)]
    return validation.together(*ranked).where("error is not null").groupBy(*KEYS).agg(F.min_by("error", F.struct("i", "error")).alias("error"))


def evidence(spark: SparkSession, rows: DataFrame, manifest: DataFrame, root: Path) -> tuple[DataFrame, DataFrame]:
    """Documents of the rows to be judged: (KEYS, document, reference, input_files, output_files, output_digest), (KEYS, error)."""
    recorded = rows.select(*KEYS).join(manifest, "ordinal")
    there = materialised(listed(spark, root))
    inputs, bad_inputs = files.packet_paths(there, rows, "")
    outputs, bad_outputs = files.packet_paths(there, rows, "output")
    listing = _first_errors(bad_inputs, bad_outputs)

    wanted = inputs.where(~under(F.col("path"), "output/"))
    now = materialised(files.with_digests(wanted, KEYS))
    changed = validation.changed_files(recorded, now, KEYS).select(*KEYS, F.lit("an input isn't what was prepared").alias("error"))
    surplus = now.where(under(F.col("path"), REFERENCES)).join(recorded, [*KEYS, "path"], "left_anti").select(*KEYS, F.lit("the attachments aren't those prepared").alias("error"))
    made = materialised(files.with_digests(outputs, KEYS))
    none = rows.select(*KEYS).join(made.select(*KEYS), KEYS, "left_anti").select(*KEYS, F.lit("output/ holds no deliverable").alias("error"))
    odd = made.where(~F.col("suffix").isin(*DELIVERABLE_SUFFIXES)).select(*KEYS, F.lit("output/ may hold XLSX, DOCX, PPTX and PDF files only").alias("error"))

    attached = now.join(recorded.where(under(F.col("path"), REFERENCES)).select(*KEYS, "path"), [*KEYS, "path"], "left_semi")
    document = bundle(office.extract(made.where(F.col("suffix").isin(*DELIVERABLE_SUFFIXES)), KEYS), KEYS, error="error")
    document, reference = materialised(document), materialised(bundle(office.extract(attached, KEYS), KEYS, error="error"))
    inputs = files_digest(recorded, KEYS).select(*KEYS, F.col("files").alias("input_files"))
    produced = files_digest(made, KEYS).select(*KEYS, F.col("digest").alias("output_digest"), F.col("files").alias("output_files"))
    errors = materialised(_first_errors(listing, changed, surplus, none, odd, document, reference))
    texts = (
        rows.join(document.select(*KEYS, F.col("bundle").alias("document")), KEYS).join(reference.select(*KEYS, F.col("bundle").alias("reference")), KEYS, "left")
        .withColumn("reference", F.coalesce("reference", F.lit(""))).join(inputs, KEYS).join(produced, KEYS)
        .join(errors, KEYS, "left_anti")
    )
    return texts, errors


def score_rows(texts: DataFrame, modes: tuple[str, ...], judge: Judge, log: str) -> DataFrame:
    """KEYS, rubric_score, pairwise_score, judge_cost_usd, output_sha256, error of each judged row.

    The cost is that of all verdicts in use, reused ones too. One failed verdict makes the row an error.
    """
    parts = []
    if "rubric" in modes:
        asked = judging.judged(judging.rubric_requests(texts, KEYS, judge), "rubric", judge, log)
        errors = asked.groupBy(*KEYS).agg(F.min("error").alias("rubric_error"))
        sums = item_sums(asked, KEYS, cost="cost").join(errors, KEYS)
        none = texts.where(F.coalesce(F.size("rubric"), F.lit(0)) <= 0).select(*KEYS)  # a task without items scores 0
        scored = sums.select(*KEYS, round_exact(task_score(F.col("earned"), F.col("total")), 6).alias("rubric_score"), F.coalesce("cost", F.lit(0.0)).alias("rubric_cost"), "rubric_error")
        parts.append(scored.unionByName(none.select(*KEYS, F.lit(0.0).alias("rubric_score"), F.lit(0.0).alias("rubric_cost"), F.lit(None).cast("string").alias("rubric_error"))))
    if "pairwise" in modes:
        asked = judging.judged(judging.pairwise_requests(texts, KEYS, judge), "pairwise", judge, log)
        parts.append(asked.select(*KEYS, F.col("verdict_score").alias("pairwise_score"), F.coalesce("cost", F.lit(0.0)).alias("pairwise_cost"), F.col("error").alias("pairwise_error")))
    out = texts.select(*KEYS, F.col("output_digest").alias("output_sha256"))
    for p in parts:
        out = out.join(p, KEYS, "left")
    cost = [F.col(f"{m}_cost") for m in modes]
    return out.withColumn("judge_cost_usd", sum(cost[1:], cost[0])).withColumn("error", F.coalesce(*[F.col(f"{m}_error") for m in modes]))


def evaluate(
    spark: SparkSession, tasks: DataFrame, root: Path, products: list[str], judge: Judge, results: Path,
    modes: tuple[str, ...] = ("rubric", "pairwise"), limit: int | None = None, experts: DataFrame | None = None,
) -> tuple[list, list]:
    """Judges the completed rows, writes scores.csv, leaderboard.csv and report.md, returns both tables' rows.

    experts(ordinal, expert, error) are the experts' texts, needed for pairwise. An error of a row is in its notes;
    an error of the manifest or the metrics stops the run before anything is judged.
    """
    listed = _listed(tasks)
    manifest = records.read_manifest(spark, root, products, [(t["ordinal"], t["signature"]) for t in listed])
    metrics = records.read_metrics(spark, files.safe_path(root, "metrics.csv"), _expected(spark, tasks, products))
    rows = (
        bank.with_metrics(_expected(spark, tasks, products), metrics.withColumnRenamed("task", "ordinal"), KEYS)
        .withColumn("route", route(F.col("status"), F.col("ordinal"), limit))
    )
    rows = materialised(rows)
    todo = rows.where("route = 'judge'").select(*KEYS).join(tasks.select("ordinal", "signature", "prompt", "rubric"), "ordinal")
    todo = materialised(todo)
    texts, errors = evidence(spark, todo, manifest, root)
    if "pairwise" in modes:
        if experts is None:
            raise Invalid("pairwise needs the experts' texts")
        bad = todo.select(*KEYS, "ordinal").join(experts.where("error is not null").select("ordinal", F.col("error").alias("e")), "ordinal").select(*KEYS, F.col("e").alias("error"))
        errors = materialised(_first_errors(errors, bad))
        texts = texts.join(experts.where("error is null").select("ordinal", "expert"), "ordinal").join(errors, KEYS, "left_anti")
    destination = reports.report_folder(results, root)
    destination.mkdir(parents=True, exist_ok=True)
    scored = score_rows(materialised(texts), modes, judge, str(destination / "verdicts"))
    outcome = scored.unionByName(errors.select(*KEYS, "error"), allowMissingColumns=True)
    outcome = materialised(outcome)
    final = settle(rows.join(outcome, KEYS, "left"), modes).select(
        "product", F.col("ordinal").alias("task"), "status", "session", "elapsed_seconds", "tokens", "notes",
        "rubric_score", "pairwise_score", "judge_cost_usd", "output_sha256", "product_pos",
    )
    final = materialised(final).orderBy("product_pos", "task")
    board = leaderboard(final.drop("product_pos"), _products(spark, products), modes, len(listed)).drop("product_pos", "entries")
    board = board.select("rank", *[c for c in board.columns if c != "rank"])
    scores = final.drop("product_pos")
    reports.write_csv(scores, destination / "scores.csv")
    reports.write_csv(board, destination / "leaderboard.csv")
    got = board.collect(), scores.collect()
    reports.markdown(destination / "report.md", *got, len(listed), modes, judge.model)
    return got


def expert_texts(spark: SparkSession, tasks: DataFrame, folder: Path, fetch: download.Fetch = download.https_fetch) -> DataFrame:
    """(ordinal, expert, error): the experts' deliverables, fetched once, their texts joined in order.

    A file that can't be had or read, or is blank or at the cap, makes the whole task an error.
    """
    _listed(tasks)
    attachments = _attachments(tasks, "gold_names", "gold_urls")
    got = download.fetched(attachments, folder, fetch)
    joined = attachments.join(got, "url", "left")
    unsafe = joined.where(~is_safe_path(F.col("name"))).select("ordinal", F.lit("a path must be relative and stay in its folder").alias("error"))
    uneven = tasks.where(_count("gold_names") != _count("gold_urls")).select("ordinal", F.lit("names and addresses aren't as many").alias("error"))
    bare = tasks.where(_count("gold_urls") == 0).select("ordinal", F.lit("there is no expert deliverable").alias("error"))
    unread = joined.where("full is null and error is not null").select("ordinal", "error")
    bad = materialised(unsafe.union(uneven).union(unread).union(bare).groupBy("ordinal").agg(F.min("error").alias("error")))
    ending = F.regexp_extract(basename(F.col("name")), r"^.+(\.[^.]+)$", 1)
    paths = joined.join(bad, "ordinal", "left_anti").select("ordinal", F.concat(F.format_string("%06d", "i"), ending).alias("path"), "full")
    found = bundle(office.extract(files.with_digests(paths, ["ordinal"]), ["ordinal"]), ["ordinal"], error="error")
    text = F.regexp_replace(F.col("bundle"), r"(?m)^\[文件 [0-9]{6}\.[^\]\n]*\]\n", "")
    return found.join(bad, "ordinal", "left_anti").select("ordinal", text.alias("expert"), "error").unionByName(bad.select("ordinal", F.lit(None).cast("string").alias("expert"), "error"))
