"""The run's own records: manifest and metrics; the verdict log is in verdict_log."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..operators.validation import Invalid, metrics_violations, require_none, typed_metrics
from ..schemas import MANIFEST, METRIC_FIELDS, fields
from .files import replace_whole, safe_path
from .verdict_log import append_verdicts, read_verdicts  # noqa: F401


def read_manifest(spark: SparkSession, root: Path, products: list[str], identities: list[tuple[int, str]]) -> DataFrame:
    """(ordinal, path, sha256) of every recorded input; products and task identities must be those of the run."""
    whole = spark.read.schema(MANIFEST).option("multiLine", True).json(str(safe_path(root, "manifest.json")))
    row = whole.select("products", F.transform("tasks", lambda t: F.struct(t["ordinal"], t["signature"])).alias("ids")).first()
    if row is None or row["products"] != products or [tuple(x) for x in row["ids"] or []] != identities:
        raise Invalid("the tasks or products aren't those that this folder was prepared for")
    return whole.select(F.explode("tasks").alias("t")).select(F.col("t.ordinal").cast("int").alias("ordinal"), F.explode("t.files").alias("path", "sha256"))


def write_manifest(root: Path, products: list[str], tasks: list[dict]) -> None:
    replace_whole(root / "manifest.json", json.dumps({"products": products, "tasks": tasks}, ensure_ascii=False, indent=2))


def read_metrics(spark: SparkSession, path: Path, expected: DataFrame) -> DataFrame:
    """Checked and typed metrics rows. Every field is read as text; rows with too few or too many fields are errors."""
    with path.open(encoding="utf-8-sig") as f:
        if f.readline().rstrip("\r\n") != ",".join(METRIC_FIELDS):
            raise Invalid("metrics.csv must keep its columns and their order")
    kinds = fields(**{c: T.StringType() for c in METRIC_FIELDS}, _corrupt_record=T.StringType())
    raw = spark.read.schema(kinds).csv(str(path), header=True, multiLine=True, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    # the corrupt record alone can't be asked for
    if raw.agg(F.count_if(F.col("_corrupt_record").isNotNull()).alias("bad"), F.count("product").alias("n")).first()["bad"]:
        raise Invalid("metrics.csv has a row with too few or too many fields")
    # a file with quoted line ends is read by one task, in order; the header is record 1
    record = F.monotonically_increasing_id() + 2
    staged = raw.select(*[F.coalesce(strip(F.col(c)), F.lit("")).alias(c) for c in METRIC_FIELDS], record.alias("record"))
    require_none(metrics_violations(staged, expected.select("product", F.col("ordinal").cast("bigint").alias("task"))))
    return typed_metrics(staged)
