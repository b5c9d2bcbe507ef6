"""The question bank and the task list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.digests import task_signature
from ..functions.numbers import parse_score
from ..functions.text import collapse, nonblank_lines
from ..operators.validation import missing, repeated, require_none, together, violations
from ..schemas import BANK, RAW_ITEMS


def read_bank(spark: SparkSession, path: str) -> DataFrame:
    """The eight columns in use; of rows with one task_id the last in the file wins."""
    rows = spark.read.parquet(path).select(*BANK.names)
    seq = F.monotonically_increasing_id()
    last = rows.withColumn("__seq", seq).groupBy("task_id").agg(F.max_by(F.struct(*[c for c in BANK.names if c != "task_id"]), "__seq").alias("r"))
    return last.select("task_id", "r.*")


def ordered_lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, ordinal from 1, line: the stripped lines that aren't blank, in order."""
    return df.select(*keys, F.posexplode(nonblank_lines(F.col(text))).alias("at", "line")).select(*keys, (F.col("at") + 1).alias("ordinal"), "line")


def id_violations(ids: DataFrame, key: str = "task_id") -> DataFrame:
    """An empty list, or an id that it has more than once."""
    nothing = ids.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    return together(violations(nothing, "the task list has ids", F.lit("list")), repeated(ids, "task ids are distinct", F.col(key)))


def read_task_ids(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, task_id) of a list with one id a line."""
    whole = spark.read.text(path, wholetext=True)
    ids = ordered_lines(whole, [], "value").withColumnRenamed("line", "task_id")
    require_none(id_violations(ids))
    return ids


def with_rubric(bank: DataFrame) -> DataFrame:
    """bank with rubric, an array of item_id, criterion and integer score, from rubric_json."""
    raw = F.from_json("rubric_json", RAW_ITEMS.simpleString())
    item = lambda x: F.struct(x["rubric_item_id"].alias("item_id"), collapse(x["criterion"]).alias("criterion"), parse_score(x["score"]).alias("score"))
    return bank.withColumn("rubric", F.transform(raw, item))


def unlisted(ids: DataFrame, bank: DataFrame) -> DataFrame:
    return missing(ids, bank, ["task_id"], "every listed task is in the bank")


def tasks(ids: DataFrame, bank: DataFrame) -> DataFrame:
    """One row a listed task, in the list's order by ordinal, with signature. A listed id without a row is an error.

    The list is short beside the bank and is broadcast by the optimizer where its size allows.
    """
    found = with_rubric(ids.join(bank, "task_id"))
    bad = found.where(F.col("rubric").isNull() | F.exists("rubric", lambda x: x["score"].isNull()))
    require_none(together(unlisted(ids, bank), violations(bad, "a rubric's scores are numbers", F.col("task_id"))))
    named = found.select(
        "ordinal", "task_id", "occupation", "prompt", "rubric", F.col("deliverable_file_urls").alias("gold_urls"), F.col("deliverable_files").alias("gold_names"),
        F.col("reference_files").alias("reference_names"), F.col("reference_file_urls").alias("reference_urls"),
    )
    return named.withColumn("signature", task_signature())


def task_items(tasks: DataFrame, keys: list[str]) -> DataFrame:
    """keys, item_id, criterion, score: one row a rubric item."""
    return tasks.select(*keys, F.explode("rubric").alias("i")).select(*keys, "i.*")


def packets(products: DataFrame, tasks: DataFrame) -> DataFrame:
    """Every product with every task. Products are a handful; their side is the one repeated."""
    return products.crossJoin(tasks)


def with_metrics(packets: DataFrame, metrics: DataFrame, keys: list[str]) -> DataFrame:
    """packets with what people entered for each; the keys of both are the same, as metrics are checked for that."""
    return packets.join(metrics, keys)


def strict_zip(df: DataFrame, left: str, right: str) -> DataFrame:
    """ordinal from 0, left, right: two arrays side by side; different lengths are an error, not nulls."""
    require_none(violations(df.where(F.size(left) != F.size(right)), "names and addresses come in pairs", F.size(left)))
    return df.select(F.posexplode(F.arrays_zip(F.col(left).alias("left"), F.col(right).alias("right"))).alias("ordinal", "z")).select("ordinal", "z.left", "z.right")


def first_tasks(tasks: DataFrame, n: int, ordinal: str = "ordinal") -> DataFrame:
    """The tasks up to ordinal n, by a filter that reaches the scan."""
    if n <= 0:
        raise ValueError("the number of tasks must be positive")
    return tasks.where(F.col(ordinal) <= n)
