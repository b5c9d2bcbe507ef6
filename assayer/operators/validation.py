"""Rules as tables of violations (rule, key, detail). Nothing is asserted inside a plan: a caller looks whether
the table is empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import parse_ordinal, parse_seconds, parse_tokens
from ..functions.text import folded, basename, is_safe_path
from ..schemas import STATUSES


class Invalid(ValueError):
    """A rule that must hold doesn't."""


def violations(rows: DataFrame, rule: str, key: Column, detail: Column | None = None) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), (detail if detail is not None else F.lit(None)).cast("string").alias("detail"))


def together(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def require_none(found: DataFrame) -> None:
    first = found.orderBy("rule", "key").first()
    if first:
        raise Invalid(f"{first['rule']}: {first['key']}" + (f" ({first['detail']})" if first["detail"] else ""))


def repeated(rows: DataFrame, rule: str, *keys: Column) -> DataFrame:
    """Keys that occur more than once."""
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    found = rows.groupBy(*named).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return violations(found, rule, F.concat_ws("/", *[F.col(f"k{i}").cast("string") for i in range(len(keys))]), F.col("n"))


def missing(expected: DataFrame, found: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Keys of expected that found hasn't."""
    return violations(expected.join(found.select(*keys), keys, "left_anti"), rule, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))


def set_difference(expected: DataFrame, found: DataFrame, keys: list[str], rule: str, once: bool = False, parts: int | None = None) -> DataFrame:
    """Keys on one side only, as often as they stand there, or once; a key with a null is on no other side.

    Both sides are counted by key in one shuffle. parts: its partitions, where the caller knows how many rows there are;
    Spark's own choice joins partitions by compressed bytes, of which dense keys have few, so a task would hold millions.
    """
    side = lambda df, e, f: df.select(*keys, F.lit(e).alias("__e"), F.lit(f).alias("__f"))
    both = side(expected, 1, 0).unionByName(side(found, 0, 1))
    counted = (both.repartition(parts, *keys) if parts else both).groupBy(*keys).agg(F.sum("__e").alias("__e"), F.sum("__f").alias("__f"))
    apart = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    each = lambda what, own, other: F.when(apart | (F.col(other) == 0), F.array_repeat(F.lit(f"{rule}: {what}"), (F.least(F.col(own), F.lit(1)) if once else F.col(own)).cast("int"))).otherwise(F.array().cast("array<string>"))
    wrong = counted.where(apart | (F.col("__e") == 0) | (F.col("__f") == 0))
    named = wrong.select(*keys, F.explode(F.concat(each("missing", "__e", "__f"), each("unexpected", "__f", "__e"))).alias("__rule"))
    return named.select(F.col("__rule").alias("rule"), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]).alias("key"), F.lit(None).cast("string").alias("detail"))


def not_contiguous(tasks: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Empty if the ordinals are 1..N, each once."""
    facts = tasks.agg(F.min(ordinal).alias("lo"), F.max(ordinal).alias("hi"), F.count(F.lit(1)).alias("n"), F.count_distinct(ordinal).alias("d"))
    wrong = facts.where("n = 0 or lo <> 1 or hi <> n or d <> n")
    return violations(wrong, "ordinals must be 1..N", F.lit("tasks"), F.col("n"))


def metrics_violations(staged: DataFrame, expected: DataFrame) -> DataFrame:
    """Violations of staged metrics rows, all text and stripped, against expected(product, task).

    A row may break several rules. A session belongs to one row of its product, whatever the row's status. Where the
    rows have a record, its number in the file goes before the detail.
    """
    at = F.concat(F.lit("record "), F.col("record").cast("string"), F.lit(": ")) if "record" in staged.columns else F.lit("")
    task = parse_ordinal(F.col("task"))
    rows = staged.withColumn("__task", task)
    key = F.concat_ws("/", "product", "task")
    ruled = [
        ("status must be known", ~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)), "status"),
        ("a finished row needs its session", F.col("status").isin("completed", "failed") & (F.coalesce("session", F.lit("")) == ""), "session"),
        ("elapsed_seconds must be finite and at least 0", (F.coalesce("elapsed_seconds", F.lit("")) != "") & parse_seconds(F.col("elapsed_seconds")).isNull(), "elapsed_seconds"),
        ("tokens must be digits", (F.coalesce("tokens", F.lit("")) != "") & parse_tokens(F.col("tokens")).isNull(), "tokens"),
        ("task must be a number", task.isNull(), "task"),
    ]
    each = rows.select(
        key.alias("key"),
        F.explode(F.array_compact(F.array(*[F.when(wrong, F.struct(F.lit(rule).alias("rule"), F.concat(at, F.coalesce(F.substring(F.col(c), 1, 80), F.lit(""))).alias("detail"))) for rule, wrong, c in ruled]))).alias("v"),
    ).select("v.rule", "key", "v.detail")
    keyed = rows.where("__task is not null").select("product", F.col("__task").alias("task"))
    sessions = rows.where(F.coalesce("session", F.lit("")) != "")
    return together(
        each, repeated(keyed, "a product's task has one row", F.col("product"), F.col("task")), set_difference(expected, keyed, ["product", "task"], "rows"),
        repeated(sessions, "a session belongs to one row", F.col("product"), F.col("session")),
    )


def typed_metrics(staged: DataFrame) -> DataFrame:
    """Checked metrics rows with types; blank is null, 0 is a value."""
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    return staged.select(
        "product", parse_ordinal(F.col("task")).alias("task"), "status", blank("session").alias("session"),
        parse_seconds(blank("elapsed_seconds")).alias("elapsed_seconds"), parse_tokens(blank("tokens")).alias("tokens"), F.coalesce("notes", F.lit("")).alias("notes"),
    )


def attachment_collisions(names: DataFrame, task: str = "ordinal", name: str = "name") -> DataFrame:
    """Attachments of one task that would get the same file name, whatever their case."""
    return repeated(names, "attachments of a task need different names", F.col(task), folded(basename(F.col(name))))


def covered_inputs(paths: DataFrame, task: str = "ordinal", path: str = "path") -> DataFrame:
    """Inputs of one task that would lie over one another in its packet."""
    return repeated(paths, "an input of a task lies over another", F.col(task), F.col(path))


def unsafe_paths(paths: DataFrame, path: str = "path") -> DataFrame:
    return violations(paths.where(~is_safe_path(F.col(path))), "paths must stay in their folder", F.col(path))


def changed_files(recorded: DataFrame, found: DataFrame, keys: list[str], path: str = "path", sha256: str = "sha256") -> DataFrame:
    """keys, path: recorded files that are gone or have other contents."""
    now = found.select(*keys, path, F.col(sha256).alias("__now"))
    joined = recorded.join(now, [*keys, path], "left")
    return joined.where(F.col("__now").isNull() | (F.col("__now") != F.col(sha256))).select(*keys, path)
