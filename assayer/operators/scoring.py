"""Verdicts to task scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded, task_score


def item_sums(verdicts: DataFrame, keys: list[str], score: str = "score", met: str = "met", cost: str | None = None) -> DataFrame:
    """keys, items, total (positive scores), earned (scores of met items, negative ones included), cost.

    One shuffle on keys with partial sums.
    """
    s = F.col(score).cast("bigint")
    sums = [
        F.count(F.lit(1)).alias("items"),
        F.coalesce(F.sum(F.when(s > 0, s)), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col(met), s)), F.lit(0)).alias("earned"),
    ]
    if cost:
        sums.append(F.sum(cost).alias("cost"))
    return verdicts.groupBy(*keys).agg(*sums)


def with_task_score(sums: DataFrame, places: int = 6, out: str = "rubric_score") -> DataFrame:
    return sums.withColumn(out, rounded(task_score(F.col("earned"), F.col("total")), places))


def latest_records(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last record of each key of an append-only log: a partial aggregate, no window over hot keys."""
    rest = [c for c in log.columns if c != key]
    best = log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def unjudged(requests: DataFrame, verdicts: DataFrame, key: str = "key") -> DataFrame:
    """The requests that no verdict answers yet."""
    return requests.join(verdicts.select(key), key, "left_anti")


def reused(requests: DataFrame, verdicts: DataFrame, key: str = "key") -> DataFrame:
    return requests.join(verdicts, key)


def flat_totals(rows: DataFrame, product: str = "product", score: str = "task_score") -> DataFrame:
    """A product's sum of scores already rounded to 3 places, and the most it could have."""
    return rows.groupBy(product).agg(F.sum(score).alias("total"), (F.count(F.lit(1)) * 5).alias("most"))


def win_rate(score: Column) -> Column:
    """Mean of pairwise scores; missing ones count 0, and no row gives 0."""
    return F.coalesce(F.avg(F.coalesce(score, F.lit(0.0))), F.lit(0.0))
