"""Totals that only complete products get, and the ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import round_exact, rounded


#: Scores are rounded to 6 places.
SCORE = "decimal(24,10)"


def product_totals(
    rows: DataFrame, modes: tuple[str, ...] = ("rubric", "pairwise"), task_count: int | None = None, product: str = "product", exact: bool = False
) -> DataFrame:
    """One row a product: completeness, score totals, and recorded metrics with totals if all are known.

    task_count is the number of tasks of every product; by default each product's own rows are its tasks. Unless exact,
    scores are added as the decimals that they render to, so that a half is a half in whatever order rows are added.
    """
    n = F.lit(task_count).cast("bigint") if task_count is not None else F.count(F.lit(1))
    cut = round_exact if exact else lambda c, places: rounded(c, places).cast("double")
    own = lambda c: F.col(c) if exact else F.col(c).cast(SCORE)
    done = F.count(F.when(F.col("status").isin("graded", "failed"), 1))
    sums = rows.groupBy(product).agg(
        done.alias("scored_tasks"), n.alias("total_tasks"), F.count(F.lit(1)).alias("entries"),
        F.sum(own("rubric_score")).alias("rubric"), F.sum(own("pairwise_score")).alias("pairwise"),
        F.count("elapsed_seconds").alias("elapsed_seconds_recorded"), F.sum("elapsed_seconds").alias("elapsed"),
        F.count("tokens").alias("tokens_recorded"), F.sum("tokens").alias("used"),
    )
    full = (F.col("scored_tasks") == F.col("total_tasks")) & (F.col("entries") == F.col("total_tasks"))
    none = F.lit(None).cast("double")
    return sums.select(
        product, F.when(full, "complete").otherwise("incomplete").alias("status"), "scored_tasks", "total_tasks",
        (cut(F.when(full, F.col("rubric")), 3) if "rubric" in modes else none).alias("rubric_total"), (F.col("total_tasks") * 5).alias("rubric_max"),
        (cut(F.when(full, F.col("pairwise") / F.col("total_tasks")), 6) if "pairwise" in modes else none).alias("pairwise_win_rate"),
        "elapsed_seconds_recorded", F.when(F.col("elapsed_seconds_recorded") == F.col("total_tasks"), F.col("elapsed")).alias("elapsed_seconds_total"),
        "tokens_recorded", F.when(F.col("tokens_recorded") == F.col("total_tasks"), F.col("used")).alias("tokens_total"),
    )


def any_error(rows: DataFrame, keys: list[str], status: str = "status", error: str = "error") -> DataFrame:
    """keys, failed: whether a row is an error; without keys, of all rows."""
    return rows.groupBy(*keys).agg(F.coalesce(F.bool_or(F.col(status) == error), F.lit(False)).alias("failed"))


def competition_rank(score: Column) -> Column:
    """1, 1, 3: ties share the better rank; a null score has none. Over products, which are few."""
    return F.when(score.isNotNull(), F.rank().over(Window.orderBy(score.desc_nulls_last())))


def competition_ranks(rows: DataFrame, score: str, out: str = "rank") -> DataFrame:
    """The same for any number of rows: ranks are counted by distinct score, and only scores with their counts
    meet in one window; scores rounded to a few places are far fewer than rows."""
    each = rows.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    above = Window.orderBy(F.desc("__s")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = each.select("__s", (F.coalesce(F.sum("__n").over(above), F.lit(0)) + 1).alias(out))
    return rows.join(ranked, F.col(score) == F.col("__s"), "left").drop("__s")


def leaderboard(rows: DataFrame, products: DataFrame, modes: tuple[str, ...], task_count: int) -> DataFrame:
    """Ranked products in report order: scores falling, blanks last, ties in the order of products(product, product_pos)."""
    totals = product_totals(rows, modes, task_count, exact=True)
    primary = "rubric_total" if "rubric" in modes else "pairwise_win_rate"
    n = F.lit(task_count)
    listed = products.join(totals, "product", "left").withColumn("status", F.coalesce("status", F.lit("incomplete")))
    for c in ("scored_tasks", "elapsed_seconds_recorded", "tokens_recorded"):
        listed = listed.withColumn(c, F.coalesce(c, F.lit(0)))
    listed = listed.withColumn("total_tasks", n).withColumn("rubric_max", n * 5).withColumn("rank", competition_rank(F.col(primary)))
    return listed.orderBy(F.col(primary).desc_nulls_last(), "product_pos")
