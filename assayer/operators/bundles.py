"""Files' texts to one text, and contents to one digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.digests import fingerprint, json_map
from ..functions.text import is_blank, path_key, reaches
from ..schemas import MAX_CHARS


def bundle(files: DataFrame, keys: list[str], path: str = "path", text: str = "text", error: str | None = None, max_chars: int = MAX_CHARS) -> DataFrame:
    """keys, bundle, error: the texts of a task's files in path order, each under a heading with its path.

    A blank file, one that reaches max_chars, or a bundle beyond it is an error, and so is a file that has one. The
    sum of lengths is taken first: no bundle beyond the cap is ever gathered.
    """
    own = F.col(error) if error else F.lit(None).cast("string")
    chunk = F.concat(F.lit("[文件 "), F.col(path), F.lit("]\n"), F.coalesce(text, F.lit("")))  # a fixed value of the format
    wrong = (
        F.when(own.isNotNull(), own).when(is_blank(F.col(text)), "a file has no text")
        .when(reaches(F.col(text), max_chars), "a file's text reaches the limit")
    )
    marked = files.select(*keys, path_key(F.col(path)).alias("__key"), chunk.alias("__chunk"), wrong.alias("__wrong"))
    sums = marked.groupBy(*keys).agg(F.sum(F.length("__chunk")).alias("__chars"), F.count(F.lit(1)).alias("__n"), F.min_by("__wrong", F.when(F.col("__wrong").isNotNull(), F.col("__key"))).alias("__first"))
    error_of = F.when(F.col("__first").isNotNull(), F.col("__first")).when(F.col("__chars") + 2 * (F.col("__n") - 1) > max_chars, "the files' text exceeds the limit")
    judged = sums.select(*keys, error_of.alias("error"))
    fine = marked.join(judged.where("error is null"), keys, "left_semi")
    text_of = fine.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__key", "__chunk"))).alias("c"))
    joined = text_of.select(*keys, F.array_join(F.transform("c", lambda x: x["__chunk"]), "\n\n").alias("bundle"))
    return judged.join(joined, keys, "left").select(*keys, "bundle", "error")


def files_digest(files: DataFrame, keys: list[str], path: str = "path", sha256: str = "sha256") -> DataFrame:
    """keys, digest, files: the map from a task's paths to their contents' digests in canonical form, and its digest."""
    entries = F.map_from_entries(F.collect_list(F.struct(path, sha256)))
    return files.groupBy(*keys).agg(json_map(entries).alias("files")).select(*keys, fingerprint(F.col("files")).alias("digest"), "files")


def kept_before_cap(size: Column, keys: list[str], order: list[str], cap: int) -> Column:
    """Whether a page is kept: the text before it doesn't exceed the cap."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(before), F.lit(0)) <= cap


def over_count(rows: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """The keys that have more than cap rows, as cells of a workbook."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap)
