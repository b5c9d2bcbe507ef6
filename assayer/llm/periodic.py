r"""Periodic runs of words, found on a harmonic grid with longest common extensions.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) that is `least` words long
or more, and `times` periods or more, and that no neighbouring word extends. For each period p the grid's points are
the multiples of p. A run of period p with three periods or more holds three neighbouring points, so each run is met at
the first of its points: the extension forward from jp and (j+1)p and the one backward from the words before them give
its two ends. Extensions are answered from the suffix array of the text and that of the reversed text, the lengths that
neighbours in them share, and range minima over these: over blocks of `BLOCK` in a sparse table, inside a block by
minima from its ends. Points where the words that such a run must share differ (the point's own, the next point's and
some between) extend to nothing long enough and are not asked; a text without a point to ask builds no arrays.

A stretch that is found for several periods has the least of them as its own.

Every text is whole in one task, in arrays of its words: about n ln n grid points, asked in slices of bounded size. So
memory follows the longest text. Null and empty texts have no words and no runs; repeated rows are treated each; an
empty table gives no rows; other columns are not used; no ties arise, as runs are told apart by start and period.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, small_batches, table

LEAST_LENGTH, LEAST_TIMES = 24, 3
BLOCK = 16
#: Grid points asked at once.
SLICE = 1 << 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """The order of the suffixes of ids (numbers from 0), by doubling the length that they are ranked by."""
    n = len(ids)
    rank, size = ids.astype(np.int64), 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - size] = rank[size:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]]))
        rank = new
        size *= 2
        if size >= n or rank[order[-1]] == n - 1:
            return order


class Extensions:
    """Longest common prefixes of any two suffixes of a sequence."""

    def __init__(self, ids: np.ndarray):
        self.n = n = len(ids)
        order = suffix_array(ids)
        self.rank = np.empty(n, dtype=np.int64)
        self.rank[order] = np.arange(n)
        # what each suffix shares with the one before it in order, from left to right: one word less at most each step
        seq, at, before = ids.tolist(), self.rank.tolist(), order.tolist()
        lcp, k = [0] * n, 0
        for i in range(n):
            if not at[i]:
                k = 0
                continue
            j = before[at[i] - 1]
            while i + k < n and j + k < n and seq[i + k] == seq[j + k]:
                k += 1
            lcp[at[i]] = k
            k = max(0, k - 1)
        blocks = -(-n // BLOCK)
        grid = np.full(blocks * BLOCK, n, dtype=np.int64)
        grid[:n] = lcp
        self.lcp = grid
        rows = grid.reshape(blocks, BLOCK)
        self.upto = np.minimum.accumulate(rows, axis=1).ravel()
        self.since = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [rows.min(axis=1)]
        while 2 << len(self.table) - 1 <= blocks:
            last, half = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of lcp[lo..hi], both ends included."""
        first, last = lo // BLOCK, hi // BLOCK
        out = np.minimum(self.since[lo], self.upto[hi])
        inside = np.flatnonzero(first == last)
        if len(inside):
            a, b = lo[inside], hi[inside]
            least = self.lcp[a]
            for _ in range(BLOCK - 1):
                a = np.minimum(a + 1, b)
                least = np.minimum(least, self.lcp[a])
            out[inside] = least
        count = last - first - 1
        level = np.frexp(np.maximum(count, 1).astype(float))[1] - 1
        for k in np.unique(level[count > 0]):
            own = np.flatnonzero((count > 0) & (level == k))
            whole = self.table[k]
            out[own] = np.minimum(out[own], np.minimum(whole[first[own] + 1], whole[last[own] - (1 << int(k))]))
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the suffixes at a and b (different places; n is the empty suffix) go on alike."""
        out = np.zeros(len(a), dtype=np.int64)
        some = np.flatnonzero((a < self.n) & (b < self.n))
        x, y = self.rank[a[some]], self.rank[b[some]]
        out[some] = self._least(np.minimum(x, y) + 1, np.maximum(x, y))
        return out


def grid_points(ids: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(periods, points): the grid points where a run of that period may be met first, in slices.

    From its first point on, such a run has max(least, times * p) - 2p + 1 words at least that equal those p further on."""
    n = len(ids)
    p = np.arange(1, n // times + 1)
    beyond = np.maximum(least, times * p) - 2 * p
    count = np.maximum(0, (n - 1 - beyond - p) // p + 1)
    p, beyond, count = (x[count > 0] for x in (p, beyond, count))
    upto = np.cumsum(count)
    i = 0
    while i < len(p):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + SLICE, side="right")))
        of = np.repeat(p[i:j], count[i:j])
        at = (np.arange(len(of)) - np.repeat(upto[i:j] - count[i:j] - (upto[i - 1] if i else 0), count[i:j])) * of
        far = np.repeat(beyond[i:j], count[i:j])
        for share in (0, 1, 2, 3):  # the point itself, the last word that must be shared, and two between
            x = at + (far * (0, 3, 1, 2)[share]) // 3
            same = ids[x] == ids[x + of]
            of, at, far = of[same], at[same], far[same]
        if len(of):
            yield of, at
        i = j


def periodic_runs(ids: np.ndarray, least: int = LEAST_LENGTH, times: int = LEAST_TIMES) -> np.ndarray:
    """(start, length, period) of every run of ids, by start, then period. times is 3 or more."""
    if times < 3:
        raise ValueError("a run of fewer than three periods may hold too few grid points")
    n = len(ids)
    found = [np.empty((0, 3), dtype=np.int64)]
    ahead = back = None
    for p, at in grid_points(ids, least, times):
        if ahead is None:
            ahead, back = Extensions(ids), Extensions(ids[::-1])
        start = at - back.of(n - at, n - at - p)
        length = at + p + ahead.of(at, at + p) - start
        own = length >= np.maximum(least, times * p)
        found.append(np.unique(np.stack([start[own], length[own], p[own]], axis=1), axis=0))
    every = np.unique(np.concatenate(found), axis=0)
    new = np.ones(len(every), dtype=bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)  # of one stretch's periods, the least comes first
    every = every[new]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of n words is in no run, or in every run that holds it among the first period's words."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def numbered(words: list[str]) -> np.ndarray:
    """Words as numbers from 0, equal words alike."""
    of: dict[str, int] = {}
    return np.fromiter((of.setdefault(w, len(of)) for w in words), dtype=np.int64, count=len(words))


RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])


def find_periodic_runs(
    docs: DataFrame, least: int = LEAST_LENGTH, times: int = LEAST_TIMES, id_col: str = "doc_id", text_col: str = "text",
    rewrite: Callable[[list[str], str], list[str]] | None = None,
) -> DataFrame:
    """id_col, n_words long, runs array<struct<start, length, period>> and collapsed, the text with each run cut to its
    first period, of every whole text. rewrite(words, id as text) may give other words for a text."""
    small_batches(docs)
    source = docs.select(col(id_col), F.coalesce(col(id_col).cast("string"), F.lit("")).alias("__key"), col(text_col).cast("string").alias("__text"))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    schema = T.StructType([source.schema.fields[0], *fields])

    def one(key: str, text: str | None) -> tuple[int, list, str]:
        words = WORD.findall(text or "")
        if rewrite is not None:
            words = rewrite(words, key)
        runs = periodic_runs(numbered(words), least, times) if len(words) >= max(least, times) else ()
        if not len(runs):
            return len(words), [], " ".join(words)
        keep = kept_words(len(words), runs)
        return len(words), [tuple(r) for r in runs.tolist()], " ".join([w for w, k in zip(words, keep.tolist()) if k])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])), pa.string())
        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                b = whole.slice(at, 100)
                got = zip(*[one(k, t) for k, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist())])
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(x), kind) for x, kind in zip(got, kinds))], names=schema.names)

    return source.mapInArrow(find, schema)


def strongest(runs: Column) -> Column:
    """The run of the greatest length by period, exactly; of equal ones the first by start, then period; null for none."""
    none = F.lit(None).cast(RUN.simpleString())
    # runs are in order, so a later one must be greater
    more = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    return F.aggregate(runs, none, lambda best, x: F.when(more(best, x), x).otherwise(best))


def repeated_tail(words: list[str], key: str) -> list[str]:
    """For every tenth id by crc32: the words from a place on, given by the id, repeat their first p."""
    h, n = zlib.crc32(key.encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op13_periodic_runs(spark, sf_dir):
    found = find_periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeated_tail).withColumn("best", strongest(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.*", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
