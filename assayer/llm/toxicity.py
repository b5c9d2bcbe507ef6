"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words (runs of letters, lower case), the beginnings of the longer ones, and the beginnings that
two or more of its words share, each hashed into one of `BUCKETS` and counted once a text. The machine scores sigmoid(bias + sum of weights + sum over
pairs of <v_i, v_j>), so that two terms can mean together what neither means alone. It is trained in numpy on
a bounded sample of labelled rows, on the terms whose presence depends on the label by a chi-squared test, over all
rows or over those that hold another such term; weights have an L1 and factors an L2 penalty.

Null and wordless texts have the score of the bias alone. Labels that are null teach nothing; a document with
two labels teaches both; without labelled rows every score is 0. A score of exactly 0.5 is predicted toxic. Columns
named as a result give way to it. Repeated documents are scored each; an empty
table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, crc_of_id, map_text, table, written

BUCKETS = 1 << 18
FACTORS = 4
#: Bound of the training sample: labelled rows of each class, those of least text hash.
ROWS_PER_CLASS = 3000
#: A term must stand in so many rows of the sample and depend on the label by this chi-squared value.
LEAST_ROWS, LEAST_CHI2 = 4, 10.83
#: The same among the rows that hold another term of the model; higher, as that many more pairs are tried.
PAIR_CHI2 = 40.0
#: A term in more than this part of the rows (1 / MOST_COMPANY) isn't tried as another's company.
MOST_COMPANY = 2
#: Rows of either label in which the term is expected to stand beside its company.
LEAST_EXPECTED = 5
#: Lengths of the beginnings of words that are terms beside the words.
BEGINNINGS = (4, 5, 6, 7, 8)
EPOCHS = 30

_TERMS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_TERMS.findall(text.lower())) if text else set()


def buckets(word: str) -> list[int]:
    """The buckets of a word and of its beginnings."""
    forms = [word, *(word[:k] + "-" for k in BEGINNINGS if k < len(word))]
    return [zlib.crc32(x.encode("utf-8", "replace")) % BUCKETS for x in forms]


def shared_buckets(word: str) -> list[int]:
    """The buckets of a word's beginnings as those that another word of the text has too: one stem in several words says
    more than in one."""
    return list({zlib.crc32((word[:k] + "=").encode("utf-8", "replace")) % BUCKETS for k in BEGINNINGS if k < len(word)})


def terms(text: str | None) -> np.ndarray:
    own = words(text)
    held = Counter(b for w in own for b in shared_buckets(w))
    return np.unique(np.array([*(b for w in own for b in buckets(w)), *(b for b, n in held.items() if n > 1)], dtype=np.int32))


class FactorizationMachine:
    """Second-order machine over sets of active terms; term j of the model is bucket active[j]."""

    def __init__(self, active: np.ndarray, seed: int = 5):
        self.active = active
        self.bias = 0.0
        self.w = np.zeros(len(active))
        self.v = np.random.default_rng(seed).normal(0, 0.01, (len(active), FACTORS))

    def raw(self, ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the factor sums, of rows whose term numbers begin at start[row]."""
        ends = [*start[1:].tolist(), len(ids)]
        c = np.concatenate([np.zeros((1, 1 + 2 * FACTORS)), np.cumsum(np.concatenate([self.w[ids][:, None], self.v[ids], self.v[ids] ** 2], axis=1), axis=0)])
        s = c[ends] - c[start]
        pairs = 0.5 * (s[:, 1 : 1 + FACTORS] ** 2 - s[:, 1 + FACTORS :]).sum(axis=1)
        return self.bias + s[:, 0] + pairs, s[:, 1 : 1 + FACTORS]

    def fit(self, rows: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, l1: float = 4e-4, l2: float = 1e-3, seed: int = 3) -> FactorizationMachine:
        r, n = np.random.default_rng(seed), len(self.active)
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        seen_w, seen_v, seen_b = np.full(n, 1e-8), np.full((n, FACTORS), 1e-8), 1e-8
        for _ in range(epochs):
            order = r.permutation(len(rows))
            for at in range(0, len(order), 256):
                own = order[at : at + 256]
                sizes = np.array([len(rows[i]) for i in own])
                ids, start = np.concatenate([rows[i] for i in own]), np.cumsum(sizes) - sizes
                z, s = self.raw(ids, start)
                d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]) * weight[own] / len(own)
                each, sums = np.repeat(d, sizes), np.repeat(s, sizes, axis=0)
                gw = np.bincount(ids, each, n)
                gv = np.stack([np.bincount(ids, each * (sums[:, k] - self.v[ids, k]), n) for k in range(FACTORS)], axis=1) + l2 * self.v
                seen_w += gw**2
                seen_v += gv**2
                seen_b += d.sum() ** 2
                pace = rate / np.sqrt(seen_w)
                moved = self.w - pace * gw
                self.w = np.sign(moved) * np.maximum(np.abs(moved) - pace * l1, 0)
                self.v -= 0.2 * rate / np.sqrt(seen_v) * gv
                self.bias -= rate / np.sqrt(seen_b) * d.sum()
        return self


def term_rows(docs: DataFrame, keep: tuple[str, ...], text_col: str) -> DataFrame:
    def make():
        return lambda texts: {"terms": [terms(t) for t in texts]}

    return map_text(docs, make, [T.StructField("terms", T.ArrayType(T.IntegerType()))], keep, text_col)


def chi_squared(held: np.ndarray, toxic: np.ndarray, n: float, t: float) -> np.ndarray:
    """Of each term, held by so many of n rows and so many of the t toxic ones: how far its presence depends on the label."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(n * (toxic * n - held * t) ** 2 / (held * (n - held) * t * (n - t)))


def partners(rows: list[np.ndarray], y: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Terms that depend on the label among the rows that hold one of the active terms, if not by themselves: a group's
    name is as frequent in clean as in toxic texts, but not beside an insult."""
    number = np.full(BUCKETS, -1, dtype=np.int32)
    number[active] = np.arange(len(active))
    of = [number[x][number[x] >= 0] for x in rows]
    term, row = np.concatenate([*of, np.empty(0, dtype=np.int32)]), np.repeat(np.arange(len(rows)), [len(x) for x in of])
    order = np.argsort(term, kind="stable")
    found = np.zeros(BUCKETS, dtype=bool)
    often = np.bincount(np.concatenate([*rows, np.empty(0, dtype=np.int32)]), minlength=BUCKETS) >= LEAST_ROWS
    rows = [x[often[x]] for x in rows]
    for own in np.split(row[order], np.flatnonzero(np.diff(term[order])) + 1):
        n, t = len(own), y[own].sum()
        # what stands in most texts is no company: beside it things are as they are by themselves
        if min(t, n - t) >= LEAST_EXPECTED and n <= len(rows) / MOST_COMPANY:
            held = np.bincount(np.concatenate([rows[i] for i in own]), minlength=BUCKETS).astype(float)
            toxic = np.bincount(np.concatenate([rows[i] for i in own if y[i]]), minlength=BUCKETS)
            enough = held * min(t, n - t) / n >= LEAST_EXPECTED  # below, chi-squared says nothing
            found |= enough & (chi_squared(held, toxic, n, t) >= PAIR_CHI2)
    return np.flatnonzero(found)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows_per_class: int = ROWS_PER_CLASS) -> dict:
    """Fits the machine on at most rows_per_class different texts of each label, those of least hash."""
    y = (col(label_col).cast("double") >= 0.5).cast("int")
    marks = labels.where(col(id_col).isNotNull() & col(label_col).isNotNull()).select(col(id_col).alias("__id"), y.alias("__y")).distinct()
    text = col(text_col).cast("string")
    hashed = written(
        docs.where(text.isNotNull()).select(col(id_col).alias("__id"), F.xxhash64(text).alias("__h")).join(marks, "__id").groupBy("__y", "__h").agg(F.min("__id").alias("__id"))
    )
    chosen = None
    held = {r["__y"]: r["count"] for r in hashed.groupBy("__y").count().collect()}
    for label in (0, 1):
        # hashes are even: a few times the rows that are wanted lie below this bound, and only they are sorted
        bound = min(2**63 - 1, int(-(2**63) + min(1.0, 4 * rows_per_class / max(1, held.get(label, 0))) * 2**64))
        own = hashed.where((F.col("__y") == label) & (F.col("__h") <= bound)).orderBy("__h").limit(rows_per_class)
        chosen = own if chosen is None else chosen.unionByName(own)
    chosen = written(chosen)  # at most twice rows_per_class ids
    rows = docs.withColumn("__id", col(id_col)).withColumn("__h", F.xxhash64(text)).join(F.broadcast(chosen), ["__id", "__h"])
    # as Arrow, not as Python integers: the sample's terms are some ten million
    sample = term_rows(rows, ("__y", "__h"), text_col).dropDuplicates(["__y", "__h"]).toArrow().sort_by([("__h", "ascending"), ("__y", "ascending")])
    if not sample.num_rows:
        return {}
    y = sample.column("__y").to_numpy().astype(float)
    lists = sample.column("terms").combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    rows_ = [flat[a:z] for a, z in zip(ends, ends[1:])]
    return fit_terms(rows_, y)


def fit_terms(rows: list[np.ndarray], y: np.ndarray) -> dict:
    """The model of rows of terms and their labels: the terms that pass the screens, and the machine over them."""
    held = np.bincount(np.concatenate(rows), minlength=BUCKETS).astype(float)
    toxic = np.bincount(np.concatenate([x for x, t in zip(rows, y) if t] or [rows[0][:0]]), minlength=BUCKETS)
    active = np.flatnonzero((held >= LEAST_ROWS) & (chi_squared(held, toxic, len(y), y.sum()) >= LEAST_CHI2)).astype(np.int32)
    active = np.union1d(active, partners(rows, y, active)).astype(np.int32)
    number = np.full(BUCKETS, -1, dtype=np.int32)
    number[active] = np.arange(len(active))
    rows = [x[x >= 0] for x in (number[own] for own in rows)]
    fm = FactorizationMachine(active).fit(rows, y)
    return {"bias": float(fm.bias), "active": active, "w": fm.w, "v": fm.v}


class Scorer:
    """A trained machine, with the model's terms of recent words kept."""

    def __init__(self, model: dict):
        self.fm = FactorizationMachine(model["active"])
        self.fm.bias, self.fm.w, self.fm.v = model["bias"], model["w"], model["v"]
        self.number = {int(b): i for i, b in enumerate(model["active"])}
        self.known: dict[str, tuple[tuple[int, ...], tuple[int, ...]]] = {}

    def terms(self, text: str | None) -> np.ndarray:
        if len(self.known) > 300_000:
            self.known.clear()
        own: set[int] = set()
        once: set[int] = set()
        for w in words(text):
            if (got := self.known.get(w)) is None:
                got = self.known[w] = tuple(tuple(i for b in of(w) if (i := self.number.get(b)) is not None) for of in (buckets, shared_buckets))
            if got[0]:
                own.update(got[0])
            for i in got[1]:
                (own if i in once else once).add(i)
        return np.array(sorted(own), dtype=np.int64)

    def __call__(self, texts: list) -> np.ndarray:
        rows = [self.terms(t) for t in texts]
        sizes = np.array([len(r) for r in rows])
        z, _ = self.fm.raw(np.concatenate(rows), np.cumsum(sizes) - sizes)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def held_out(id_col: str = "doc_id") -> Column:
    return crc_of_id(id_col) % 5 == 0


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Trains on labelled rows that aren't held out and scores all: keep, held_out, score, predicted."""
    model = train(docs.where(~held_out(id_col)), labels, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value) if shared.value else None
        return lambda texts: {"score": scorer(texts) if scorer else np.zeros(len(texts))}

    marked = docs.withColumn("held_out", held_out(id_col))
    scored = map_text(marked, make, [T.StructField("score", T.DoubleType())], (*keep, "held_out"), text_col)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_toxicity(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
