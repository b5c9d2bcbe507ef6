"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are runs of digits, letters a-z (A-Z lowered) and anything beyond ASCII. The patterns are an item's
windows: every run of `width` consecutive words, or the whole item if it has fewer. For each pattern length
m a shift table holds, for every block of words inside a pattern, how far the search may move on; a block
found in none moves it by m - block + 1 words, so most positions of a clean text are never looked at. Where
the shift is 0 the block is the suffix of some pattern: the bucket of that suffix holds the candidates, which
are compared word by word with the text.

The benchmark is cut into blocks of about `block_bytes` of text at most; each is one pass over the documents. One
block at a time is on the driver, broadcast and searched for: a pass is written before the next begins. What later
passes find is kept by the digest of the text and joined to the rows of the first.

Columns in keep that are named as a result give way to it. Null or empty texts have no words, hits or items. Items of equal id count once; an item whose id is null hits
words but isn't counted or named. Repeated documents are searched each. Empty tables give no rows, or no hits.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ProbeTable, col, map_text, resident, shared_dir, table, written

WIDTH = 10
BLOCK_BYTES = 2 << 20
#: Words in a block of the shift table.
BLOCK_WORDS = 3
MASK = (1 << 64) - 1
TEXT_ID = "__text_id"

_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: bytes | None) -> list[bytes]:
    return _WORDS.findall(text.lower()) if text else []  # bytes.lower changes A-Z alone


class WuManber:
    """Search tables for the windows of a block of items, in arrays: some 20 bytes for each byte of the block's text."""

    def __init__(self, items: list[tuple[object, bytes]], width: int = WIDTH):
        self.number: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        flat, starts, owners = array("i"), defaultdict(list), defaultdict(list)
        for k, (_, text) in enumerate(items):
            at = len(flat)
            flat.extend(self.number.setdefault(w, len(self.number) + 1) for w in words(text))
            if m := min(width, len(flat) - at):
                own = np.arange(at, len(flat) - m + 1, dtype=np.int32)
                starts[m].append(own)
                owners[m].append(np.full(len(own), k, dtype=np.int32))
        self.flat = flat
        self.base = len(self.number) + 1
        self.by_length = [self._tables(m, np.concatenate(starts[m]), np.concatenate(owners[m])) for m in sorted(starts)]

    def _keys(self, columns: list[np.ndarray]) -> np.ndarray:
        key = np.zeros(len(columns[0]), dtype=np.uint64)
        for x in columns:
            key = key * np.uint64(self.base) + x.astype(np.uint64)  # in 64 bits; what meets there is told by comparison
        return key

    def _tables(self, m: int, starts: np.ndarray, owners: np.ndarray) -> tuple:
        flat, b = np.frombuffer(self.flat, dtype=np.int32), min(BLOCK_WORDS, m)
        word = lambda k: flat[starts + k]
        # equal windows lie side by side, first by the key of their suffix, which is their bucket
        suffix = self._keys([word(k) for k in range(m - b, m)])
        order = np.lexsort((owners, *[word(k) for k in range(m - b)], suffix))
        starts, owners, suffix = starts[order], owners[order], suffix[order]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = suffix[1:] != suffix[:-1]
        for k in range(m):
            x = word(k)
            new[1:] |= x[1:] != x[:-1]
        first = np.flatnonzero(new)  # of the owners of each different window
        bounds = np.append(first, len(starts)).astype(np.int32)
        # of every block of words in a window, how far the search may move
        keys = np.concatenate([self._keys([word(k) for k in range(end - b, end)]) for end in range(m, b - 1, -1)])
        far = np.repeat(np.arange(m - b + 1, dtype=np.uint8), len(starts))
        keys, at = np.unique(keys, return_index=True)  # the first of equal ones has the least shift
        bucket = np.searchsorted(suffix[first], keys).astype(np.int32)
        table = ProbeTable(keys)
        shift = table.spread(far[at], 0)
        view = lambda x: memoryview(np.ascontiguousarray(x))
        return m, b, table, view(shift), view(table.spread(bucket, 0)), view(suffix[first]), view(starts[first]), view(bounds), view(owners)

    def search(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged [start, end) runs of hit words, and the items that own an occurring window."""
        get, base, n, flat = self.number.get, self.base, len(text_words), self.flat
        ids = array("i", [get(w, 0) for w in text_words])
        found: list[tuple[int, int]] = []
        items: set = set()
        for m, b, table, shift, bucket, suffix, starts, bounds, owners in self.by_length:
            far, i, find = m - b + 1, m, table.find
            while i <= n:
                key = 0
                for x in ids[i - b : i]:
                    if not x:
                        key = -1  # a word of no item
                        break
                    key = key * base + x & MASK
                at = find(key) if key >= 0 else -1
                if at < 0:
                    i += far
                    continue
                if step := shift[at]:
                    i += step
                    continue
                k, window = bucket[at], ids[i - m : i]
                while k < len(suffix) and suffix[k] == key:
                    if flat[starts[k] : starts[k] + m] == window:
                        found.append((i - m, i))
                        items.update(owners[bounds[k] : bounds[k + 1]].tolist())
                    k += 1
                i += 1
        return merged(found), {self.items[k] for k in items}


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def benchmark_blocks(items: DataFrame, block_bytes: int, id_col: str, text_col: str) -> Iterator[tuple[int, list]]:
    """(number of blocks, the items' rows of a block) for one block after the other, each of about block_bytes at
    most; an item longer than that is a block by itself. Only the block that is asked for is on the driver."""
    rows = items.select(col(id_col).alias("item"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")).distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("b")).first()["b"]
    n = max(1, -(-int(size) // block_bytes))
    if n > 1:  # dealt out once; each block is read from its own files
        path = shared_dir(items.sparkSession)
        rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))).write.partitionBy("block").parquet(path)
        rows = items.sparkSession.read.parquet(path)
    for k in range(n):
        own = rows if n == 1 else rows.where(F.col("block") == k)
        yield n, [(r["item"], bytes(r["text"])) for r in own.select("item", "text").collect()]


def contamination(
    docs: DataFrame, items: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """keep, n_words long, spans array<struct<start,end>> (hit runs of words, end exclusive), items array of item ids."""
    sc = docs.sparkSession.sparkContext
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("spans", span), T.StructField("items", T.ArrayType(items.schema[item_col].dataType))]

    def one_pass(df: DataFrame, shared, own: tuple[str, ...]) -> DataFrame:
        key = ("wu-manber", uuid.uuid4().hex)

        def make():
            search = resident(key, lambda: WuManber(shared.value, width)).search

            def f(texts: list) -> dict:
                got: dict = {"n_words": [], "spans": [], "items": []}
                for t in texts:
                    own = words(t)
                    spans, found = search(own)
                    got["n_words"].append(len(own))
                    got["spans"].append([{"start": a, "end": z} for a, z in spans])
                    got["items"].append(sorted(x for x in found if x is not None))
                return got

            return f

        return map_text(df, make, fields, own, text_col, binary=True)

    keep = tuple(c for c in dict.fromkeys(keep) if c not in ("n_words", "spans", "items"))
    # a text's digest brings together what several passes find in it
    named = docs.withColumn(TEXT_ID, F.unhex(F.sha2(F.coalesce(col(text_col).cast("string"), F.lit("")), 256)))
    first, more = None, []
    for n, block in benchmark_blocks(items, block_bytes, item_col, item_text_col):
        shared = sc.broadcast(block)
        if n == 1:
            return one_pass(docs, shared, keep)
        # a pass is written before the next block is fetched, so one block's tables are held at a time
        if first is None:
            first = written(one_pass(named, shared, (*keep, TEXT_ID)))
        else:
            hits = one_pass(named.select(TEXT_ID, col(text_col)), shared, (TEXT_ID,)).where(F.size("spans") > 0)
            more.append(written(hits.dropDuplicates([TEXT_ID])))
        shared.unpersist()
    others = reduce(DataFrame.unionByName, more).groupBy(TEXT_ID).agg(F.flatten(F.collect_list("spans")).alias("__spans"), F.flatten(F.collect_list("items")).alias("__items"))
    both = first.join(others, TEXT_ID, "left")
    runs = F.array_sort(F.concat("spans", F.coalesce("__spans", F.array().cast(span))))
    start = F.array().cast(span)

    def join_runs(acc, x):
        last = F.get(acc, F.size(acc) - 1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (last["end"] >= x["start"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(wider))).otherwise(F.concat(acc, F.array(x)))

    every = F.concat("items", F.coalesce("__items", F.array().cast(fields[2].dataType)))
    return both.select(*[col(c) for c in keep], "n_words", F.aggregate(runs, start, join_runs).alias("spans"), F.array_sort(F.array_distinct(every)).alias("items"))


def contamination_digest(found: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The spans and items of contamination() as counts and a digest of the item ids, sorted as strings."""
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        *keep, "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), (hits > 0).alias("contaminated"),
    )


def op4_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination_digest(contamination(docs, table(spark, sf_dir, "benchmark")))


_W = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_W} AS w FROM documents),
i AS (SELECT item_id, {_W} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[p : p + m - 1], ' ') AS g
        FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM win),
pos AS (SELECT r, m, p, array_to_string(w[p : p + m - 1], ' ') AS g
        FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, lens WHERE len(w) >= m)),
hit AS (SELECT r, item_id, pos.m AS m, p FROM pos JOIN win ON pos.m = win.m AND pos.g = win.g),
own AS (SELECT r, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (item_id IS NOT NULL)), ',') AS ids FROM hit GROUP BY r),
hw AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + m)) AS q FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN own USING (r) LEFT JOIN hw USING (r)
"""
