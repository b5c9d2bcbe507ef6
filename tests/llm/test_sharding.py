import hashlib
import zlib
from collections import Counter
from itertools import groupby

from assayer.llm import sharding


def least_capacity(sizes, shards):
    """By halving: the smallest capacity with which contiguous runs fit."""

    def needed(cap):
        n, full = 0, None
        for s in sizes:
            if full is None or full + s > cap:
                n, full = n + 1, 0
            full += s
        return n

    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if needed(mid) <= shards else (mid + 1, hi)
    return hi


def test_cuts_are_minimax(spark):
    sizes = [5, 1, 9, 2, 2, 8, 3, 3, 7, 1, 6, 4, 2, 5, 5, 1]
    for shards in (2, 3, 4):
        groups = spark.createDataFrame([(f"{i:x}0", size) for i, size in enumerate(sizes)], "hash string, size long")
        big, cuts = sharding.cut_points(groups, shards, 16)
        assert not big
        cut = [sum(c <= f"{b:x}0" for c in cuts) - 1 for b in range(len(sizes))]
        assert cut == sorted(cut) and max(cut) < shards
        most = max(sum(sizes[b] for b in own) for _, own in groupby(range(len(sizes)), lambda b: cut[b]))
        assert most == least_capacity(sizes, shards)


def check(rows, got, shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(shards))
    shard_of = {}
    for r in got:
        assert shard_of.setdefault(r.text_crc32, r.shard) == r.shard
    return by


def test_rows_with_a_huge_group(spark):
    rows = [(i, "the same " * 5) for i in range(700)] + [(i, f"text {i} " * (1 + i % 7)) for i in range(700, 1500)] + [(2000, None), (2001, ""), (2001, ""), (2002, "é😀")]
    got = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    by = check(rows, got, 8)
    load = {k: sum(r.size for r in got if r.shard == k) for k in by}
    giant = max(load, key=load.get)
    assert len(by[giant]) == 700  # its own shard
    rest = [v for k, v in load.items() if k != giant]
    assert len(rest) == 7 and max(rest) - min(rest) < 0.1 * max(rest)


def test_whole_table_and_empty(spark):
    from assayer.llm.registry import queries

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = queries()["op5_sharding"](spark, "/root/testdata/sf0.01").collect()
    check(rows, got, 40)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    empty = spark.createDataFrame([], "doc_id long, text string, shard int, size int")
    assert sharding.shard_rows(empty).count() == 0


def test_capacity_is_the_least_over_a_whole_table(spark):
    """By brute force over the table's groups of equal texts, from fine buckets and from coarse ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    groups = Counter()
    for r in docs.collect():
        raw = (r.text or "").encode()
        digest = hashlib.md5(raw).hexdigest()
        groups[digest] += len(raw) + 16

    def least(atoms, shards=40):
        left, giants = sum(atoms.values()), set()
        for key, size in sorted(atoms.items(), key=lambda x: (-x[1], x[0]))[: shards - 1]:
            if size * (shards - len(giants)) < left:
                break
            giants.add(key)
            left -= size
        return least_capacity([size for key, size in sorted(atoms.items()) if key not in giants], shards - len(giants)), len(giants)

    want, giants = least(groups)
    for buckets in (16, 256, sharding.BUCKETS):
        load = Counter()
        for r in sharding.shard_rows(docs, buckets=buckets).collect():
            load[r.shard] += r.size
        assert len(load) == 40 and max(n for k, n in load.items() if k >= giants) == want
