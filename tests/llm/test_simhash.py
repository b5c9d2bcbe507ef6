import random
import re

import numpy as np
import xxhash

from assayer.llm import simhash
from assayer.llm.components import connected_components


def brute_fingerprint(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not own:
        return 0
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] or [" ".join(own)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    """The least id reachable over links of 3 bits or fewer, for every row."""
    x = np.array(fps, dtype=np.uint64)
    root = list(range(len(x)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= 3) + i + 1:
            root[find(int(j))] = find(i)
    least = {}
    for i, own in enumerate(ids):
        least[find(i)] = min(own, least.get(find(i), own))
    return [least[find(i)] for i in range(len(x))]


def test_fingerprints():
    r = random.Random(1)
    for text in [None, "", " \t\n", "one", "One two", "one two three", "ÀB c d e", *(" ".join(r.choice("abcdefgh") for _ in range(r.randrange(400))) for _ in range(60))]:
        assert simhash.fingerprint(text.encode() if text else None) == brute_fingerprint(text)


def test_links_of_planted_fingerprints(spark):
    r = random.Random(7)
    centres = [r.getrandbits(64) for _ in range(40)]
    fps = set(centres)
    for c in centres:  # neighbours at every distance to 5, chains, and a dense ball
        for d in range(1, 6):
            fps.add(c ^ sum(1 << b for b in r.sample(range(64), d)))
        x = c
        for _ in range(6):
            x ^= sum(1 << b for b in r.sample(range(64), 3))
            fps.add(x)
    fps |= {centres[0] ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    roots = {r.node: r.root for r in connected_components(links).collect()}
    want = brute_components(list(range(len(fps))), fps)
    groups = {}
    for s, w in zip(signed, want):
        groups.setdefault(w, set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    fps = [brute_fingerprint(r.text) for r in rows]
    want = {(r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components([r.doc_id for r in rows], fps))}
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def test_nulls_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string, fp string, component_id long"
    rows = [(5, None, "x", 1), (3, "", None, 2), (9, "the same text here", "y", 3), (8, "the same text here", "y", 3), (8, "the same text here", "y", 3), (None, "another text, quite its own", None, None)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(False, 3, 3), (False, 5, 3), (False, 8, 8), (False, 8, 8), (False, 9, 8)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    kept = simhash.deduplicate(spark.createDataFrame(rows, schema))
    with_names = simhash.near_duplicates(spark.createDataFrame(rows, schema), ("fp", "component_id", "text")).collect()
    assert sorted(with_names[0].asDict()) == ["component_id", "doc_id", "fingerprint", "fp", "text"] and {r.fp for r in with_names} == {"x", "y", None}
    assert kept.columns == ["doc_id", "text", "fp", "component_id"]
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 8]
    empty = spark.createDataFrame([], schema)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicate(empty).count() == 0


def test_dense_group_links_by_few_rows(spark):
    """Thousands of fingerprints around one, at 3 bits from another such group: no bucket may give its pairs."""
    r = random.Random(11)
    c = r.getrandbits(64)
    low = [0, *(1 << b for b in range(21))]
    fps = {c ^ x ^ y for x in low for y in low} | {c ^ (1 << 30) ^ (1 << 50) ^ (1 << 60) ^ x for x in low}
    far = c ^ sum(1 << b for b in (3, 7, 12, 25, 26, 27, 28))  # 4 bits from the nearest at least
    fps |= {far, c ^ sum(1 << b for b in range(40, 47)), c ^ sum(1 << b for b in range(40, 50))}
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    assert links.count() < 20 * len(fps)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    groups = {}
    for s, w in zip(signed, brute_components(list(range(len(fps))), fps)):
        groups.setdefault(w, set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({next(iter(g)) for g in groups.values()}) > 1


def test_three_bits_in_one_block(spark):
    r = random.Random(12)
    fps = []
    for k in range(30):  # pairs of single fingerprints, and their kind at 4 bits, which aren't linked
        c, block = r.getrandbits(64), [range(0, 21), range(21, 42), range(42, 64)][k % 3]
        fps += [c, c ^ sum(1 << b for b in r.sample(block, 3 + k % 2))]
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    got = {frozenset((x.a, x.b)) for x in simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    assert got == {frozenset(signed[2 * k : 2 * k + 2]) for k in range(0, 30, 2)}


def test_growing_tables_are_not_broadcast(spark):
    """Explodes multiply rows behind the planner's estimate: what it would broadcast grows with the input."""
    r = random.Random(13)
    fps = [r.getrandbits(64) - (1 << 63) for _ in range(50)]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(simhash.near_links(spark.createDataFrame([(x,) for x in fps], "fp long")))
    docs = spark.createDataFrame([(i, f"text {i % 9} of some words") for i in range(20)], "doc_id long, text string")
    assert "Broadcast" not in plan(simhash.near_duplicates(docs))


def test_deduplication_broadcasts_its_bitmap_alone(spark):
    docs = spark.createDataFrame([(i, f"text {i % 9} of some words") for i in range(20)], "doc_id long, text string")
    plan = simhash.deduplicate(docs)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "BroadcastHashJoin" in x or "BroadcastNestedLoopJoin" in x]
    assert joins and all("__word" in x for x in joins)
