import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

public_tokenizers = pytest.importorskip("public_tokenizers")

from assayer.llm import packing  # noqa: E402

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("length", T.StringType())])


@pytest.fixture(scope="module")
def coder():
    return packing.ByteTokens(JSON, RANKS)


def library_ids(coder, text):
    return np.asarray(coder.library.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_ids_are_the_librarys(coder):
    rng = random.Random(3)
    alphabet = [*"aAbz 09'.,;-_<|>\n\t\r\x0b\x1c\x1f\x85\xa0  é ßñ Ωя中文👍🏽́​ 　ⅷ٣ɐ", "don't", "we'LL", "<|endoftext|>", "  ", "\n\n"]
    for _ in range(4000):
        t = "".join(rng.choices(alphabet, k=rng.randint(0, 25)))
        assert coder.encode(t) == library_ids(coder, t), repr(t)
    for t in ("ab" * 150_000, "x" * 5000 + " " * 5000, "é" * 300):
        assert coder.encode(t) == library_ids(coder, t)


def test_every_character_of_the_fast_way(coder):
    """Below PLAIN_BELOW both libraries class characters alike, and white space alike everywhere."""
    for cp in [*range(0x250), *(c for c in range(0x250, 0x110000) if chr(c).isspace() or c in (0x180E, 0x200B, 0x2060, 0xFEFF))]:
        for t in (f"a{chr(cp)}b", f"1{chr(cp)}{chr(cp)} {chr(cp)}x.{chr(cp)}"):
            assert coder.encode(t) == library_ids(coder, t), hex(cp)


def checked(rows, tokens, documents=None, attention=None):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= tokens and len(held) <= (documents or tokens) and sum(n * n for _, n in held) <= (attention or tokens**2)
    return len(bins)


def fewest(lengths, tokens, documents, attention):
    """The least number of bins by exhaustive search, for a few lengths."""
    best = len(lengths)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for b in sorted(set(map(tuple, bins))):
            if sum(b) + lengths[k] <= tokens and len(b) < documents and sum(x * x for x in b) + lengths[k] ** 2 <= attention:
                rest = [list(x) for x in bins]
                rest.remove(list(b))
                go(k + 1, [*rest, [*b, lengths[k]]])
        go(k + 1, [*bins, [lengths[k]]])

    go(0, [])
    return best


def test_plan_against_exhaustive_search():
    rng = random.Random(1)
    near = 0
    for _ in range(120):
        tokens, documents = 20, rng.choice([2, 3, 20])
        attention = rng.choice([400, 250])
        lengths = sorted((rng.randint(1, 15) for _ in range(9)), reverse=True)
        plan = packing.plan_packing({n: lengths.count(n) for n in lengths}, tokens, documents, attention)
        least = fewest(lengths, tokens, documents, attention)
        assert least <= plan.opened <= least + 1
        near += plan.opened == least
    assert near >= 100


def test_rules_and_refusals():
    with pytest.raises(ValueError):
        packing.plan_packing({5: 1}, 10, rules=("first",))
    with pytest.raises(ValueError):
        packing.plan_packing({5: 1}, 10, attention=24)
    assert packing.plan_packing({}, 10).opened == 0
    # eight of 5 and eight of 3: both rules respect two documents a bin
    for rule in packing.RULES:
        assert packing.plan_packing({5: 8, 3: 8}, 8, documents=2, rules=(rule,)).opened == 8


def test_counts_of_any_size_make_a_bounded_plan():
    rng = random.Random(2)
    counts = {n: rng.randint(1, 10**9) for n in range(1, 513)}
    plan = packing.plan_packing(counts, 512, documents=64)
    total = sum(n * k for n, k in counts.items())
    assert plan.opened * 512 < 1.01 * total or plan.opened < 1.01 * sum(counts.values()) / 64
    assert len(plan.steps) < 20_000


def test_pack(spark):
    rng = random.Random(4)
    lengths = [rng.choice([1, 1, 7, 7, 7, 50, rng.randint(1, 64)]) for _ in range(3000)]
    df = spark.createDataFrame([(i // 2, n, "x") for i, n in enumerate(lengths)], "doc_id long, length long, offset string")
    for limits in ({}, {"documents": 5}, {"attention": 1500, "tokens": 64}, {"documents": 6, "attention": 1200, "weights": (1.0, 1.0, 1.0)}):
        limits = {"tokens": 64} | (limits if limits.get("attention", 4096) >= 64**2 else {k: v for k, v in limits.items() if k != "attention"} | {"attention": 4096 + limits["attention"]})
        rows = packing.pack(df, **limits).collect()
        assert sorted((r["doc_id"], r["length"]) for r in rows) == sorted((i // 2, n) for i, n in enumerate(lengths))
        used = checked(rows, 64, limits.get("documents"), limits.get("attention"))
        if limits == {"tokens": 64}:
            assert used <= -(-sum(lengths) // 64) + 1


def test_documents(spark, coder):
    texts = [None, "", "one two", "one two", "word " * 300, "<|endoftext|> x", "y" * 1000, *["many copies of this"] * 50]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "no id", "clash"), (2, "one two", "clash")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = packing.pack_documents(df, JSON, RANKS, tokens=64).collect()
    checked(got, 64)
    assert [f for f in got[0].asDict()] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    want = []
    for key, text, _ in rows:
        ids = library_ids(coder, text) + bytes(4)
        n = len(ids) // 4
        first = n % 64 or 64
        starts = [0, *range(first, n, 64)]
        want += [(key, k, a, min(b, n) - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(starts, [*starts[1:], n]))]
    order = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    assert packing.pack_documents(df.limit(0), JSON, RANKS).collect() == []
