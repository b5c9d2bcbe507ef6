import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from assayer.llm import periodic

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("runs", T.StringType())])


def brute_runs(words, least=24, times=3):
    """Every maximal stretch of each period, kept with its smallest one."""
    n, found = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                found.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def texts(rng):
    yield []
    yield ["a"] * 24
    yield ["a"] * 23
    yield ["a"] * 500
    for _ in range(150):
        alphabet = "ab" if rng.random() < 0.5 else "abcdefgh"
        words = []
        while len(words) < rng.randint(1, 400):
            period = rng.choices(alphabet, k=rng.choice([1, 2, 3, 5, 8, 13, 40]))
            times = rng.choice([1, 1, 2, 3, 5, 9])
            words += (period * times + period[: rng.randint(0, len(period))])[: rng.randint(1, 300)]
        yield words


@pytest.mark.parametrize(("least", "times"), [(24, 3), (4, 3), (30, 5)])
def test_runs_against_brute_force(least, times, monkeypatch):
    rng = random.Random(least)
    some = 0
    for k, words in enumerate(texts(rng)):
        monkeypatch.setattr(periodic, "SLICE", [1 << 20, 50][k % 2])
        got = [tuple(r) for r in periodic.periodic_runs(periodic.numbered(words), least, times).tolist()]
        assert got == brute_runs(words, least, times), words
        some += len(got)
    assert some > 50


def test_suffix_array_and_extensions():
    rng = np.random.default_rng(1)
    for n, k in ((1, 1), (2, 1), (17, 1), (300, 2), (700, 3), (513, 400)):
        ids = rng.integers(0, k, n)
        assert periodic.suffix_array(ids).tolist() == sorted(range(n), key=lambda i: ids[i:].tolist())
        e = periodic.Extensions(ids)
        a, b = rng.integers(0, n + 1, 400), rng.integers(0, n + 1, 400)
        a, b = a[a != b], b[a != b]
        want = [next((t for t in range(n) if max(i, j) + t >= n or ids[i + t] != ids[j + t]), 0) for i, j in zip(a.tolist(), b.tolist())]
        assert e.of(a, b).tolist() == want


def brute_row(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(key).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (key, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(kept))


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(w), "clash") for i, w in enumerate(texts(rng))]
    rows += [(1000, None, ""), (1001, "", ""), (1002, " \t\r\n\x0b\x0c", ""), (1003, "a b c " * 30, ""), (1004, "x " * 30 + "y z", ""), (1004, "x " * 30 + "y z", "")]
    rows += [(2000 + i, " ".join(rng.choices(["the", "of", "and", "cat", "sat"], k=200)), "") for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = periodic.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = sorted((brute_row(k, t) for k, t, _ in rows), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sum(r[1] > 0 for r in want) > 40


def test_operator_keeps_ids_and_gives_texts(spark):
    df = spark.createDataFrame([(None, "go on " * 15, "c"), (None, None, "c")], SCHEMA)
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.find_periodic_runs(df).collect()), key=lambda r: r[1])
    assert got == [(None, 0, [], ""), (None, 30, [(0, 30, 2)], "go on")]
    assert periodic.find_periodic_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(np.zeros(9, dtype=int), 4, 2)


def test_a_very_long_text():
    n = 400_000
    ids = np.concatenate([np.arange(n), np.zeros(n // 2, dtype=int), np.arange(n)])
    assert [tuple(r) for r in periodic.periodic_runs(ids).tolist()] == [(n, n // 2 + 1, 1)]
