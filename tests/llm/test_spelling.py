import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import types as T

from assayer.llm import spelling

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("word", T.StringType())])


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(rows):
    n = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute_variants(n):
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) if near[w] else None for w in n}
    form = {w: best[w] if best[w] and n[best[w]] >= 2 * n[w] else None for w in n}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def words_of(rng, k, letters="abcé"):
    return ["".join(rng.choices(letters, k=rng.randint(5, 8))) for _ in range(k)]


@pytest.mark.parametrize("letters", ["ab", "abcé÷", "abcdefghijklmnopqrstuvwxyzàÿ"])
def test_trie_against_all_pairs(letters):
    rng = random.Random(len(letters))
    words = sorted({*words_of(rng, 600, letters), "aaaaa", "aaaaaa", "aaaaaaa", "a", "b", "ab", ""})
    lasting, tails, before = [], [], ""
    for w in words:
        k = spelling.shared(before, w)
        lasting.append(k)
        tails.append(w[k:])
        before = w
    import numpy as np

    trie = spelling.TrieShard([(np.asarray(lasting, "<u4").tobytes(), "\n".join(tails), np.ones(len(words), "<i8").tobytes())])
    assert trie.words == words
    for w in [*words, *words_of(rng, 100, letters)]:
        got = trie.near(w)
        assert len(got) == len(set(got))
        assert {words[k] for k in got} == {v for v in words if v != w and one_apart(w, v)}


def corpus(rng):
    some = words_of(rng, 60)
    rows = [(i, " ".join(rng.choice(some).upper() if rng.random() < 0.1 else rng.choice(some) for _ in range(40)) + " Ünïcode, x1word's ÀÉabc", "clash") for i in range(150)]
    return rows + [(None, "nobody nobody nobody", "clash"), (7, None, "clash"), (8, "", "clash"), *[(9, "hotword hotwords hotwort", "clash")] * 200, (400, "kabel " * 3 + "kabels " * 8 + "skabels " * 20, "clash")]


def test_against_brute_force(spark):
    rows = corpus(random.Random(5))
    counts = spelling.count_words(spark.createDataFrame(rows, SCHEMA), altered=spelling.alter)
    n = brute_counts(rows)
    assert {r["word"]: r["n"] for r in counts.collect()} == n
    want = brute_variants(n)
    assert any(f and n[f] for _, f, *_ in want) and any(r not in (w, f) for w, f, r, *_ in want)
    for limits in ({}, {"letters": 60, "most": 9, "at_once": 2, "task_words": 10}):
        got = spelling.spelling_variants(counts, **limits).select("word", "form", "root", "n", "n_near", "form_n").collect()
        assert len(got) == len(n) and set(map(tuple, got)) == want


def test_long_words_and_empty(spark):
    long = "ab" * 30_000
    rows = [(i, t, "") for i in range(3) for t in (long, long + "x", "z" * 40_000, "z" * 40_001)] + [(i, long, "") for i in range(10, 20)]
    counts = spelling.count_words(spark.createDataFrame(rows, SCHEMA))
    got = {r["word"]: r for r in spelling.spelling_variants(counts, letters=1000).collect()}
    assert got[long + "x"]["form"] == long and got[long]["form"] is None and got["z" * 40_000]["n_near"] == 1 and len(got) == 4
    assert spelling.spelling_variants(spelling.count_words(spark.createDataFrame([], SCHEMA))).collect() == []


def test_chains_end_at_their_last_word(spark):
    chain = spark.createDataFrame([(f"w{i:03d}", f"w{i + 1:03d}") for i in range(50)], "word string, form string")
    assert {tuple(r) for r in spelling.last_forms(chain).collect()} == {(f"w{i:03d}", "w050") for i in range(50)}
