import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from assayer.functions import digests, numbers, text


def test_folding_is_full_case_folding(spark):
    """Every code point, alone and in the midst of letters."""
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    rows = ["".join(every[i : i + 500]) for i in range(0, len(every), 500)] + [f"aΣ{c} {c}ß" for c in every if c != c.casefold()] + ["", None, "ΣΑΣ", "STRASSE ŉ ﬃ İ"]
    got = spark.createDataFrame([(t,) for t in rows], "t string").select("t", text.folded(F.col("t")).alias("f"))
    assert [(r["t"], r["f"]) for r in got.collect() if r["f"] != (None if r["t"] is None else r["t"].casefold())] == []


@pytest.mark.parametrize("places", [0, 2, 3, 6])
def test_rounding_is_half_even_on_the_binary_value(spark, places):
    rng = random.Random(places)
    some = [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 8) for _ in range(120_000)]
    some += [round(rng.uniform(0, 1000), places) + 0.5 * 10**-places for _ in range(80_000)]  # near the middle
    some += [rng.randint(-(10**7), 10**7) / 2 ** rng.randint(0, 12) for _ in range(50_000)]  # often in the middle
    some += [0.0, -0.0, 0.5, 1.5, 2.5, -0.5, 2.675, 1.005, 0.125, -0.125, 1e-300, 5e-324, float("inf")]
    found = spark.createDataFrame([(x,) for x in some], "x double").select("x", numbers.round_exact(F.col("x"), places).alias("r"))
    assert not any("Python" in line or "Pandas" in line for line in found._jdf.queryExecution().executedPlan().toString().splitlines())
    assert [(r["x"], r["r"]) for r in found.collect() if repr(r["r"]) != repr(round(r["x"], places) if r["x"] != float("inf") else r["x"])] == []
    odd = spark.createDataFrame([(None,), (float("nan"),)], "x double").select(numbers.round_exact(F.col("x"), places).alias("r")).collect()
    assert odd[0]["r"] is None and odd[1]["r"] != odd[1]["r"]


def by_json(*values):
    return hashlib.sha256(json.dumps(values, ensure_ascii=False, sort_keys=True).encode()).hexdigest()


TEXTS = ["", "plain", 'a "quoted" \\ text/with\ttabs\r\nlines', "".join(map(chr, range(0, 40))), "\x7f\x80\u2028 é 😀 ß \\u0041", "[文件]", None]


def test_canonical_form_is_json(spark):
    rows = [(i, t, [t, "x", None], {t or "null": "v", "Z": t, "a": "1", "é": "2", "😀": "3", "\uffff": "4"}) for i, t in enumerate(TEXTS)] + [(None, "t", None, None), (-5, "t", [], {})]
    df = spark.createDataFrame(rows, "n long, t string, l array<string>, m map<string,string>")
    form = digests.fingerprint(digests.json_whole(F.col("n")), digests.json_text(F.col("t")), digests.json_list(F.col("l")), digests.json_map(F.col("m")))
    assert [r["f"] for r in df.select(form.alias("f")).collect()] == [by_json(*row) for row in rows]


def test_signatures_and_keys_are_those_of_json(spark):
    item = [("i1", 'say "yes"', 3), ("i2", None, -2)]
    rows = [(k, f"id{k}", t, t, item[: k % 3], [t or ""], [], ["r"], None) for k, t in enumerate(TEXTS, 1)]
    names = ["ordinal", "task_id", "occupation", "prompt", "rubric", "gold_urls", "gold_names", "reference_names", "reference_urls"]
    lists = ", ".join(f"{c} array<string>" for c in names[5:])
    df = spark.createDataFrame(rows, f"ordinal long, task_id string, occupation string, prompt string, rubric array<struct<item_id:string,criterion:string,score:long>>, {lists}")
    provider = {"order": ["One"], "allow_fallbacks": False}
    signed = df.withColumn("s", digests.task_signature())
    key = digests.cache_key(F.col("s"), "m", "pairwise", provider, ("sys\n1", "é"), digests.json_text(F.col("prompt")), digests.json_whole(F.col("ordinal")))
    got = signed.select("ordinal", "s", key.alias("k"), digests.seeded_coin(F.col("s")).alias("c")).orderBy("ordinal").collect()
    for row, r in zip(rows, got):
        task = dict(zip(names, row)) | {"rubric": [dict(zip(("item_id", "criterion", "score"), x)) for x in row[4]]}
        assert r["s"] == by_json(task)
        assert r["k"] == by_json(r["s"], "m", "pairwise", provider, "sys\n1", "é", (row[3], row[0]))
        assert r["c"] == (random.Random(r["s"]).random() < 0.5)
    some = spark.range(2000).select(digests.seeded_coin(F.sha2(F.col("id").cast("string"), 256)).alias("c")).groupBy("c").count().collect()
    assert len(some) == 2 and all(900 < r["count"] < 1100 for r in some)


def test_folding_looks_at_batches(spark):
    """Letters that become several were replaced one after the other, each over the whole text."""
    df = spark.createDataFrame([("Straße ŉ İ",), (None,)], "t string").select(text.folded(F.col("t")).alias("f"))
    assert "ArrowEvalPython" in df._jdf.queryExecution().executedPlan().toString()
    assert [r["f"] for r in df.collect()] == ["Straße ŉ İ".casefold(), None]
