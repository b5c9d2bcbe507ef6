"""The pipeline's stages against what their operators, or brute force, say of the stage's own input."""

import corpus_pipeline
import pytest

from assayer.llm import bpe, decontam, langid, simhash, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs.collect())]
    for name, f in corpus_pipeline.STAGES:
        rows = f(spark, docs, SF).collect()
        out.append((name, rows))
        if name != "bpe":
            docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_stages_keep_and_drop(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [len(rows) for _, rows in stages]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 0.5 * sizes[0]
    for name, rows in stages[1:-1]:
        assert all(tuple(r.asDict()) == tuple(docs.columns) for r in rows), name
    by = dict(stages)
    frame = lambda rows: spark.createDataFrame(rows, docs.schema)
    ids = lambda rows: sorted(r.doc_id for r in rows)
    near = simhash.near_duplicates(frame(by["toxicity"])).collect()
    assert ids(by["near_dedup"]) == sorted({r.component_id for r in near})
    found = decontam.contamination(frame(by["near_dedup"]), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert ids(by["decontamination"]) == sorted(r.doc_id for r in found if not r.spans)
    langs = langid.identify_languages(frame(by["documents"])).collect()
    assert ids(by["language_id"]) == sorted(r.doc_id for r in langs if r.lang_pred != "und" and r.unseen <= corpus_pipeline.MOST_UNSEEN)
    lettered = [r.doc_id for r in by["documents"] if any(c.isalpha() for c in r.text or "")]
    assert len(by["language_id"]) >= 0.99 * len(lettered)
    scored = toxicity.score_toxicity(frame(by["language_id"]), spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert ids(by["toxicity"]) == sorted(r.doc_id for r in scored if not r.predicted)
    import public_tokenizers

    own = bpe.coder(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in by["decontamination"]}
    assert all(bytes(r.ids) == own.encode(texts[r.doc_id]) for r in by["bpe"])


def test_empty_and_odd_documents(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame([], schema)
    for name, f in corpus_pipeline.STAGES:
        got = f(spark, docs, SF)
        assert got.count() == 0, name
    odd = spark.createDataFrame([(1, None, None, None, None, "x"), (None, "", "en", "s", 0, None), (2, "Plain words of a text.", "en", "s", 22, "y"), (2, "Plain words of a text.", "en", "s", 22, "y")], "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, f in corpus_pipeline.STAGES[:-1]:
        got = f(spark, odd, SF)
        assert got.columns == odd.columns, name
        got.collect()


def test_language_stage_rejects_what_was_not_learnt(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    strange = [
        "Съешь же ещё этих мягких французских булок, да выпей чаю.",
        "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία.",
        "Zażółć gęślą jaźń, wszyscy ludzie rodzą się wolni i równi pod względem swej godności.",
        "xqzj wvkk qzxv jjqk vxzq kwqx zzvq",
        "人人生而自由，在尊严和权利上一律平等",
        "12 34 !?",
    ]
    plain = ["Tous les êtres humains naissent libres et égaux en dignité et en droits.", "Alle Menschen sind frei und gleich an Würde und Rechten geboren.", "the"]
    rows = spark.createDataFrame([(10**9 + i, t, None, "x", len(t)) for i, t in enumerate(strange + plain)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(rows), SF).where("doc_id >= 1000000000").collect()}
    assert kept == {10**9 + len(strange) + i for i in range(len(plain))}
