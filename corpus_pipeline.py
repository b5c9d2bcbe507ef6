"""A corpus pipeline: each stage takes the documents that the stage before kept.

Language ID drops texts without a letter (`und`) and those of no learnt language: more than three tenths of their pairs
of letters stand nowhere in the sample, as in another script, a far language or mere letters; toxicity drops texts scored 0.5 or more; SimHash keeps one document of each near-duplicate group;
decontamination drops documents in which a benchmark window occurs; BPE encodes what is left.

All stages but the last return the columns of documents as they came, whatever else these hold; documents have
doc_id, text and lang. Null and
empty texts go with the first stage; repeated rows go with the third; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import bpe, decontam, langid, simhash, toxicity
from assayer.llm.common import table, written

#: A text with a greater share of pairs of letters never met in training is taken for none of the learnt languages.
MOST_UNSEEN = 0.3


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list]:
    """docs with columns renamed so that no operator's output clashes, the new names, and the way back."""
    safe = [f"d{i}" for i in range(len(docs.columns))]
    name = dict(zip(reversed(docs.columns), reversed(safe)))
    return docs.toDF(*safe), name, [F.col(s).alias(c) for s, c in zip(safe, docs.columns)]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, name, back = _apart(docs)
    found = langid.identify_languages(own, own.columns, name["doc_id"], name["text"], name["lang"])
    return found.where((F.col("lang_pred") != langid.UND) & (F.col("unseen") <= MOST_UNSEEN)).select(*back)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, name, back = _apart(docs)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias(name["doc_id"]), "toxic")
    scored = toxicity.score_toxicity(own, labels, own.columns, name["doc_id"], name["text"])
    return scored.where("predicted = 0").select(*back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, name, back = _apart(docs)
    found = decontam.contamination(own, table(spark, sf_dir, "benchmark"), own.columns, name["text"])
    return found.where(F.size("spans") == 0).select(*back)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    both = bpe.bpe_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))
    return both.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe_encoding),
]

#: Trained models and the tokenizer can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
