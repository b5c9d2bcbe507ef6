import hashlib
import tarfile
import zlib
from pathlib import Path

import pytest

from assayer.llm import media

ROWS = [(1, None), (2, ""), (3, "a" * 64), (4, "a" * 65), (5, "é😀\n" * 1000), (5, "é😀\n" * 1000), (None, "x"), (7, "long " * 100_000)]


@pytest.mark.parametrize("text", [t for _, t in ROWS])
def test_round_trip(text):
    payload = media.payload_of(text)
    png = media.to_png(payload)
    assert media.from_png(png) == payload and len(payload) % 64 == 0 and len(payload) > 0
    assert payload.rstrip(b"\0") == (text or "").encode() and media.png_header(png[:33]) == (64, len(payload) // 64, 8)


def test_rows_and_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, offset string")
    got = media.media_table(docs).collect()
    assert len(got) == len(ROWS)
    want = {i: media.payload_of(t) for i, t in ROWS}
    for r in got:
        payload = want[r.doc_id]
        png = media.to_png(payload)
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256, r.height, r.bits) == (len(png), hashlib.sha256(png).hexdigest(), len(payload) // 64, 8)
        assert r.n_bytes == len((dict(ROWS)[r.doc_id] or "").encode())
    folder = f"file://{tmp_path}/shards"
    index = {r.digest: r for r in media.store_media(docs, folder).collect()}
    members = {}
    for path in Path(f"{tmp_path}/shards").glob("*.tar"):
        with tarfile.open(path) as tar:
            for m in tar:
                members[m.name] = tar.extractfile(m).read()
                own = index[m.name.removesuffix(".png")]
                if own.shard == path.name:
                    assert path.read_bytes()[own.offset : own.offset + own.length] == members[m.name]
    assert {n.removesuffix(".png") for n in members} == set(index) == {hashlib.sha256(p).hexdigest() for p in want.values()}
    assert media.media_table(docs.limit(0)).count() == 0


def test_equal_payloads_are_stored_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(media, "HOT_ROWS", 100)
    texts = ["the hot one"] * 300 + [f"text {i}" for i in range(100)] + [f"text {i}" for i in range(0, 100, 3)]
    schema = "doc_id long, text string, digest int, width string, extra string"
    docs = spark.createDataFrame([(i, t, 1, "w", "e") for i, t in enumerate(texts)], schema).repartition(8)
    folder = f"file://{tmp_path}/once"
    got = media.store_media(docs, folder, ("doc_id", "digest", "width", "extra")).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts))) and {r.extra for r in got} == {"e"} and "width" not in got[0]
    places = {(r.digest, r.shard, r.offset, r.length) for r in got}
    assert len(places) == len(set(texts))
    members = []
    for path in Path(f"{tmp_path}/once").glob("*.tar"):
        with tarfile.open(path) as tar:
            members += tar.getnames()
    assert sorted(members) == sorted(hashlib.sha256(media.payload_of(t)).hexdigest() + ".png" for t in set(texts))
    rows = media.media_table(docs, ("doc_id", "feature")).collect()
    by = {}
    for r in rows:
        by.setdefault(texts[r.doc_id], set()).add(tuple(v for k, v in r.asDict().items() if k != "doc_id"))
    assert len(rows) == len(texts) and all(len(v) == 1 for v in by.values())


def test_the_column_is_the_payload(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(t,) for _, t in ROWS if t is not None], "text string")
    for r in docs.select("text", media.payload_column(F.col("text").cast("binary")).alias("p")).collect():
        assert bytes(r.p) == media.payload_of(r.text)
