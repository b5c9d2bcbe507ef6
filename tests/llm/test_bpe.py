import hashlib
import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from assayer.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n\t ", "Hello, World!", "don't we'll I'VE", "naïve café ÅÉ é", "Σίσυφος ΟΔΟΣ", "日本語のテキスト 😀👍🏽", "a" * 5000, "x1y22z333",
    "<|endoftext|> and <|startoftext|>ab", "\x00\x01\x1c\x1d  　​", "https://a.b/c?d=e&f=%20", "ﬁ ½ ² Ⅷ ǅ İstanbul ẞ", "word " * 3000,
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def test_encodes_and_decodes_as_the_library(library):
    own = bpe.coder(PATH)
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABC àéßñ0123456789'.,-_ \n中文🙂"
    mixed = ["".join(r.choice(letters) for _ in range(r.randrange(1, 200))) for _ in range(400)]
    for text in [t or "" for t in TEXTS] + mixed:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == packed(ids), text
        assert own.decode(packed(ids)) == library.decode(ids, skip_special_tokens=False), text


def test_every_code_point_as_the_library(library):
    own = bpe.coder(PATH)
    edges = [int(c, 16) + d for listed in (bpe.LEFT_IN_PLACE, bpe.NO_LETTERS, bpe.NO_DIGITS) for part in listed.split() for c in part.split("-") for d in (-1, 0, 1)]
    points = sorted({*range(0xD800), *range(0xE000, 0x20000), *range(0x20000, 0x110000, 97), *edges})
    for at in range(0, len(points), 500):
        # beside letters, a digit, and marks of a low and a high class on either side
        text = " ".join(f"a{c}b{c}1 x{c}\u0334\u0301 X\u0345{c}\u0323" for c in map(chr, points[at : at + 500]))
        assert own.encode(text) == packed(library.encode(text, add_special_tokens=False).ids), hex(points[at])


def test_assigned_code_points_in_any_order(library):
    own = bpe.coder(PATH)
    r = random.Random(9)
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    marks = [c for c in points if unicodedata.combining(c)]
    for _ in range(20_000):
        text = "".join(r.choice(marks if r.random() < 0.5 else points) for _ in range(r.randrange(2, 9)))
        assert own.encode(text) == packed(library.encode(text, add_special_tokens=False).ids), [hex(ord(c)) for c in text]
    text = "\U00011935\U00011930 \U00011938 " + "".join(c + "\u0301" for c in points[::7])
    assert own.encode(text) == packed(library.encode(text, add_special_tokens=False).ids)


def test_very_long_text(library):
    text = "ten million bytes of text, café und Straße 1234 " * 200_000
    ids = library.encode(text, add_special_tokens=False).ids
    assert bpe.coder(PATH).encode(text) == packed(ids)


def test_cuts_are_certain():
    own = bpe.coder(PATH)
    of = {s: b for b, s in enumerate(own.symbols)}
    for token in own.vocab:
        raw = [of[c] for c in (token.removesuffix(own.end) if own.ends(token) else token)]
        assert all(own.joined[a][b] for a, b in zip(raw, raw[1:]))


def test_query_on_rows(spark, library):
    rows = [(i, t, "kept") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.bpe_digests(docs, PATH).collect()
    assert len(got) == len(rows)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t, _ in rows}
    for r in got:
        want = ids[r.doc_id]
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(packed(want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.bpe_digests(docs.limit(0), PATH).count() == 0


def test_ids_array(spark, library):
    docs = spark.createDataFrame([(1, "Hello, World!"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in bpe.bpe_encode(docs, PATH).select("doc_id", bpe.ids_array().alias("ids")).collect()}
    assert got == {1: library.encode("Hello, World!", add_special_tokens=False).ids, 2: []}
