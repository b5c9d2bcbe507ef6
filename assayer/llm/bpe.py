"""BPE encoding and decoding by forced-boundary splitting.

A pair of adjacent bytes that stands inside no token of the vocabulary can never be joined by a merge, so
every place where such a pair occurs is a certain cut. A word is cut there, its fragments are encoded
independently and their ids are concatenated; the result is that of encoding the word whole.

The library's parts have Unicode tables of different ages: its normal form is of Unicode 9, its letters and digits are
older than the regex module's and its capitals newer than Python's. What differs is listed below, and a test compares
the code points one by one.

Words, normal form and tokens are those of a `tokenizers` JSON file of the kind "BPE with word ends" (NFC,
lower case, white space dropped, byte-level symbols, a suffix on the last symbol of a word). Added special
tokens are recognised in a text, as the library does without encode_special_tokens.

Null texts count as empty; an empty text has no ids and decodes to an empty text. Repeated rows are encoded
each; an empty table gives no rows. Other columns are carried along if they are named in keep.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from functools import cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_text, resident, table

#: Words and short runs of text without white space kept with their ids before the older half is forgotten.
RUNS_KEPT = 150_000
#: Pairs of neighbouring tokens whose standing is kept.
PAIRS_KEPT = 250_000
END = "\ue000"
NONE = 1 << 60

# Code points by which the library's Unicode tables differ, in hexadecimal.
#: Marks that are newer than its normal form, which leaves them in place, and a vowel sign with a newer composition.
LEFT_IN_PLACE = """07FD 0898-089F 08CA-08D3 09FE 0C3C 0D3B-0D3C 0EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC
    10EFD-10EFF 10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99
    11D42 11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"""
#: Letters that its pattern takes for signs.
NO_LETTERS = """0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
    10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA
    18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96
    1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD
    323B0-33479 3D000-3FC3F"""
#: Digits that its pattern takes for signs.
NO_DIGITS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"
#: Capitals that it lowers and Python may not.
CAPITALS = (
    {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7DC: 0x19B}
    | {c: c + 1 for c in (0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA)}
    | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
    | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
)


def char_class(listed: str) -> str:
    """The inside of a pattern's class of the code points and ranges of a list."""
    return "".join("-".join(chr(int(c, 16)) for c in part.split("-")) for part in listed.split())


_IN_PLACE = re.compile(f"([{char_class(LEFT_IN_PLACE)}]+)")
_ODD = re.compile(f"[{char_class(LEFT_IN_PLACE)}{''.join(map(chr, CAPITALS))}]")


@cache
def byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies: itself, or the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class ForcedBoundaryBPE:
    """Encoder and decoder of one vocabulary file; built once a Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        v = self.vocab
        # the merge of ids a and b, under a << 20 | b: its rank << 20 | the merged id, so that the least comes first
        self.merges = {v[a] << 20 | v[b]: rank << 20 | v[a + b] for rank, (a, b) in enumerate(pairs)}
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {i: t for t, i in (self.vocab | added).items()}
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.added = added
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"], regex.V0)
        own = split["pattern"]["Regex"].replace("\\p{L}", f"[\\p{{L}}--[{char_class(NO_LETTERS)}]]").replace("\\p{N}", f"[\\p{{N}}--[{char_class(NO_DIGITS)}]]")
        self.words_beyond_ascii = regex.compile(own, regex.V1)
        self.symbols = byte_symbols()
        of = {s: b for b, s in enumerate(self.symbols)}
        inside = np.zeros((256, 256), dtype=bool)
        for t in self.vocab:
            b = [of[c] for c in (t.removesuffix(self.end) if self.ends(t) else t)]
            inside[b[:-1], b[1:]] = True
        self.joined = inside.tolist()  # joined[a][b]: some token holds byte a before byte b
        self.symbol_of = dict(enumerate(self.symbols))
        #: Tokens with END for the suffix of a word's last symbol, so that it can't be taken for text.
        self.pieces = {(t.removesuffix(self.end) + END if self.ends(t) else t): i for t, i in v.items()}
        self.piece = {i: t for t, i in self.pieces.items()}
        #: The longest token that begins with these four symbols; other tokens have three at most.
        self.reach: dict[str, int] = {}
        for t in self.pieces:
            if len(t) > 3:
                self.reach[t[:4]] = max(self.reach.get(t[:4], 0), len(t))
        self.pairs: dict[int, bool] = {}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ends(self, token: str) -> bool:
        return bool(self.end) and token.endswith(self.end) and token != self.end

    def _merge(self, ids: list[int]) -> list[int]:
        """Merges by rank, the leftmost of equal pairs first: the definition of BPE."""
        get = self.merges.get
        found = [get(a << 20 | b, NONE) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != NONE:
            i = found.index(best)
            ids[i] = new = best & 0xFFFFF
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = get(ids[i - 1] << 20 | new, NONE)
            if i < len(found):
                found[i] = get(new << 20 | ids[i + 1], NONE)
        return ids

    def _stands(self, a: int, b: int) -> bool:
        """Whether tokens a and b stay as they are when merges run over the symbols of both."""
        both = [self.pieces[s] for x in (self.piece[a], self.piece[b]) for s in self._singles(x)]
        got = self._merge(both) == [a, b]
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        self.pairs[a << 20 | b] = got
        return got

    @staticmethod
    def _singles(piece: str) -> list[str]:
        return [*piece[:-2], piece[-2:]] if piece[-1] == END else list(piece)

    def fragment(self, s: str) -> list[int]:
        """Ids of a fragment of symbols.

        A split into tokens is the BPE encoding exactly if every two neighbours in it stay apart under the
        merges, and there is one such split. So the longest token that stands beside the one before it is
        taken at each place; where none fits, the place is a dead end and the token before it is shortened.
        """
        pieces, pairs, reach, n = self.pieces.get, self.pairs.get, self.reach.get, len(s)
        out: list[int] = []
        lengths: list[int] = []
        dead: set[int] = set()
        pos, size = 0, min(reach(s[:4], 3), n)
        while pos < n:
            while size:
                t = pieces(s[pos : pos + size])
                if t is not None and pos + size not in dead:
                    if not out:
                        break
                    ok = pairs(out[-1] << 20 | t)
                    if self._stands(out[-1], t) if ok is None else ok:
                        break
                size -= 1
            if size:
                out.append(t)
                lengths.append(size)
                pos += size
                size = min(reach(s[pos : pos + 4], 3), n - pos)
            else:
                dead.add(pos)
                out.pop()
                size = lengths.pop()
                pos -= size
                size -= 1
        return out

    def word(self, word: str) -> list[int]:
        """A word's ids: cut at the certain boundaries, encoded by fragment, concatenated."""
        raw, joined = word.encode(), self.joined
        # printable ASCII is its own symbol
        s = (word if word.isascii() and word.isprintable() else raw.decode("latin-1").translate(self.symbol_of)) + END
        cuts = [i for i, (a, b) in enumerate(zip(raw, raw[1:]), 1) if not joined[a][b]]
        if not cuts:
            return self.fragment(s)
        return [x for i, j in zip([0, *cuts], [*cuts, len(s)]) for x in self.fragment(s[i:j])]

    def _keep(self, s: str, ids: bytes) -> bytes:
        if len(s) <= 64:
            if len(self.new) >= RUNS_KEPT:
                self.old, self.new = self.new, {}
            self.new[s] = ids
        return ids

    def _packed(self, word: str) -> bytes:
        """A word's ids as little-endian unsigned 32-bit integers; words that came lately are known."""
        if (got := self.new.get(word)) is None:
            if (got := self.old.get(word)) is None:
                ids = self.word(word)
                got = array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(ids, "<u4").tobytes()
            self._keep(word, got)
        return got

    def run(self, chunk: str) -> bytes:
        """The packed ids of a normalised stretch of text that isn't among the newest known."""
        if (got := self.old.get(chunk)) is not None:
            return self._keep(chunk, got)
        words = (self.words if chunk.isascii() else self.words_beyond_ascii).findall(chunk)
        if words == [chunk]:
            return self._packed(chunk)
        return self._keep(chunk, b"".join([self._packed(w) for w in words]))

    def normalised(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # the library lowers character by character, so the final sigma has no form of its own
        if not _ODD.search(text):
            return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # what is left in place has neither an order among marks nor a composition: the stretches between are normal for themselves
        normal = "".join(x if k % 2 else unicodedata.normalize("NFC", x) for k, x in enumerate(_IN_PLACE.split(text)))
        return normal.replace("Σ", "σ").lower().translate(CAPITALS)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        out: list[bytes] = []
        parts = self.special.split(text) if self.special else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.asarray([self.added[part]], dtype="<u4").tobytes())
            elif part:
                whole = self.normalised(part)
                # no word goes over white space; four separators are white space to str.split alone
                odd = any(c in whole for c in "\x1c\x1d\x1e\x1f")
                known = self.new.get
                for chunk in [whole] if odd else whole.split():
                    if (got := known(chunk)) is None:
                        got = self.run(chunk)
                        known = self.new.get
                    out.append(got)
        return b"".join(out)

    def decode(self, ids: bytes | None) -> str:
        """Tokens joined by a space each, as the library does for a vocabulary without a decoder."""
        token = self.token
        return " ".join([token[i] for i in np.frombuffer(ids or b"", dtype="<u4").tolist()])


def coder(path: str) -> ForcedBoundaryBPE:
    return resident(("bpe", path), lambda: ForcedBoundaryBPE(path))


def bpe_encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """keep, n_tokens long, ids binary (little-endian unsigned 32-bit integers) for every whole text."""

    def make():
        bpe = coder(path)

        def f(texts: list) -> dict:
            ids = [bpe.encode(t) for t in texts]
            return {"n_tokens": [len(x) // 4 for x in ids], "ids": ids}

        return f

    return map_text(docs, make, [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())], keep, text_col)


def bpe_decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id", "n_tokens", "ids"), ids_col: str = "ids") -> DataFrame:
    """keep and decoded string: the text of ids; null ids give an empty text."""

    def make():
        bpe = coder(path)
        return lambda ids: {"decoded": [bpe.decode(x) for x in ids]}

    return map_text(encoded, make, [T.StructField("decoded", T.StringType())], keep, ids_col, binary=True, rows=500)


def bpe_round_trip(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """keep, n_tokens, ids and decoded of every whole text: bpe_decode() of bpe_encode() in one pass through Python,
    so that a task has one worker with the vocabulary, not two."""

    def make():
        bpe = coder(path)

        def f(texts: list) -> dict:
            ids = [bpe.encode(t) for t in texts]
            return {"n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": [bpe.decode(x) for x in ids]}

        return f

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    return map_text(docs, make, fields, keep, text_col)


def ids_array(ids_col: str = "ids"):
    """An array<bigint> of packed ids, in Spark operations."""
    h = F.hex(F.col(ids_col))
    byte = lambda i, k: F.substring(h, (i * 8 + 2 * k + 1).cast("int"), F.lit(2))
    one = lambda i: F.conv(F.concat(*[byte(i, k) for k in (3, 2, 1, 0)]), 16, 10).cast("long")
    n = (F.length(F.col(ids_col)) / 4).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<bigint>"))


def bpe_digests(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_tokens, ids_sha256 and decoded_sha256 of every whole text of docs."""
    both = bpe_round_trip(docs, path, keep)
    return both.select(*keep, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op1_bpe_forced_boundaries(spark, sf_dir):
    import public_tokenizers

    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
