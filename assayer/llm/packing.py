"""Vector best-fit packing of tokenised documents into sequences of a fixed number of tokens.

A sequence is a bin with three capacities: tokens, documents and attention cost (the sum of the squares of its pieces'
lengths). A piece goes to an open bin that holds it under every capacity: by `norm` to the one whose residual vector,
scaled by the capacities, has the least weighted norm afterwards, by `dot` to the one whose residual has the greatest
weighted dot product with the piece's demand. Where none holds it, a bin is opened. Pieces come longest first.

Pieces of one length are alike, and so are bins of one residual, so that best fit runs over counts: at most as many
lengths as a sequence has tokens, and classes of bins with equal residuals. A chosen class takes as many pieces as its
bins hold; filling a class up removes it, and each length leaves three new ones at most. The counts by length are all
that the driver gets, and the plan's steps all that tasks get: both are bounded by the capacity, whatever the corpus
holds. Rows are numbered within their length by chunks of bounded size, and each looks its step up.

A document is its ids and one id `END` behind them. Only a document longer than a sequence is cut: into full pieces,
of which the first may be shorter. Null texts are empty (the end alone); repeated rows are packed each; equal pieces are
told apart by a number given in the written table, so ties are settled there; an empty table gives no rows; other
columns are not used.
"""

from __future__ import annotations

import base64
import math
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import col, map_text, resident, table, written

TOKENS = 2048
END = 0
#: Chunks in which the rows of one length are numbered: so many at least, and more when there are more rows than this for each.
CHUNKS, CHUNK_ROWS = 256, 200_000
#: Weights of tokens, documents and attention cost in a bin's score.
WEIGHTS = (1.0, 1 / 64, 1 / 64)
RULES = ("norm", "dot")

# Unicode's white space, and the pattern of words that the vocabulary was made with.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Stretches that no word goes beyond: words with the space before them, and other white space.
STRETCH = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Both libraries tell letters, digits and white space alike up to here; merging by ranks is slow on long stretches.
PLAIN_BELOW, PLAIN_LENGTH = "ɐ", 200
STRETCHES_KEPT = 150_000


class ByteTokens(dict):
    """The ids of a byte-level vocabulary, of which both files hold the same: the tokenizers library's and, for the
    stretches that are sure to come out alike, the faster tiktoken's. A dict of the stretches that came lately."""

    def __init__(self, path: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are Spark's
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=of, special_tokens={}).encode_ordinary
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, stretch: str) -> bytes:
        if (got := self.old.get(stretch)) is None:
            short = len(stretch) <= PLAIN_LENGTH
            plain = short and (stretch.isascii() or max(stretch) < PLAIN_BELOW)
            got = np.asarray(self.plain(stretch), dtype="<u4").tobytes() if plain else self.whole(stretch)
            if not short:
                return got
        if len(self) >= STRETCHES_KEPT:
            self.old = dict(self)
            self.clear()
        self[stretch] = got
        return got

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(t in text for t in self.added):  # an added token parts the white space around it
            return self.whole(text)
        return b"".join(map(self.__getitem__, STRETCH.findall(text)))


def cut(n: int, tokens: int) -> list[tuple[int, int]]:
    """The (start, length) of the pieces of n ids: full ones but for the first."""
    first = n - (n - 1) // tokens * tokens
    return [(0, first), *((at, tokens) for at in range(first, n, tokens))]


_PIECE = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def token_pieces(
    docs: DataFrame, path: str, ranks: str, tokens: int = TOKENS, end: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id_col, piece int, start, length, ids_crc32 of every piece of every whole text."""

    def make() -> Callable[[list], dict]:
        coder = resident(("byte tokens", path, ranks), lambda: ByteTokens(path, ranks))
        last = np.asarray([end], dtype="<u4").tobytes()

        def pieces(text: str | None) -> list[tuple[int, int, int]]:
            ids = coder.encode(text) + last
            return [(at, n, zlib.crc32(ids[4 * at : 4 * (at + n)])) for at, n in cut(len(ids) // 4, tokens)]

        return lambda texts: {"__pieces": [pieces(t) for t in texts]}

    own = docs.select(col(id_col).alias("__id"), col(text_col).alias("__of"))
    got = map_text(own, make, [T.StructField("__pieces", T.ArrayType(_PIECE))], ["__id"], "__of")
    return got.select("__id", F.posexplode("__pieces").alias("piece", "x")).select(F.col("__id").alias(id_col), "piece", "x.*")


class Bins:
    """Classes of open bins, each with a residual vector, a range of bin numbers and the tokens that its bins hold."""

    def __init__(self, tokens: int, documents: int, attention: int, weights: tuple[float, ...], rule: str):
        if rule not in RULES:
            raise ValueError(f"rule is none of {RULES}")
        self.full = np.array([tokens, documents, attention], dtype=np.int64)
        self.weights = np.asarray(weights) / self.full.astype(float) ** 2
        self.rule = rule
        self.left = np.empty((0, 3), dtype=np.int64)
        self.first = np.empty(0, dtype=np.int64)
        self.count = np.empty(0, dtype=np.int64)
        self.opened = 0
        self.steps: list[tuple[int, int, int, int, int]] = []

    def _best(self, demand: np.ndarray) -> int:
        """The class to take a piece, -1 if none can."""
        fits = np.flatnonzero((self.left >= demand).all(axis=1))
        if not len(fits):
            return -1
        left = self.left[fits]
        score = ((left - demand) ** 2) @ self.weights if self.rule == "norm" else -(left * demand) @ self.weights
        return int(fits[np.argmin(score)])

    def _open(self, left: np.ndarray, first: int, count: int) -> None:
        if count and left.min() > 0:  # a bin without any residual takes nothing more
            self.left = np.vstack([self.left, left])
            self.first, self.count = np.append(self.first, first), np.append(self.count, count)

    def _close(self, at: int) -> None:
        self.left, self.first, self.count = np.delete(self.left, at, axis=0), np.delete(self.first, at), np.delete(self.count, at)

    def place(self, length: int, n: int) -> None:
        """n pieces of one length; steps gets (length, first rank, first bin, pieces a bin, offset) of each class taken."""
        demand = np.array([length, 1, length * length], dtype=np.int64)
        rank = 0
        while rank < n:
            at = self._best(demand)
            if at < 0:
                left, each = self.full, int((self.full // demand).min())
                if not each:
                    raise ValueError(f"no sequence holds a piece of {length} tokens")
                first, count = self.opened, math.ceil((n - rank) / each)
                self.opened += count
            else:
                left, first, count = self.left[at].copy(), int(self.first[at]), int(self.count[at])
                each = int((left // demand).min())
                self._close(at)
            taken = min(n - rank, each * count)
            whole, rest = divmod(taken, each)
            self.steps.append((length, rank, first, each, int(self.full[0] - left[0])))
            self._open(left - each * demand, first, whole)
            self._open(left - rest * demand, first + whole, int(rest > 0))
            self._open(left, first + whole + (rest > 0), count - whole - (rest > 0))
            rank += taken


def plan_packing(
    counts: dict[int, int], tokens: int = TOKENS, documents: int | None = None, attention: int | None = None,
    weights: tuple[float, ...] = WEIGHTS, rules: tuple[str, ...] = RULES,
) -> Bins:
    """The plan of the rule that opens the fewest bins for so many pieces of each length. Without a limit of documents
    or attention cost, as many as a sequence of that many tokens can hold."""
    plans = []
    for rule in rules:
        bins = Bins(tokens, documents or tokens, attention or tokens * tokens, weights, rule)
        for length in sorted(counts, reverse=True):
            bins.place(length, counts[length])
        plans.append(bins)
    return min(plans, key=lambda b: b.opened)


def _ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """pieces with rank: gapless from 0 within each length, in chunks of bounded size. `__row` is unique and stored."""
    chunked = pieces.withColumn("__chunk", F.pmod(F.xxhash64("__row"), F.lit(max(CHUNKS, rows // CHUNK_ROWS))))
    held = chunked.groupBy("length", "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(F.col("length").alias("__l"), F.col("__chunk").alias("__c"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = chunked.withColumn("__rn", F.row_number().over(Window.partitionBy("length", "__chunk").orderBy("__row")))
    found = numbered.join(offsets, (F.col("length") == F.col("__l")) & (F.col("__chunk") == F.col("__c")))
    return found.withColumn("rank", (F.col("__before") + F.col("__rn") - 1).cast("long")).drop("__row", "__chunk", "__rn", "__l", "__c", "__before")


def pack(
    pieces: DataFrame, tokens: int = TOKENS, documents: int | None = None, attention: int | None = None,
    weights: tuple[float, ...] = WEIGHTS, rules: tuple[str, ...] = RULES,
) -> DataFrame:
    """pieces (with a column length of 1 to tokens; other columns are kept) and the sequence_id and offset of each."""
    stored = written(pieces.withColumn("__row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # `tokens` rows at most
    steps = np.array(plan_packing(counts, tokens, documents, attention, weights, rules).steps, dtype=np.int64).reshape(-1, 5)
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    ranked = _ranked(stored, sum(counts.values()))
    own = [c for c in ranked.columns if c not in ("rank", "sequence_id", "offset")]
    ranked = ranked.select("rank", *[col(c) for c in own])
    at_length = 1 + own.index("length")
    schema = T.StructType([*ranked.schema.fields[1:], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    key = steps[:, 0] << 40 | steps[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank, length = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, at_length))
            of = steps[np.searchsorted(key, length << 40 | rank, side="right") - 1]
            bin_, nth = np.divmod(rank - of[:, 1], np.maximum(of[:, 3], 1))
            arrays = [*(b.column(i) for i in range(1, b.num_columns)), pa.array(of[:, 2] + bin_), pa.array(of[:, 4] + nth * length)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, ranks: str, tokens: int = TOKENS, end: int = END, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """id_col, piece, start, length, ids_crc32, sequence_id and offset of every piece of docs; limits as in pack()."""
    return pack(token_pieces(docs, path, ranks, tokens, end, id_col, text_col), tokens, **limits)


def op11_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ranks)
