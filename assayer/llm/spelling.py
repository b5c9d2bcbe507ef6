r"""Spelling variants: words at edit distance one, found by automata over broadcast trie shards.

Words are counted over the whole corpus. The counted words, in code-point order, are cut into shards of bounded size,
stored front-coded (the length shared with the word before, and the rest). A pass broadcasts a few shards; its tasks
build each shard's trie in turn and walk it depth-first for every word of theirs with the automaton of all words at
distance one: along the word's own letters without an edit, and at each node aside by one deleted, inserted or replaced
letter, after which only the rest of the word is accepted. Each neighbour has one such path (a letter is deleted at the
end of a stretch of equal letters and inserted before a different letter), so it is emitted once; its contribution to
the word's count of neighbours and to its best form is reduced in the task and then, over passes, by word.

Every word meets every shard: passes times words is the price of the method. A word is aside of most shards at the
first letters. A trie has a node for each letter that two of its words share at most, so its size follows the shard's.

A word's form is its near word of largest n (ties: the first in code-point order), if that n is `factor` times its own
or more. Forms have a larger n each, so that chains end; their last words are found by pointer doubling.

Null texts have no words; a null id is the empty text before the ":"; repeated rows count each; an empty table gives no
rows; words may be as long as a text: one that is longer than a shard's bound is a shard of its own; other columns are
not used.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, discard, small_batches, table, written

LEAST_LETTERS, LEAST_TIMES, FACTOR = 5, 3, 2
#: Different words that a task holds before it hands their counts on.
HELD = 200_000
#: Letters of a shard's front-coded words, and words, at most; shards broadcast at once.
SHARD_LETTERS, SHARD_WORDS, AT_ONCE = 1 << 20, 1 << 17, 8
#: Words that one task walks the shards with, about.
TASK_WORDS = 20_000
ALTERED = 97


def alter(run: str, crc: int) -> str:
    """The run, or without one letter where ALTERED divides the crc32 of its id and letters."""
    if crc % ALTERED:
        return run
    k = crc % len(run)
    return run[:k] + run[k + 1 :]


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES,
    altered: Callable[[str, int], str] | None = None,
) -> DataFrame:
    """(word, n): the maximal runs of Latin letters of least_letters or more that stand least_times or more in docs.

    Only A-Z are lowered. altered(run, crc32 of "<id>:<run>") may give another word for a run; none that is longer."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_letters},}}")
    small_batches(docs)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        get, crc32 = held.get, zlib.crc32

        def counts() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                start = crc32(f"{key}:".encode())
                for word in runs.findall(text.encode().lower().decode()):  # bytes know A-Z alone
                    if altered is not None:
                        crc = crc32(word.encode(), start)
                        if crc % ALTERED == 0 and len(word := altered(word, crc)) < least_letters:
                            continue
                    held[word] = get(word, 0) + 1
                if len(held) >= HELD:
                    yield counts()
                    held.clear()
        if held:
            yield counts()

    own = docs.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("id"), col(text_col).cast("string").alias("text"))
    return own.mapInArrow(tally, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_times)


def shared(a: str, b: str) -> int:
    """How many letters two words begin with alike."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    return next(i for i in range(most) if a[i] != b[i])


def front_coded(words: DataFrame, parts: int, letters: int = SHARD_LETTERS, most: int = SHARD_WORDS) -> DataFrame:
    """(first, lasting, tails, ns, letters): pieces of the sorted words(word, n), none larger than a shard may be, but for a single word."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, before, lasting, tails, ns, size = "", "", [], [], [], 0

        def piece() -> pa.RecordBatch:
            values = [[first], [np.asarray(lasting, dtype="<u4").tobytes()], ["\n".join(tails)], [np.asarray(ns, dtype="<i8").tobytes()], [size]]
            kinds = [pa.string(), pa.binary(), pa.string(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["first", "lasting", "tails", "ns", "letters"])

        for b in batches:
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k = shared(before, word) if ns else 0
                if ns and (size + len(word) - k > letters or len(ns) >= most):
                    yield piece()
                    lasting, tails, ns, size, k = [], [], [], 0, 0
                if not ns:
                    first = word
                lasting.append(k)
                tails.append(word[k:])
                ns.append(n)
                size += len(word) - k
                before = word
        if ns:
            yield piece()

    ordered = words.select("word", "n").repartitionByRange(parts, "word").sortWithinPartitions("word")
    return ordered.mapInArrow(cut, "first string, lasting binary, tails string, ns binary, letters long")


class TrieShard:
    """The words of consecutive pieces in a trie: a node is a dict from letters to nodes, "" to the word that ends there,
    and a subtree of one word is that word's number."""

    def __init__(self, pieces: list[tuple[bytes, str, bytes]]):
        self.words: list[str] = []
        for lasting, tails, _ in pieces:
            word = ""
            for k, tail in zip(np.frombuffer(lasting, "<u4").tolist(), tails.split("\n")):
                word = word[:k] + tail
                self.words.append(word)
        self.n = np.concatenate([np.frombuffer(ns, "<i8") for _, _, ns in pieces]).tolist()
        self.root: dict = {}
        open_ = [(self.root, 0, len(self.words), 0)]
        words = self.words
        while open_:
            node, i, end, depth = open_.pop()
            if i < end and len(words[i]) == depth:
                node[""] = i
                i += 1
            while i < end:
                c, j = words[i][depth], i + 1
                while j < end and words[j][depth] == c:
                    j += 1
                if j == i + 1:
                    node[c] = i
                else:
                    node[c] = below = {}
                    open_.append((below, i, j, depth + 1))
                i = j

    def _rest(self, node: dict | int, depth: int, word: str, at: int) -> int:
        """The number of the word that goes on from node (at depth) as `word` does from `at`, -1 if there is none."""
        while type(node) is dict:
            if at == len(word):
                return node.get("", -1)
            node = node.get(word[at])
            if node is None:
                return -1
            at += 1
            depth += 1
        other = self.words[node]
        return node if len(other) - depth == len(word) - at and other[depth:] == word[at:] else -1

    def _apart_by_one(self, word: str, other: str) -> bool:
        a, b = (word, other) if len(word) <= len(other) else (other, word)
        if len(b) - len(a) > 1 or a == b:
            return False
        k = shared(a, b)
        return a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]

    def near(self, word: str) -> list[int]:
        """The numbers of all words at distance one."""
        found: list[int] = []
        rest, end, node = self._rest, len(word), self.root
        for i in range(end + 1):
            if type(node) is int:
                if self._apart_by_one(word, self.words[node]):
                    found.append(node)
                break
            own = word[i] if i < end else ""
            after = word[i + 1] if i + 1 < end else ""
            if own and after != own and (k := rest(node, i, word, i + 1)) >= 0:  # own deleted
                found.append(k)
            for c, below in node.items():
                if c == own or not c:
                    continue
                branch = type(below) is dict
                if (not branch or own in below) and (k := rest(below, i + 1, word, i)) >= 0:  # c inserted
                    found.append(k)
                if own and (not branch or after in below) and (k := rest(below, i + 1, word, i + 1)) >= 0:  # own replaced by c
                    found.append(k)
            node = node.get(own) if own else None
            if node is None:
                break
        return found


def _neighbours(words: DataFrame, shards: list[list[tuple[bytes, str, bytes]]]) -> DataFrame:
    """(word, n_near, form_n, form) of every word that has neighbours in these shards: how many, and the best."""
    sent = words.sparkSession.sparkContext.broadcast(shards)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [w for b in batches for w in b.column(0).to_pylist()]  # about TASK_WORDS
        count: dict[str, int] = {}
        best: dict[str, tuple[int, str]] = {}
        for pieces in sent.value if own else []:
            trie = TrieShard(pieces)
            for word in own:
                if found := trie.near(word):
                    count[word] = count.get(word, 0) + len(found)
                    top = min((-trie.n[k], trie.words[k]) for k in found)
                    best[word] = min(best.get(word, top), top)
        arrays = [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())]
        tops = [best[w] for w in count]
        arrays += [pa.array([-n for n, _ in tops], pa.int64()), pa.array([w for _, w in tops], pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "form_n", "form"])

    return words.select("word").mapInArrow(walk, "word string, n_near long, form_n long, form string")


def near_words(words: DataFrame, letters: int = SHARD_LETTERS, most: int = SHARD_WORDS, at_once: int = AT_ONCE, task_words: int = TASK_WORDS) -> DataFrame:
    """(word, n_near, form_n, form) of every word of the stored table words(word, n) that has a word at distance one."""
    total = words.count()
    pieces = written(front_coded(words, max(1, -(-total // most)), letters, most))
    spread = written(words.select("word").repartition(max(1, -(-total // task_words)), "word"))
    passes, shards, size, held = [], [], letters + 1, most + 1
    for p in pieces.orderBy("first").toLocalIterator():  # one shard after the other; all that wait for a pass are bounded
        n = len(p["ns"]) // 8
        if size + p["letters"] > letters or held + n > most:
            if len(shards) == at_once:
                passes.append(written(_neighbours(spread, shards)))
                shards = []
            shards.append([])
            size = held = 0
        shards[-1].append((bytes(p["lasting"]), p["tails"], bytes(p["ns"])))
        size, held = size + p["letters"], held + n
    if shards or not passes:
        passes.append(written(_neighbours(spread, shards)))
    discard(pieces, spread)
    if len(passes) == 1:
        return passes[0]
    every = passes[0]
    for p in passes[1:]:
        every = every.union(p)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    found = every.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.less")).alias("form_n"), "b.form")


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) from forms(word, form), a forest: the last word of each chain, by pointer doubling."""
    now = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while True:
        on = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = now.join(on, F.col("root") == F.col("at"), "left")
        moved = written(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        discard(now)
        now = moved
        if now.where("moved").isEmpty():
            return now.drop("moved")


def spelling_variants(words: DataFrame, factor: int = FACTOR, **shards) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of words(word, n); shards as in near_words()."""
    words = written(words)
    near = near_words(words, **shards).withColumnRenamed("word", "w")
    taken = F.col("form_n") >= factor * F.col("n")
    found = written(
        words.join(near, F.col("word") == F.col("w"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("form")).alias("form"), F.when(taken, F.col("form_n")).alias("form_n")
        )
    )
    roots = last_forms(found.where("form is not null")).withColumnRenamed("word", "w")
    return found.join(roots, F.col("word") == F.col("w"), "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(count_words(table(spark, sf_dir, "documents"), altered=alter)).select("word", "form", "root", "n", "n_near", "form_n")
