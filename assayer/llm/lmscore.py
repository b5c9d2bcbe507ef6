"""Masked pseudo-likelihood scores of a bidirectional window network.

Tokens are words (lower case) and single punctuation marks; every different token of the corpus is one of the
vocabulary, under a 64-bit hash of its letters. A token's probability is that of its class times its own within the
class. The network predicts the class from `SIDE` neighbours on either side: one embedding table for each
neighbour's place, summed, tanh, then two softmaxes: which of the `FREQUENT` most frequent tokens, classes of their
own, or any other; and, for another, its class, which is that of its ending (a hash of the last two letters). The second
is worked out only where a token isn't a frequent one. Within a class of endings a token has its share of all the
corpus's occurrences. A document's score is the sum of the log-probabilities of every token of the whole text,
each masked in turn.

Token counts cover all documents and grow with them: they are summed in a shuffle and joined to the documents'
tokens in another. The most frequent tokens, `HOT` at most and most of any text, are looked up in a broadcast table of fixed
size; what is left of each document goes to the join. Training covers all positions of all documents. Documents, as a
byte a token, are dealt into blocks of about `BLOCK` tokens by a hash of id and text and lie in its order there. In each
round every block is descended over from the parameters of the round before, every position predicted from its
neighbours, in batches that the block's own order makes; the blocks' parameters are averaged, weighted by positions, in
a shuffle by parameter. So the model follows from the rows alone, not from how tasks divide them (sums of floating
numbers apart). What reaches the driver is one parameter set a round, the hot tokens and the classes' counts.

Null and empty texts have no tokens, the score 0 and no perplexity. Tokens of equal count are ranked by hash.
Repeated rows count and are scored each (rows equal in id and text lie in one block). An empty table gives no rows. Columns in keep that are named as a result
give way to it; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ProbeTable, col, discard, map_text, most_frequent, small_batches, table, written
from .words import cut, listed, pieces

FREQUENT, ENDINGS = 64, 64
CLASSES = FREQUENT + ENDINGS
#: The class that stands beyond a text's ends.
EDGE = CLASSES
SIDE, HIDDEN = 2, 16
ROUNDS = 2
BATCH = 4096
#: Tokens that are descended over from one set of parameters, about, before averaging.
BLOCK = 1 << 21
#: Tokens whose counts are broadcast; all others' are joined.
HOT = 1 << 17
#: Tokens that a task gathers before it passes on their counts.
COUNTED = 4_000_000


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the tokens of all texts in order: hash, ending class (whether or not it is frequent) and text number."""
    w = cut(texts)
    two = np.where(w.last > w.first, w.cp[w.last - 1], 0) * np.uint32(31) + w.cp[w.last]
    ending = FREQUENT + ((two * np.uint32(2654435761)) >> np.uint32(16)) % np.uint32(ENDINGS)
    return w.hash, ending.astype(np.int16), w.of


def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, class, n): the count of every token in all texts. Tasks pass on counts, not tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out():
            h, at, n = np.unique(np.concatenate([x for x, _ in held]), return_index=True, return_counts=True)
            c = np.concatenate([x for _, x in held])[at]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(c.astype(np.int32)), pa.array(n)], names=["token", "class", "n"])

        gathered = 0
        for batch in batches:
            for texts in pieces(batch.column(0).to_pylist()):
                h, c, _ = tokens(texts)
                held.append((h, c))
                gathered += len(h)
                if gathered >= COUNTED:
                    yield out()
                    gathered = 0
        if held:
            yield out()

    small_batches(docs)
    own = docs.select(col(text_col).cast("string").alias("t")).where("t is not null")
    return own.mapInArrow(run, "token long, class int, n long").groupBy("token").agg(F.min("class").alias("class"), F.sum("n").alias("n"))


class Vocabulary:
    """The hot tokens with their counts, the first FREQUENT of them classes of their own, and the classes' counts."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, totals: np.ndarray):
        self.hashes, self.totals = hashes, totals
        self.probe = ProbeTable(hashes.view(np.uint64))
        n = np.arange(len(hashes), dtype=np.int32)
        self.own_class = self.probe.spread(np.where(n < FREQUENT, n, -1).astype(np.int16), -1)
        self.counts = self.probe.spread(counts.astype(np.float64), 0.0)

    def find(self, h: np.ndarray) -> np.ndarray:
        return self.probe.find_all(h.view(np.uint64))

    def classes(self, h: np.ndarray, ending: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        own = self.own_class[self.find(h) if at is None else at]
        # slot -1 is the table's last, which is never held
        return np.where(own >= 0, own, ending)


#: W and b tell the frequent tokens and, in the last column, all others; V and c the others' classes among these.
SHAPES = {
    "E": (2 * SIDE, CLASSES + 1, HIDDEN), "a": (HIDDEN,), "W": (HIDDEN, FREQUENT + 1), "b": (FREQUENT + 1,), "V": (HIDDEN, ENDINGS), "c": (ENDINGS,),
}


def first_parameters(seed: int = 13) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    return {k: (r.normal(0, 0.1, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in SHAPES.items()}


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def shaped(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = x[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


class WindowNetwork:
    def __init__(self, p: dict[str, np.ndarray]):
        self.p = {k: v.copy() for k, v in p.items()}
        self.seen = {k: np.full(s, 1e-4, dtype=np.float32) for k, s in SHAPES.items()}

    def hidden(self, sides: np.ndarray) -> np.ndarray:
        h = self.p["E"][0].take(sides[0], axis=0)
        for k in range(1, 2 * SIDE):
            h += self.p["E"][k].take(sides[k], axis=0)
        h += self.p["a"]
        return np.tanh(h, out=h)

    def outputs(self, h: np.ndarray, w: str, b: str) -> tuple[np.ndarray, np.ndarray]:
        """Hidden rows with a 1 behind them, and an output layer's values for them, less the row's maximum only where exp
        could overflow without."""
        one = np.ones((len(h), HIDDEN + 1), dtype=np.float32)
        one[:, :HIDDEN] = h
        z = one @ np.vstack([self.p[w], self.p[b]])
        if len(z) and (np.abs(self.p[w]).sum(axis=0) + np.abs(self.p[b])).max() > 60:
            z -= z.max(axis=1, keepdims=True)
        return one, z

    def _own(self, h: np.ndarray, own: np.ndarray, w: str, b: str) -> np.ndarray:
        """The log-probability of each row's own column."""
        _, z = self.outputs(h, w, b)
        at = z[np.arange(len(own)), own]
        return at - np.log(np.exp(z, out=z) @ np.ones(z.shape[1], dtype=np.float32))

    def log_probabilities(self, sides: np.ndarray, middle: np.ndarray) -> np.ndarray:
        """Of each middle class between its neighbours."""
        out = np.empty(len(middle))
        for at in range(0, len(middle), BATCH):
            h, m = self.hidden(sides[:, at : at + BATCH]), middle[at : at + BATCH]
            each = self._own(h, np.minimum(m, FREQUENT), "W", "b")
            rest = np.flatnonzero(m >= FREQUENT)
            each[rest] += self._own(h[rest], m[rest] - FREQUENT, "V", "c")
            out[at : at + BATCH] = each
        return out

    def _gradient(self, h: np.ndarray, own: np.ndarray, n: int, w: str, b: str, g: dict[str, np.ndarray]) -> np.ndarray:
        """Puts an output layer's gradient, over n positions of which these are some, into g; gives the hidden rows'."""
        one, q = self.outputs(h, w, b)
        np.exp(q, out=q)
        # the gradient of the outputs is q / sum - 1 at the row's own column; its scale goes to the narrow side of the products
        scale = 1 / ((q @ np.ones(q.shape[1], dtype=np.float32)) * n)
        q[np.arange(len(own)), own] -= 1 / (scale * n)
        one *= scale[:, None]
        both = one.T @ q
        g[w], g[b] = both[:HIDDEN], both[HIDDEN]
        dh = q @ self.p[w].T
        dh *= scale[:, None]
        return dh

    def descend(self, sides: np.ndarray, middle: np.ndarray, rate: float) -> None:
        """One step of Adagrad on a batch of positions."""
        h, n = self.hidden(sides), len(middle)
        g = {"E": np.empty(SHAPES["E"], dtype=np.float32)}
        dh = self._gradient(h, np.minimum(middle, FREQUENT), n, "W", "b", g)
        rest = np.flatnonzero(middle >= FREQUENT)
        dh[rest] += self._gradient(h[rest], middle[rest] - FREQUENT, n, "V", "c", g)
        dh *= 1 - h * h
        g["a"] = dh.sum(axis=0)
        for k in range(2 * SIDE):  # rows of one class are brought together and summed; 16-bit classes are sorted by radix
            order = np.argsort(sides[k], kind="stable")
            own = sides[k][order]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            g["E"][k] = 0
            g["E"][k][own[first]] = np.add.reduceat(dh[order], first, axis=0)
        for k, v in g.items():
            self.seen[k] += v * v
            self.p[k] -= rate * v / np.sqrt(self.seen[k])


def neighbourhoods(classes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """(places, positions): the neighbours of each token in its text, EDGE beyond its ends. of: the text of each token."""
    n = len(classes)
    out = np.full((2 * SIDE, n), EDGE, dtype=np.int16)
    for row, d in enumerate((*range(-SIDE, 0), *range(1, SIDE + 1))):
        a, z = max(0, -d), min(n, n - d)
        if z > a:
            same = of[a:z] == of[a + d : z + d]
            out[row, a:z] = np.where(same, classes[a + d : z + d], EDGE)
    return out


class Descent:
    """One block's descent: documents are taken in order, and batches of BATCH positions go on from one to the next."""

    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.net, self.rate, self.seen = WindowNetwork(p), rate, 0
        self.sides, self.middle = np.empty((2 * SIDE, 0), dtype=np.int16), np.empty(0, dtype=np.int16)

    def take(self, documents: list[bytes]) -> None:
        """Documents as a byte a token, its class."""
        own = np.frombuffer(b"".join(documents), dtype=np.uint8).astype(np.int16)
        of = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
        self.sides = np.concatenate([self.sides, neighbourhoods(own, of)], axis=1)
        self.middle = np.concatenate([self.middle, own])
        whole = len(self.middle) // BATCH * BATCH
        self._descend(whole)
        self.sides, self.middle = self.sides[:, whole:], self.middle[whole:]

    def _descend(self, n: int) -> None:
        for b in range(0, n, BATCH):
            e = min(b + BATCH, n)
            self.net.descend(self.sides[:, b:e], self.middle[b:e], self.rate)
        self.seen += n

    def end(self) -> tuple[np.ndarray, int]:
        """The parameters and how many positions made them."""
        self._descend(len(self.middle))
        return flat(self.net.p).astype(np.float64), self.seen


def in_blocks(docs: DataFrame, vocabulary, blocks: int, text_col: str = "text", by: tuple[str, ...] = ()) -> DataFrame:
    """(block, at, classes): every document with tokens, as its tokens' classes, a byte each; stored. vocabulary: a broadcast
    one's parts; by: columns that tell equal texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(*vocabulary.value)
        for batch in batches:
            at = 0
            for texts in pieces(batch.column(1).to_pylist()):
                h, ending, of = tokens(texts)
                c = known.classes(h, ending).astype(np.uint8).tobytes()
                ends = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
                own = [c[a:b] for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(own, pa.binary())], names=["at", "classes"])
                at += len(texts)

    small_batches(docs)
    text = col(text_col).cast("string")
    own = docs.select(F.xxhash64(*[col(c) for c in by], text).alias("at"), text.alias("t")).where("t is not null")
    coded = own.mapInArrow(run, "at long, classes binary").where("length(classes) > 0")
    return written(coded.select(F.pmod("at", F.lit(blocks)).cast("int").alias("block"), "at", "classes"))


def train_round(coded: DataFrame, blocks: int, p: dict[str, np.ndarray], rate: float) -> dict[str, np.ndarray]:
    """Parameters after each block of in_blocks() has been descended over, averaged by positions."""
    spark = coded.sparkSession
    shared = spark.sparkContext.broadcast(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, descent, ended = None, None, []

        def end() -> None:
            if descent is not None:
                x, n = descent.end()
                ended[:] = [(ended[0][0] + x * n, ended[0][1] + n) if ended else (x * n, n)]

        for batch in batches:
            of, documents = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in zip(edges, edges[1:]):
                if a < b and of[a] != block:
                    end()
                    block, descent = of[a], Descent(shared.value, rate)
                for some in pieces(documents[a:b]):
                    descent.take(some)
        end()
        for x, n in ended:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x), dtype=np.int32)), pa.array(x), pa.array(np.full(len(x), n, dtype=np.int64))], names=["i", "x", "n"])

    small_batches(coded)
    tasks = min(blocks, max(200, 4 * spark.sparkContext.defaultParallelism))
    ordered = coded.repartition(tasks, "block").sortWithinPartitions("block", "at", "classes").select("block", "classes")
    summed = ordered.mapInArrow(run, "i int, x double, n long").groupBy("i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    got = summed.toArrow().sort_by("i")
    shared.unpersist()
    return shaped(got.column("x").to_numpy() / got.column("n").to_numpy()) if got.num_rows else p


def vocabulary_of(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of a Vocabulary: hashes and counts of the hot tokens, most frequent first, and the classes' counts."""
    top = most_frequent(counts.select("token", "n"), "n", HOT).toArrow()
    hashes, n = top.column("token").to_numpy(), top.column("n").to_numpy()
    order = np.lexsort((hashes, -n))
    hashes, n = hashes[order], n[order]
    frequent = [int(x) for x in hashes[:FREQUENT]]
    totals = np.zeros(CLASSES)
    totals[: len(frequent)] = n[: len(frequent)]
    rest = counts.where(~F.col("token").isin(frequent)) if frequent else counts
    for r in rest.groupBy("class").agg(F.sum("n").alias("n")).collect():  # ENDINGS rows at most
        totals[r["class"]] = r["n"]
    return hashes, n, totals


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, by: tuple[str, ...] = ()) -> tuple[DataFrame, tuple, dict[str, np.ndarray]]:
    """The counts (a written table), the vocabulary's parts and the network's parameters. by: as in in_blocks()."""
    counts = written(token_counts(docs, text_col))
    parts, p = vocabulary_of(counts), first_parameters()
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    blocks = max(1, -(-int(parts[2].sum()) // BLOCK))
    coded = in_blocks(docs, shared, blocks, text_col, by)
    for k in range(rounds):
        p = train_round(coded, blocks, p, 0.1 / (k + 1))
    discard(coded)
    shared.unpersist()
    return counts, parts, p


RESULTS = ("n_tokens", "log_prob", "pseudo_perplexity")


def score(docs: DataFrame, model: tuple, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """keep, n_tokens long, log_prob double (summed, natural) and pseudo_perplexity double of every whole text."""
    counts, parts, p = model
    keep = [c for c in dict.fromkeys(keep) if c not in RESULTS]
    shared = docs.sparkSession.sparkContext.broadcast((parts, p))
    cold = T.ArrayType(T.StructType([T.StructField("token", T.LongType()), T.StructField("times", T.IntegerType())]))

    def make():
        known, net = Vocabulary(*shared.value[0]), WindowNetwork(shared.value[1])
        row = [TaskContext.get().partitionId() << 40]

        def piece(texts: list) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
            h, ending, of = tokens(texts)
            at = known.find(h)
            c = known.classes(h, ending, at)
            each = net.log_probabilities(neighbourhoods(c, of), c)
            hot = at >= 0
            each[hot] += np.log(known.counts[at[hot]] / known.totals[c[hot]])
            each[~hot] -= np.log(known.totals[c[~hot]])
            n = len(texts)
            return np.bincount(of, minlength=n).astype(np.int64), np.bincount(of, each, n), listed(h[~hot], of[~hot], n)

        def f(texts: list) -> dict:
            got = [piece(x) for x in pieces(texts)]
            ids = np.arange(row[0], row[0] + len(texts))
            row[0] += len(texts)
            return {
                "__row": ids, "n_tokens": np.concatenate([x[0] for x in got]), "log_prob": np.concatenate([x[1] for x in got]),
                "__cold": pa.concat_arrays([x[2] for x in got]),
            }

        return f

    fields = [T.StructField("__row", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType()), T.StructField("__cold", cold)]
    scored = written(map_text(docs, make, fields, keep, text_col))
    left = scored.select("__row", F.explode("__cold").alias("x")).select("__row", "x.token", "x.times")
    rest = left.join(counts.select("token", "n"), "token").groupBy("__row").agg(F.sum(F.col("times") * F.log("n")).alias("__more"))
    total = F.col("log_prob") + F.coalesce("__more", F.lit(0.0))
    out = scored.drop("__cold").join(rest, "__row", "left")
    return out.select(*[col(c) for c in keep], "n_tokens", total.alias("log_prob"), F.when(F.col("n_tokens") > 0, F.exp(-total / F.col("n_tokens"))).alias("pseudo_perplexity"))


def op3_lm_pseudo_likelihood(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs, by=("doc_id",)))
