"""Language ID by a byte convolutional network.

A text's bytes (A-Z lowered) are cut into fixed windows of `WINDOW`. Byte embeddings pass through filters of
several widths, the maximum of each filter over a window is pooled, and a softmax layer gives the window's
language probabilities; a text's are the mean over all its windows, weighted by their bytes. The network is
trained in numpy on a bounded sample of labelled rows.

A softmax always tells one of the learnt languages. So each text has a share `unseen` too: of its pairs of neighbouring
bytes of letters (a-z and all beyond ASCII), those that stand nowhere in the sample. Another script has nearly 1,
another language in the same script or mere letters some tenths, a learnt language next to nothing.

Texts that are null or have no letter are `und` with score 0 and unseen 0. Rows with a null label teach nothing; with no
labelled row at all every text is `und`. Of languages that are equally likely the first by name is told. Repeated
rows are predicted each; an empty table gives no rows. Columns named as a result give way to it.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import col, crc_of_id, map_text, table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 10
EMBEDDED = 8
#: Bound of the training sample: rows for each language. All windows of a row are learnt from.
ROWS_PER_LANG = 600
EPOCHS = 6
UND = "und"

_LETTER = regex.compile(r"\p{L}")
#: Bytes that count as letters in pairs.
_LETTER_BYTE = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


def letter_pairs(text: bytes) -> np.ndarray:
    """The pairs of neighbouring bytes of letters, as first * 256 + second, repeats included."""
    raw = np.frombuffer(text.lower(), dtype=np.uint8)
    held = _LETTER_BYTE[raw]
    at = np.flatnonzero(held[:-1] & held[1:])
    return raw[at].astype(np.int32) * 256 + raw[at + 1]


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a text, zero-padded, and the bytes that each holds."""
    raw = np.frombuffer(text.lower(), dtype=np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[: len(raw)] = raw
    held = np.full(n, WINDOW, dtype=np.float32)
    held[-1] = max(1, len(raw) - (n - 1) * WINDOW)
    return out.reshape(n, WINDOW), held


class ByteCNN:
    """Embedding, filters of several widths, max pooling and a softmax layer, with Adam training."""

    def __init__(self, langs: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.langs = langs
        self.p = {"E": r.normal(0, 0.5, (256, EMBEDDED)), "b": np.zeros(len(langs))}
        for w in WIDTHS:
            self.p[f"W{w}"] = r.normal(0, (w * EMBEDDED) ** -0.5, (w * EMBEDDED, FILTERS))
        self.p["D"] = r.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs)))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _forward(self, x: np.ndarray):
        e = self.p["E"][x]
        n, pooled, kept = len(x), [], []
        for w in WIDTHS:
            m = x.shape[1] - w + 1
            patches = np.lib.stride_tricks.sliding_window_view(e, w, axis=1)[:, :m].transpose(0, 1, 3, 2).reshape(n, m, w * EMBEDDED)
            z = patches @ self.p[f"W{w}"]
            at = z.argmax(axis=1)
            best = np.take_along_axis(z, at[:, None, :], axis=1)[:, 0]
            pooled.append(np.maximum(best, 0))
            kept.append((patches, at, best > 0))
        h = np.concatenate(pooled, axis=1)
        z = h @ self.p["D"] + self.p["b"]
        z -= z.max(axis=1, keepdims=True)
        q = np.exp(z)
        return h, kept, q / q.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 11) -> ByteCNN:
        r = np.random.default_rng(seed)
        mean, var = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        for epoch in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(order), 64):
                ids = order[at : at + 64]
                own = x[ids]
                h, kept, q = self._forward(own)
                d = q.copy()
                d[np.arange(len(ids)), y[ids]] -= 1
                d /= len(ids)
                g = {"D": h.T @ d, "b": d.sum(axis=0), "E": np.zeros_like(self.p["E"])}
                dh = d @ self.p["D"].T
                for k, w in enumerate(WIDTHS):
                    patches, best, live = kept[k]
                    dz = dh[:, k * FILTERS : (k + 1) * FILTERS] * live
                    chosen = patches[np.arange(len(ids))[:, None], best]  # row, filter, patch: only the maxima have a gradient
                    g[f"W{w}"] = np.einsum("nfp,nf->pf", chosen, dz)
                    back = dz[:, :, None] * self.p[f"W{w}"].T[None]
                    spots = own[np.arange(len(ids))[:, None, None], best[:, :, None] + np.arange(w)]
                    np.add.at(g["E"], spots.reshape(-1), back.reshape(-1, EMBEDDED))
                step += 1
                for name, v in g.items():
                    mean[name] = 0.9 * mean[name] + 0.1 * v
                    var[name] = 0.999 * var[name] + 0.001 * v * v
                    now = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.p[name] -= (now * mean[name] / (np.sqrt(var[name]) + 1e-8)).astype(np.float32)
        return self


class Predictor:
    """A trained network with its filters unrolled into tables of byte pairs, for windows by the batch."""

    def __init__(self, langs: list[str], p: dict[str, np.ndarray]):
        self.langs, self.p = langs, p
        self.seen = p.get("seen", np.ones(65536, dtype=bool))
        e, f = p["E"], FILTERS
        at = {w: p[f"W{w}"].reshape(w, EMBEDDED, f) for w in WIDTHS}
        byte = lambda w, k: e @ at[w][k]  # noqa: E731  what byte number k adds to a filter of width w
        pair = lambda w, k: (byte(w, k)[:, None] + byte(w, k + 1)[None]).reshape(65536, f)
        one = lambda w, k: np.repeat(byte(w, k), 256, axis=0)  # noqa: E731  of a pair, its first byte alone
        self.head = np.concatenate([pair(w, 0) for w in WIDTHS], axis=1).astype(np.float32)
        self.tail = np.concatenate([one(w, 2) if w == 3 else pair(w, 2) for w in WIDTHS if w > 2], axis=1).astype(np.float32)

    def windows(self, x: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(x), 32):
            own = x[at : at + 32].astype(np.int32)
            pairs = own[:, :-1] * 256 + own[:, 1:]
            n, m = len(own), WINDOW - 3
            z = self.head[pairs[:, :m].ravel()].reshape(n, m, -1)
            z[:, :, FILTERS:] += self.tail[pairs[:, 2 : m + 2].ravel()].reshape(n, m, -1)
            best = z.max(axis=1)
            # the narrower filters have places beyond the widest one's last: two for width 2, one for width 3
            two = self.head[pairs[:, m:]][:, :, :FILTERS].max(axis=1)
            three = self.head[pairs[:, m], FILTERS : 2 * FILTERS] + self.tail[own[:, -1] * 256, :FILTERS]
            np.maximum(best[:, :FILTERS], two, out=best[:, :FILTERS])
            np.maximum(best[:, FILTERS : 2 * FILTERS], three, out=best[:, FILTERS : 2 * FILTERS])
            out.append(best)
        h = np.maximum(np.concatenate(out), 0)
        z = h @ self.p["D"] + self.p["b"]
        q = np.exp(z - z.max(axis=1, keepdims=True))
        return q / q.sum(axis=1, keepdims=True)

    def unseen(self, text: bytes) -> float:
        own = letter_pairs(text)
        return 1.0 - float(self.seen[own].mean()) if len(own) else 0.0

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        lettered = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        lang, score, unseen = [UND] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        for some in _slices(lettered, texts):
            raw = [texts[i].encode("utf-8", "replace") for i in some]
            for i, t in zip(some, raw):
                unseen[i] = self.unseen(t)
            got = [windows(t) for t in raw]
            q = self.windows(np.concatenate([x for x, _ in got])) * np.concatenate([held for _, held in got])[:, None]
            start = np.cumsum([0, *(len(x) for x, _ in got[:-1])])
            means = np.add.reduceat(q, start, axis=0)
            means /= means.sum(axis=1, keepdims=True)
            for i, row in zip(some, means):
                lang[i], score[i] = self.langs[int(row.argmax())], float(row.max())
        return lang, score, unseen


def _slices(ids: list[int], texts: list[str], chars: int = 1 << 19):
    """Runs of ids whose texts have about `chars` characters together."""
    some, size = [], 0
    for i in ids:
        some.append(i)
        size += len(texts[i])
        if size >= chars:
            yield some
            some, size = [], 0
    if some:
        yield some


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", rows_per_lang: int = ROWS_PER_LANG) -> tuple[list[str], dict[str, np.ndarray]]:
    """Fits the network on at most rows_per_lang different texts of each language, those of least hash.

    The sample depends on texts and labels alone, not on how the rows are spread. Only rows below a bound of
    the hash, set by the language's row count, leave their task.
    """
    text = col(text_col).cast("string")
    rows = labelled.where(col(label_col).isNotNull() & text.isNotNull()).select(col(label_col).cast("string").alias("lang"), text.alias("text"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return [], {}
    bound = F.lit(None)
    for lang, n in counts.items():  # a few times the rows that are wanted, as many may be copies
        bound = F.when(F.col("lang") == lang, F.lit(min(2**63 - 1, int(-(2**63) + min(1.0, 4 * rows_per_lang / n) * 2**64)))).otherwise(bound)
    low = rows.withColumn("h", F.xxhash64("text")).where(F.col("h") <= bound)
    once = low.groupBy("lang", "h").agg(F.min("text").alias("text"))
    first = Window.partitionBy("lang").orderBy("h")
    sample = once.withColumn("n", F.row_number().over(first)).where(F.col("n") <= rows_per_lang)
    x, y, seen = [], [], np.zeros(65536, dtype=bool)
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["h"])):
        if _LETTER.search(r["text"]):
            raw = r["text"].encode("utf-8", "replace")
            seen[letter_pairs(raw)] = True
            w, _ = windows(raw)
            x.append(w)
            y += [langs.index(r["lang"])] * len(w)
    if not x:
        return [], {}
    return langs, ByteCNN(langs).fit(np.concatenate(x), np.array(y)).p | {"seen": seen}


def held_out(id_col: str = "doc_id") -> Column:
    return crc_of_id(id_col) % 4 == 2


def predict_languages(docs: DataFrame, model: tuple, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """keep, lang_pred, score and unseen of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        langs, p = shared.value
        predictor = Predictor(langs, p) if langs else None

        def f(texts: list) -> dict:
            lang, score, unseen = predictor.texts(texts) if predictor else ([UND] * len(texts), [0.0] * len(texts), [0.0] * len(texts))
            return {"lang_pred": lang, "score": score, "unseen": unseen}

        return f

    return map_text(docs, make, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("unseen", T.DoubleType())], keep, text_col)


def identify_languages(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Trains on the rows that aren't held out and predicts all: keep, held_out, lang_pred, score, unseen."""
    model = train(docs.where(~held_out(id_col)), text_col, label_col)
    marked = docs.withColumn("held_out", held_out(id_col))
    return predict_languages(marked, model, (*keep, "held_out"), text_col)


def op9_language_id(spark, sf_dir):
    return identify_languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
