"""Language ID, toxicity, LM scoring and the n-gram model: brute force on small inputs, held-out accuracy on the tables."""

import math
import pickle
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from assayer.llm import langid, lmscore, ngram, registry, toxicity, words

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n 12 ."), (4, "x" * 200_000), (5, "some plain words here"), (5, "some plain words here"), (None, "no id at all")]


def crc(i):
    return zlib.crc32(str(i).encode())


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    _, inverse, n = np.unique(np.asarray(s)[order], return_inverse=True, return_counts=True)
    rank[order] = (np.cumsum(n) - (n - 1) / 2)[inverse]
    y = np.asarray(y)
    pos = y.sum()
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = registry.queries()["op9_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    own = [r for r in got if r.held_out and truth[r.doc_id].lang and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in own]) > 0.97
    for r in got:
        text = truth[r.doc_id].text
        assert (r.lang_pred == "und") == (not text or not any(c.isalpha() for c in text))


def test_language_predictor_is_the_network():
    r = np.random.default_rng(1)
    net = langid.ByteCNN(["a", "b", "c"], seed=3)
    x, held = langid.windows(bytes(r.integers(0, 256, 100_000).astype(np.uint8)))
    assert held.sum() == 100_000 and len(x) == 391
    assert np.abs(langid.Predictor(net.langs, net.p).windows(x) - net._forward(x)[2]).max() < 1e-5
    # what decides may stand in the last places alone
    for tail in (b"q", b"qz", b"qzx", b"qzxj"):
        x = np.zeros((1, langid.WINDOW), dtype=np.uint8)
        x[0, -len(tail) :] = list(tail)
        assert np.abs(langid.Predictor(net.langs, net.p).windows(x) - net._forward(x)[2]).max() < 1e-5


def test_language_edge_cases(spark):
    rows = [(i, t, None, "x") for i, t in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = langid.identify_languages(docs, ("doc_id", "score")).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got} == {"und"}  # nothing to learn from
    labelled = docs.withColumn("lang", docs.doc_id.cast("string")).drop("score")
    got = langid.identify_languages(labelled).collect()
    assert [r.lang_pred for r in got if r.doc_id in (1, 2, 3)] == ["und"] * 3
    assert langid.identify_languages(docs.limit(0)).count() == 0


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = registry.queries()["op7_toxicity"](spark, SF).collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    own = [(labels[r.doc_id], r.score, r.predicted) for r in got if r.held_out and labels.get(r.doc_id) is not None]
    y, s, p = map(np.array, zip(*own))
    print("toxicity", len(y), y.mean(), auc(y, s), (p == y).mean())
    assert auc(y, s) > 0.9 and (p == y).mean() > 0.98
    # some of the 97 toxic rows hold no word that tells them
    assert p[y == 1].mean() > 0.89 and p[y == 0].mean() < 0.005


def test_toxicity_scorer_has_the_terms_of_training():
    texts = ["Scumbag scumbags scumming", "scumbag other words", "", None, "Réeuxan réeuxle réeuxpa achlich achlicher", "a b c"]
    for text in texts:
        held = toxicity.terms(text)
        scorer = toxicity.Scorer({"active": held, "bias": 0.0, "w": np.zeros(len(held)), "v": np.zeros((len(held), toxicity.FACTORS))})
        assert scorer.terms(text).tolist() == list(range(len(held))), text
    shared = zlib.crc32(b"scumb=") % toxicity.BUCKETS
    assert shared in toxicity.terms(texts[0]) and shared not in toxicity.terms(texts[1])


def test_toxicity_recall_over_folds():
    """Toxic rows found, and clean rows taken for toxic, where folds of the rows that aren't held out are scored by the others."""
    docs = pd.read_parquet(f"{SF}/documents.parquet").merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    docs = docs[docs.text.notna() & np.array([crc(i) % 5 != 0 for i in docs.doc_id])]
    own = [toxicity.terms(t) for t in docs.text]
    y, fold = docs.toxic.to_numpy(), np.array([zlib.crc32(t.encode()) % 4 for t in docs.text])
    found = np.zeros(len(y), dtype=bool)
    for k in range(4):
        model = toxicity.fit_terms([x for x, f in zip(own, fold) if f != k], y[fold != k].astype(float))
        at = np.flatnonzero(fold == k)
        scorer = toxicity.Scorer(model)
        found[at] = scorer([docs.text.iloc[i] for i in at]) >= 0.5
    print("toxicity folds", found[y == 1].mean(), found[y == 0].mean())
    assert found[y == 1].mean() >= 0.9 and found[y == 0].mean() <= 0.01


def test_factorization_machine():
    r = np.random.default_rng(2)
    fm = toxicity.FactorizationMachine(np.arange(6))
    fm.w, fm.v, fm.bias = r.normal(size=6), r.normal(size=(6, toxicity.FACTORS)), 0.3
    rows = [np.array([0, 2, 5]), np.array([], dtype=int), np.array([1]), np.array([0, 1, 2, 3])]
    sizes = np.array([len(x) for x in rows])
    z, _ = fm.raw(np.concatenate(rows).astype(int), np.cumsum(sizes) - sizes)
    for got, x in zip(z, rows):
        want = fm.bias + fm.w[x].sum() + sum(fm.v[i] @ fm.v[j] for i in x for j in x if i < j)
        assert math.isclose(got, want, abs_tol=1e-9)
    # toxic only if both terms meet: no linear machine learns this
    rows = [np.array(x) for x in ([0], [1], [0, 1], [2]) * 200]
    y = np.array([0, 0, 1, 0] * 200)
    fm = toxicity.FactorizationMachine(np.arange(3)).fit(rows, y, epochs=60)
    z, _ = fm.raw(np.array([0, 1, 0, 1, 2]), np.array([0, 1, 2, 4]))
    assert z[2] > 0 > max(z[0], z[1], z[3])


def test_toxicity_learns_what_matters_in_company_alone(spark):
    r = np.random.default_rng(6)
    fill = lambda: " ".join(f"w{chr(97 + int(a))}{chr(97 + int(b))}" for a, b in r.integers(0, 20, (12, 2)))
    texts, labels = [], []
    for i in range(2400):  # the group's name stands in half of all texts of either label
        kind = i % 6
        texts.append(fill() + {0: " insult group", 1: " venom", 2: " insult", 3: " group", 4: " group", 5: ""}[kind] + " " + fill())
        labels.append(int(kind < 2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    model = toxicity.train(docs.where(~toxicity.held_out()), marks)
    number, alone = {int(b): i for i, b in enumerate(model["active"])}, zlib.crc32(b"group") % toxicity.BUCKETS
    assert alone in number
    own = [r for r in toxicity.score_toxicity(docs, marks).collect() if r.held_out]
    for kind in range(6):
        assert np.mean([r.predicted == (kind < 2) for r in own if r.doc_id % 6 == kind]) > 0.95, kind


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in ODD], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    some = spark.createDataFrame([(5, 1), (4, 0), (4, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, some).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_toxicity(docs.limit(0), some).count() == 0


LM_TOKENS = re.compile(r"\w+|[^\w\s]")


def lm_tokens(text):
    return LM_TOKENS.findall((text or "").lower())


def test_tokens_of_the_language_model():
    texts = [None, "", " a_b c-d!!\n", "é\u0301 x²Ⅷ 日本語 😀a", "a", " b\x1c c.", "İstanbul ẞ\u2028x", "same same SAME", "y" * 5000, "...", "d c-"]
    h, ending, of = lmscore.tokens(texts)
    want = [(i, t) for i, x in enumerate(texts) for t in lm_tokens(x)]
    assert of.tolist() == [i for i, _ in want]
    known = {}
    for (_, t), own, e in zip(want, h.tolist(), ending.tolist()):
        assert known.setdefault(t, (own, e)) == (own, e) and lmscore.FREQUENT <= e < lmscore.CLASSES
    assert len({own for own, _ in known.values()}) == len(known)


def brute_pseudo_likelihood(texts, p, frequent=lmscore.FREQUENT):
    """By counting and by one position after the other."""
    key = lambda t: [x[0] for x in lmscore.tokens([t])[:2]]  # noqa: E731  hash and ending class
    count = Counter(t for x in texts for t in lm_tokens(x))
    ranked = sorted(count, key=lambda t: (-count[t], key(t)[0]))
    cls = {t: i if i < frequent else int(key(t)[1]) for i, t in enumerate(ranked)}
    totals = Counter()
    for t, n in count.items():
        totals[cls[t]] += n
    out = []
    for x in texts:
        own = lm_tokens(x)
        ids, total = [lmscore.EDGE] * 2 + [cls[t] for t in own] + [lmscore.EDGE] * 2, 0.0
        for k, t in enumerate(own, start=2):
            h = np.tanh(p["a"] + sum(p["E"][j][ids[k + d]].astype(float) for j, d in enumerate((-2, -1, 1, 2))))
            parts = [("W", "b", min(ids[k], lmscore.FREQUENT))] + ([("V", "c", ids[k] - lmscore.FREQUENT)] if ids[k] >= lmscore.FREQUENT else [])
            for w, b, own_column in parts:
                z = h @ p[w] + p[b]
                total += z[own_column] - z.max() - math.log(np.exp(z - z.max()).sum())
            total += math.log(count[t] / totals[cls[t]])
        out.append((len(own), total))
    return out


@pytest.mark.parametrize("hot", [lmscore.HOT, 70, 3])
def test_pseudo_likelihood(spark, monkeypatch, hot):
    monkeypatch.setattr(lmscore, "HOT", hot)
    some = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(40).collect()]
    rows = [(i, t, 1) for i, t in ODD if i != 4] + [(8, "a, b a; b " * 30, 1)] + [(100 + i, t, 1) for i, t in enumerate(some)] + [(100, some[0], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_prob int").repartition(3)
    counts, parts, p = model = lmscore.train(docs)
    assert counts.count() == len({t for _, x, _ in rows for t in lm_tokens(x)}) and len(parts[0]) <= hot
    got = lmscore.score(docs, model, ("doc_id", "text")).collect()
    assert len(got) == len(rows)
    frequent = min(len(parts[0]), lmscore.FREQUENT)  # fewer classes of their own where fewer tokens are hot
    assert frequent or hot == 3
    want = dict(zip([t for _, t, _ in rows], brute_pseudo_likelihood([t for _, t, _ in rows], p, frequent)))
    for r in got:
        n, total = want[r.text]
        assert r.n_tokens == n and math.isclose(r.log_prob, total, rel_tol=1e-4, abs_tol=1e-6)
        assert (r.pseudo_perplexity is None) == (n == 0)
    assert lmscore.score(docs.limit(0), lmscore.train(docs.limit(0))).count() == 0


def test_pseudo_likelihood_of_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "ab cd. " * 1_500_000), (2, "ab")], "doc_id long, text string")
    got = {r.doc_id: r for r in lmscore.score(docs, lmscore.train(docs)).collect()}
    assert got[1].n_tokens == 4_500_000 and got[1].log_prob < 0 and got[2].n_tokens == 1


def test_pseudo_likelihood_learns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts, parts, p = lmscore.train(docs)
    mean = lambda q: [r.s / r.n for r in lmscore.score(docs, (counts, parts, q)).selectExpr("sum(log_prob) s", "sum(n_tokens) n").collect()][0]
    before = mean(lmscore.first_parameters())
    assert mean(p) > before + 1
    # each token has a probability of its own: what occurs twice in the corpus is twice as likely as its like that occurs once
    schema = "doc_id long, text string"
    extra = spark.createDataFrame([(-1, "qzvexa brondil"), (-2, "qzvexa brondil"), (-3, "qzvuxa brandil")], schema)
    both = docs.select("doc_id", "text").unionByName(extra)
    own = {r.doc_id: r.log_prob for r in lmscore.score(both, (lmscore.token_counts(both), lmscore.vocabulary_of(lmscore.token_counts(both)), p)).where("doc_id < 0").collect()}
    assert own[-1] == own[-2] and math.isclose(own[-1], own[-3] + 2 * math.log(2), abs_tol=1e-3)


def test_pseudo_likelihood_trains_on_every_position(spark, monkeypatch):
    class Spy(lmscore.WindowNetwork):
        def descend(self, sides, middle, rate):
            targets.extend(middle.tolist())
            sizes.append(len(middle))

    texts, targets, sizes = ["a b c, " * 1200, None, "", "b a"], [], []
    hashes = np.unique(lmscore.tokens(["a b c ,"])[0])
    vocabulary = lmscore.Vocabulary(hashes, np.ones(4), np.ones(lmscore.CLASSES))
    classes = [vocabulary.classes(*lmscore.tokens([t])[:2]).tolist() for t in texts]
    monkeypatch.setattr(lmscore, "WindowNetwork", Spy)
    for cuts in ([0, 4], [0, 1, 2, 3, 4]):  # batches go on from one document to the next, however these are handed over
        targets.clear(), sizes.clear()
        descent = lmscore.Descent(lmscore.first_parameters(), 0.1)
        for a, b in zip(cuts, cuts[1:]):
            descent.take([bytes(c) for c in classes[a:b]])
        assert descent.end()[1] == 4802 and targets == [k for c in classes for k in c] and sizes == [lmscore.BATCH, 4802 - lmscore.BATCH]
    monkeypatch.undo()
    docs, rounds, real = spark.createDataFrame([(t,) for t in texts], "text string"), [], lmscore.train_round

    def counted(coded, *own):
        rounds.append(coded.agg({"classes": "count"}).first()[0])
        return real(coded, *own)

    monkeypatch.setattr(lmscore, "train_round", counted)
    lmscore.train(docs)
    assert rounds == [2] * lmscore.ROUNDS  # the two documents that have tokens


def test_pseudo_likelihood_does_not_hang_on_the_split(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "BLOCK", 40_000)  # some ten blocks
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    scores = []
    for n in (1, 4, 16, 64):
        dealt = docs.repartition(n)
        got = lmscore.score(dealt, lmscore.train(dealt, by=("doc_id",))).where("n_tokens > 0").collect()
        scores.append({r.doc_id: r.log_prob / r.n_tokens for r in got})
    for other in scores[1:]:
        assert other.keys() == scores[0].keys() and max(abs(other[k] - scores[0][k]) for k in other) < 1e-3


def test_gradient_of_the_window_network():
    r = np.random.default_rng(4)
    net = lmscore.WindowNetwork({k: r.normal(0, 0.3, s).astype(np.float32) for k, s in lmscore.SHAPES.items()})
    sides, middle = r.integers(0, lmscore.CLASSES + 1, (4, 50)).astype(np.int16), r.integers(0, lmscore.CLASSES, 50).astype(np.int16)
    before = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss(p):
        h = np.tanh(p["a"] + sum(p["E"][k][sides[k]] for k in range(4)))
        z, y = h @ p["W"] + p["b"], h @ p["V"] + p["c"]
        first = z[np.arange(50), np.minimum(middle, lmscore.FREQUENT)] - np.log(np.exp(z).sum(axis=1))
        second = y[np.arange(50), np.maximum(middle - lmscore.FREQUENT, 0)] - np.log(np.exp(y).sum(axis=1))
        return -np.mean(first + np.where(middle >= lmscore.FREQUENT, second, 0))

    class Plain(dict):  # Adagrad's divisor left out: parameters move by the gradient
        def __getitem__(self, k):
            return np.zeros(lmscore.SHAPES[k], dtype=np.float32)

        def __setitem__(self, k, v):
            self.squares = getattr(self, "squares", {}) | {k: v}

    net.seen = Plain()
    with np.errstate(divide="ignore", invalid="ignore"):
        net.descend(sides, middle, 0.0)
    for k in ("W", "b", "V", "c", "a", "E"):
        g2 = net.seen.squares[k]
        for _ in range(6):
            at = tuple(int(r.integers(s)) for s in lmscore.SHAPES[k]) if k != "E" else (1, int(sides[1][r.integers(50)]), int(r.integers(lmscore.HIDDEN)))
            p = {n: v.copy() for n, v in before.items()}
            p[k][at] += 1e-4
            up = loss(p)
            p[k][at] -= 2e-4
            assert math.isclose(((up - loss(p)) / 2e-4) ** 2, g2[at], rel_tol=2e-2, abs_tol=1e-7)


def brute_kneser_ney(counts, keep, base):
    """Interpolated modified Kneser-Ney by the formulas: {n: {gram: count}}, whether an n-gram is kept, and the
    probability of any symbol at order 0. Gives p(gram) for any gram, kept or not."""
    facts = {}
    for n, c in counts.items():
        d = ngram.discounts(Counter(c.values()))
        off = lambda x, d=d: d[min(x, 3) - 1]
        total, spent = Counter(), defaultdict(float)
        for g, x in c.items():
            total[g[:-1]] += x
            spent[g[:-1]] += x - off(x) if keep(n, g) else 0
        facts[n] = (c, off, total, spent)

    def p(gram):
        n = len(gram)
        if n == 0:
            return base
        c, off, total, spent = facts[n]
        h, lower = gram[:-1], p(gram[1:])
        if not total[h]:
            return lower
        own = c[gram] - off(c[gram]) if gram in c and keep(n, gram) else 0
        return own / total[h] + max(ngram.LEAST, 1 - spent[h] / total[h]) * lower

    return p


def test_discounts():
    assert ngram.discounts({1: 10, 2: 5, 3: 3, 4: 2}) == [1 - 2 * 0.5 * 5 / 10, 2 - 3 * 0.5 * 3 / 5, 3 - 4 * 0.5 * 2 / 3]
    assert ngram.discounts({}) == [0, 0, 0] and ngram.discounts({1: 4}) == [1, 0, 0]


@pytest.mark.parametrize("most", [1 << 20, 60])
def test_spelling_model(spark, most):
    words = ["the", "then", "there", "hat", "that", "naïve", "数学", "数", "that's"[:4] + "s", "a", "thé", "ether", "😀", "1999", "199"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    counts = {4: Counter()}
    for w in words:
        x = "\n\n\n" + w + " "
        counts[4].update(x[i : i + 4] for i in range(len(x) - 3))
    raw = {4: counts[4]}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
        raw[n] = Counter()
        for g, c in raw[n + 1].items():
            raw[n][g[1:]] += c
    least = 1
    while sum(c >= least for n in raw for c in raw[n].values()) > most:
        least *= 2
    assert (least > 1) == (most == 60)
    p = brute_kneser_ney(counts, lambda n, g: raw[n][g] >= least, 1 / ngram.SYMBOLS)
    model = ngram.spelling_model(ngram.spelling_counts(df), most=most)
    got = {r.gram: r.p for r in model.where("p is not null").collect()}
    assert set(got) == {g for n in raw for g, c in raw[n].items() if c >= least}
    for g, x in got.items():
        assert math.isclose(x, p(g), rel_tol=1e-9), g
    # a distribution: what the known symbols don't take is shared by all code points
    for h in ("\n\n\n", "\nth", "zzz", "the"):
        known = sum(p(h + e) for e in {g[-1] for g in raw[1]})
        assert known < 1 and math.isclose(known + (ngram.SYMBOLS - len(raw[1])) * p(h + "\u1234"), 1, rel_tol=1e-9)
    spelling = ngram.Spelling(*ngram.spelling_arrays(model))
    asked = ["the", "thex", "数学", "zq", "naïve", "the", "hath", "ɸ", "!"]
    w = ngram.cut(asked)
    bits = spelling(w, np.arange(len(w.hash)))
    for x, b in zip(asked, bits):
        whole = "\n\n\n" + x + " "
        assert math.isclose(b, -sum(math.log2(p(whole[i : i + 4])) for i in range(len(whole) - 3)), rel_tol=1e-5), x
    assert len(spelling(w, np.empty(0, dtype=np.int64))) == 0


@pytest.mark.parametrize("vocabulary, hot", [(ngram.VOCABULARY, ngram.HOT), (5, 4), (200, 7)])
def test_perplexities_by_brute_force(spark, monkeypatch, vocabulary, hot):
    monkeypatch.setattr(ngram, "VOCABULARY", vocabulary)
    monkeypatch.setattr(ngram, "HOT", hot)
    r = np.random.default_rng(8)
    names = ["alpha", "beta", "Gamma", "δέλτα", "eps", ".", "zeta9", "数学"]
    text = lambda: " ".join(names[int(r.integers(k))] for k in r.integers(1, 9, 25))
    trusted = [text() for _ in range(20)] + ["alone once twice alone"]
    others = [text() for _ in range(5)] + ["unseen words, alpha beta", "", None, "alone once"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*trusted, *others])], "doc_id long, text string").repartition(3)
    model = ngram.word_model(docs.where(f"doc_id < {len(trusted)}"))
    words = [lm_tokens(t) for t in trusted]
    count, rows = Counter(w for x in words for w in x), Counter(w for x in words for w in set(x))
    held = set(model["small"]["hashes"].tolist())
    known = {w for w in count if ngram.cut([w]).hash[0] in held}
    may = {w for w in count if rows[w] > 1}
    assert len(known) <= vocabulary and (known == may or min(count[w] for w in known) > max(count[w] for w in may - known))
    assert len(known) == len(held) > 0
    cls = lambda w: w if w in known else "<rare>"
    two, two_rows = Counter(), Counter()
    for x in words:
        own = list(zip(["<begin>", *map(cls, x)], map(cls, x)))
        two.update(own)
        two_rows.update(set(own))
    one = Counter((g[1],) for g in two)
    d = ngram.discounts(Counter(one.values()))
    total, spared = sum(one.values()), sum(d[min(c, 3) - 1] for c in one.values())
    first = {g[0]: (c - d[min(c, 3) - 1]) / total + spared / total / (len(known) + 1) for g, c in one.items()}
    spelling = ngram.Spelling(*model["small"]["spelling"])

    def p(a, b):
        lower = first.get(b, spared / total / (len(known) + 1))
        off = ngram.discounts(Counter(two.values()))
        h = sum(c for g, c in two.items() if g[0] == a)
        if not h:
            return lower
        less = lambda c: off[min(c, 3) - 1]
        spent = sum(c - less(c) for g, c in two.items() if g[0] == a and two_rows[g] > 1)
        own = two[a, b] - less(two[a, b]) if two_rows[a, b] > 1 else 0
        return own / h + max(ngram.LEAST, 1 - spent / h) * lower

    for r_ in ngram.perplexities(docs, model, ("doc_id", "text")).collect():
        own = lm_tokens(r_.text)
        bits = 0.0
        for a, b, w in zip(["<begin>", *map(cls, own)], map(cls, own), own):
            bits -= math.log2(p(a, b))
            if b == "<rare>":
                cut = ngram.cut([w])
                bits += spelling(cut, np.array([0]))[0]
        assert r_.n_symbols == sum(len(w) + 1 for w in own)
        assert (r_.bits is None) == (not own) and (not own or math.isclose(r_.bits, bits / r_.n_symbols, rel_tol=1e-4))


def test_asked_pairs_move_packed(spark, monkeypatch):
    r = np.random.default_rng(5)
    n, buckets = 40_000, 11
    gram = r.integers(1 << 18, size=n) << ngram.SHIFT | r.integers(1 << 18, size=n)
    row, times = r.integers(500, size=n), np.where(r.random(n) < 0.02, 2, 1)
    lists = ngram.packed(gram, row, times, buckets)
    got = [ngram.unpacked(x["bucket"], x["n"], x["packed"], buckets) for x in lists]
    assert sorted(zip(*(np.concatenate(c).tolist() for c in zip(*got)))) == sorted(zip(gram.tolist(), row.tolist(), times.tolist()))
    assert sum(len(x["packed"]) for x in lists) < 5 * n  # a row of a shuffle takes 11 bytes or so
    assert ngram.packed(gram[:0], row[:0], times[:0], 1) == []
    # a small bucket: a batch asks each once, however many pairs its documents have, and the sums stay
    monkeypatch.setattr(ngram, "HOT", 20)
    texts = [" ".join(f"w{int(k)}" for k in r.zipf(1.3, 60) % 90) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    model, join, lists = ngram.word_model(docs), ngram.joined_gains, []
    monkeypatch.setattr(ngram, "joined_gains", lambda asked, gains, buckets: lists.append((asked.count(), asked.agg({"n": "sum"}).first()[0], buckets)) or join(asked, gains, buckets))
    of = lambda: {x.doc_id: x.bits for x in ngram.perplexities(docs, model).collect()}
    whole = of()
    monkeypatch.setattr(ngram, "BUCKET", 40)
    assert of() == pytest.approx(whole, rel=1e-12)
    assert lists[0][0] == 2 and lists[0][2] == 1 and lists[1][2] > 3 and lists[1][0] <= 2 * lists[1][2] < lists[1][1] == lists[0][1]


def test_a_counting_task_holds_different_words_alone(spark, monkeypatch):
    """What a task takes doesn't grow with the words that it has read since it last passed on its counts."""
    r = np.random.default_rng(4)
    names = np.array([f"word{k}" for k in range(3000)])
    texts = [" ".join(names[r.zipf(1.2, 2000) % 3000]) for _ in range(60)]
    batch, repeats = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]), 15
    df, runs = spark.createDataFrame([("a",)], "text string"), []
    mapped = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: runs.append(f) or mapped(self, f, schema))
    ngram.word_counts(df)
    ngram.pair_counts(df, SimpleNamespace(value=np.unique(ngram.cut([" ".join(names)]).hash)))
    for run, n in zip(runs, (1, 2)):
        list(run(iter([batch])))  # the tables that a worker keeps
        whole, peak, all_texts = Counter(), [], [lm_tokens(t) for t in texts]
        for times in (2, repeats):
            tracemalloc.start()
            got = list(run(iter([batch] * times)))
            peak.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
        assert peak[1] < (1.6 * peak[0] if n == 1 else 60_000_000), peak
        for b in got:
            for key, c, rows in zip(*(x.to_pylist() for x in b.columns)):
                whole[key] += c
                assert rows <= c
        if n == 1:
            assert whole == Counter({w: c * repeats for w, c in Counter(w for t in all_texts for w in t).items()})
        else:
            assert sum(whole.values()) == repeats * sum(map(len, all_texts))


@pytest.mark.parametrize("segment", [1, 50, 1 << 20])
def test_word_hashes_do_not_hang_on_segments(monkeypatch, segment):
    texts = ["The quick, brown fox.", None, "x" * 300, "数学 naïve " * 40, "a"]
    whole = words.cut(texts)
    monkeypatch.setattr(words, "SEGMENT", segment)
    assert np.array_equal(words.cut(texts).hash, whole.hash)
    at = np.array([6, 0, 3])
    assert [whole.only(at).spelled(k) for k in range(3)] == [whole.spelled(k) for k in at]
    assert not len(whole.only(at[:0]).cp)


def test_a_scorer_is_shipped_as_its_tables():
    r = np.random.default_rng(3)
    keys = np.unique(r.integers(1 << 40, size=50_000))
    small = {"hashes": ngram.cut(["a b c"]).hash, "bits": np.ones(4, dtype=np.float32), "share": np.ones(5, dtype=np.float32), "spelling": (keys[:9].astype(np.uint64), np.ones(9, dtype=np.float32)),
             "hot": keys, "gain": r.random(len(keys)).astype(np.float32), "cold": np.zeros(ngram.CELLS // 64 + 1, dtype=np.int64)}
    built = ngram.Scorer(small)
    shipped = pickle.loads(pickle.dumps(built))
    assert not hasattr(shipped.hot, "order") and not hasattr(shipped.hot, "at")
    asked = r.integers(1 << 40, size=1000).astype(np.uint64)
    assert np.array_equal(shipped.hot.find_all(asked), built.hot.find_all(asked)) and shipped.hot.find(int(keys[7])) == built.hot.find(int(keys[7])) >= 0
    texts = ["a b rare c", None, "", "c c a"]
    for x, y in zip(shipped(texts)[:2], built(texts)[:2]):
        assert np.array_equal(x, y)


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(i, t, None, 1) for i, t in ODD], "doc_id long, text string, lang string, bits int")
    labels = spark.createDataFrame([(5, 1), (None, 1), (4, 0), (3, None)], "doc_id long, quality int")
    got = ngram.quality(docs, labels).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[5].kept and not by[1].kept and not by[2].kept and by[2].perplexity is None and not by[4].kept
    uniform = ngram.quality(docs, labels.limit(0)).collect()
    assert all(r.bits is None or math.isclose(r.bits, math.log2(ngram.SYMBOLS), rel_tol=1e-5) for r in uniform)
    assert ngram.quality(docs.limit(0), labels).count() == 0


def test_quality_keeps_trusted_texts(spark):
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    got = registry.queries()["op6_quality_ngram"](spark, SF).collect()
    kept = [r.kept for r in got if r.doc_id in good]
    other = [r.kept for r in got if r.doc_id not in good]
    print("quality kept", np.mean(kept), np.mean(other))
    assert np.mean(kept) >= 0.95


def test_quality_tells_labelled_junk_by_language(spark):
    labels = defaultdict(set)
    for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").collect():
        labels[r.doc_id].add(r.quality)
    by = defaultdict(list)
    for r in registry.queries()["op6_quality_ngram"](spark, SF).collect():
        if len(labels[r.doc_id]) == 1:
            by[r.lang, *labels[r.doc_id]].append(r.kept)
    langs = {lang for lang, _ in by}
    assert len(langs) >= 4
    for lang in langs:
        assert np.mean(by[lang, 1]) >= 0.98 and np.mean(by[lang, 0]) <= 0.3, lang


def test_quality_sees_the_order_of_words(spark):
    r = np.random.default_rng(7)
    chain = [[(5 * w + k) % 60 for k in (1, 2, 3)] for w in range(60)]

    def text(n=60):
        own = [int(r.integers(60))]
        while len(own) < n:
            own.append(chain[own[-1]][int(r.integers(3))])
        return [f"word{chr(97 + w // 8)}{chr(97 + w % 8)}" for w in own]

    good, more = [text() for _ in range(150)], [text() for _ in range(40)]
    shuffled = [list(r.permutation(x)) for x in more]
    texts = [*good, *more, *shuffled]
    docs = spark.createDataFrame([(i, " ".join(x), "en") for i, x in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(150)], "doc_id long, quality int")
    by = {x.doc_id: x for x in ngram.quality(docs, labels).collect()}
    assert sorted(by) == list(range(len(texts)))
    assert np.mean([by[i].kept for i in range(150, 190)]) > 0.9
    assert not any(by[i].kept for i in range(190, 230))
