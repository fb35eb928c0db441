"""Kneser-Ney: probabilities against a plain version, normalisation, shards, decisions, edge cases."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from roadlens.llm import kneser_ney as K

N = K.ORDER


def tokens(text):
    return [0] * (N - 1) + [b + 1 for b in text]


class Plain:
    """Interpolated modified Kneser-Ney from its textbook formulas."""

    def __init__(self, texts):
        top = Counter(tuple(t[i : i + N]) for t in map(tokens, texts) for i in range(len(t) - N + 1))
        self.c = {N: top}
        for k in range(N - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d, self.h = {}, {}
        for k, counts in self.c.items():
            n = [sum(v == i for v in counts.values()) for i in range(1, 5)]
            y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
            self.d[k] = [max(0.05 * (i + 1), (i + 1) - (i + 2) * y * n[i + 1] / n[i]) if n[i] and n[i + 1] else 0.5 * (i + 1) for i in range(3)]
            self.h[k] = defaultdict(lambda: [0, 0, 0, 0])
            for g, v in counts.items():
                self.h[k][g[:-1]][0] += v
                self.h[k][g[:-1]][min(v, 3)] += 1

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / K.VOCABULARY
        low = self.p(gram[1:])
        if gram[:-1] not in self.h[k]:
            return low
        total, *t = self.h[k][gram[:-1]]
        v, d = self.c[k].get(gram, 0), self.d[k]
        return (max(v - d[min(v, 3) - 1], 0.0) if v else 0.0) / total + sum(a * b for a, b in zip(d, t)) / total * low

    def log(self, text):
        t = tokens(text)
        return sum(math.log(self.p(tuple(t[i : i + N]))) for i in range(len(t) - N + 1))


def corpora():
    rng = random.Random(6)
    word = lambda: rng.choice(["the", "river", "rose", "über", "night", "a", "road", "was", "und"])
    return [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(80)]


@pytest.fixture(scope="module")
def model(spark):
    texts = corpora()
    asked = texts[:20] + ["zebra", "the riv", "é", "xyz the road", "a" * 50]
    trusted = spark.createDataFrame([("en", t.encode()) for t in texts], "lang string, text binary")
    rows = [(i, "en", t.encode()) for i, t in enumerate(asked)] + [(90, "xx", b"no model"), (91, "en", None), (92, "en", b""), (None, "en", b"road"), (93, "en", b"road"), (93, "en", b"road")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text binary").repartition(3)
    return Plain([t.encode() for t in texts]), rows, docs, K.log_probabilities(trusted.repartition(4), docs.select("lang", "text"))


def test_probabilities_match_the_formulas(model):
    plain, _, _, logs = model
    for r in logs.collect():
        gram = tuple(r.gram >> (9 * i) & 511 for i in range(N - 1, -1, -1))
        assert r.lang == "en" and math.isclose(math.exp(r.logp), plain.p(gram), rel_tol=1e-5)


def test_each_context_sums_to_one(model):
    plain = model[0]
    for context in [(0,) * (N - 1), tuple(b + 1 for b in b"the "), tuple(b + 1 for b in b"zzzz")]:
        assert math.isclose(sum(plain.p((*context, w)) for w in range(1, 257)) + plain.p((*context, 0)), 1.0, abs_tol=2e-2)


def test_scores_match_the_formulas_for_any_batch_size(model):
    plain, rows, docs, logs = model
    want = sorted((str(i), len(t or b""), plain.log(t or b"") if lang == "en" else 0.0) for i, lang, t in rows)
    for options in ({}, {"batch_bytes": 300}, {"batch_bytes": 20}):
        got = sorted((str(r.doc_id), r.n_bytes, r.log_sum) for r in K.text_scores(docs.withColumn("unseen", F.lit(False)), logs, **options).collect())
        assert [w[:2] for w in want] == [g[:2] for g in got] and all(math.isclose(a[2], b[2], abs_tol=1e-2) for a, b in zip(want, got))


def test_long_texts_are_cut_into_pieces_without_loss(monkeypatch):
    text = "".join(corpora()).encode()
    whole = [g for piece in K.pieces([text, b"ab", None, b""]) for g in K.grams(piece).tolist()]
    monkeypatch.setattr(K, "PIECE_BYTES", 7)
    parts = list(K.pieces([text, b"ab", None, b""]))
    assert all(sum(len(b) for _, _, b in p) <= 7 for p in parts)
    assert [g for piece in parts for g in K.grams(piece).tolist()] == whole


def test_decisions(spark):
    rng = random.Random(8)
    good = corpora() * 3
    docs = [(i, t, "en") for i, t in enumerate(good)] + [(1000 + i, "".join(chr(rng.randrange(33, 90)) for _ in range(80)), "en") for i in range(20)]
    docs += [(2000, None, "en"), (2001, "", None), (2002, "geen model", "nl"), (None, good[0], "en")]
    labels = [(i, 1, 0) for i in range(len(good))] + [(1000, 0, 0), (1001, None, 0), (1002, 1, 1), (1003, 1, None), (1003, 0, None), (None, 1, 0)]
    d = spark.createDataFrame([(*r, 1.0) for r in docs], "doc_id long, text string, lang string, perplexity double")
    out = K.classify(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(docs) and out.columns == ["doc_id", "lang", "perplexity", "low", "high", "kept"]
    assert sum(rows[i].kept for i in range(len(good))) > 0.9 * len(good)
    assert not any(rows[1000 + i].kept for i in range(20))
    assert not rows[2000].kept and not rows[2001].kept and rows[2001].lang == "und" and rows[2002].kept and rows[2002].perplexity is None


def brute_bounds(reference):
    """Bounds from sorted lists: the smallest value whose rank reaches the quantile; the best balanced accuracy, ties to the highest."""
    at = lambda values, q: values[max(0, math.ceil(q * len(values)) - 1)]
    out = {}
    for lang in {lang for lang, _, fine, unseen in reference if fine and unseen}:
        fine = sorted(p for own, p, f, unseen in reference if own == lang and f and unseen)
        bad = [p for own, p, f, unseen in reference if own == lang and not f and unseen]
        low = at(sorted(p for own, p, f, _ in reference if own == lang and f), K.LOW_QUANTILE)
        highs = [at(fine, q) for q in K.HIGH_QUANTILES]
        if bad:
            rate = lambda h: sum(low <= p <= h for p in fine) / len(fine) + sum(not low <= p <= h for p in bad) / len(bad)
            out[lang] = (low, max((round(rate(h), 12), h) for h in highs)[1])
        else:
            out[lang] = (low, at(fine, K.HIGH_QUANTILE))
    return out


def test_bounds_and_decisions_match_brute_force(spark):
    rng = random.Random(11)
    docs, labels = [], []
    for i, t in enumerate(corpora() * 4):
        text = t + " " + rng.choice(["a", "B", "c"]) * rng.randrange(1, 9)
        docs.append((i, text, rng.choice(["en", "de"])))
        labels.append((i, 1, 0))
    for i in range(1000, 1060):
        docs.append((i, "".join(chr(rng.randrange(33, 110)) for _ in range(60)), "en"))
        labels.append((i, 0, 0))
    docs += [(2000 + i, docs[i][1].translate({c: c - 32 for c in range(97, 123)}), docs[i][2]) for i in range(40)]  # copies but for letter case: on the side of their text
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in K.classify(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    lowered = lambda t: t.translate({c: c + 32 for c in range(65, 91)}).encode()
    unseen = {i: np.int64(np.uint64(xxhash.xxh64_intdigest(lowered(t), 42))) % K.BOUND_FOLDS == 0 for i, t, _ in docs}
    assert all(unseen[2000 + i] == unseen[docs[i][0]] for i in range(40))
    marks = {i: q == 1 for i, q, _ in labels}
    reference = [(lang, rows[i].perplexity, marks[i], unseen[i]) for i, _, lang in docs if i in marks]
    bounds = brute_bounds(reference)
    assert set(bounds) == {"en", "de"}
    for i, _, lang in docs:
        r, (low, high) = rows[i], bounds[lang]
        assert (r.low, r.high) == (low, high) and r.kept == (low <= r.perplexity <= high)
    assert any(not r.kept for r in rows.values())


def test_rows_that_repeat_everything_are_dealt_out(spark):
    same = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("en").alias("lang"), F.lit(False).alias("unseen"), F.lit(b"x" * 100).alias("text"))
    logs = spark.createDataFrame([], "lang string, gram long, logp double")
    plan = K.text_scores(same.repartition(4), logs, batch_bytes=1000)
    assert plan.count() == 10_000
    assert K.dealt_rows(same.repartition(4), 1000).select("batch").distinct().count() > 900


def test_empty_tables(spark):
    d, l = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.perplexity, r.kept) for r in K.classify(d, l).collect()] == [(None, True)]
    assert K.classify(d.limit(0), l).collect() == []


def test_labelled_documents_choose_the_upper_bound(spark):
    """Odd good documents in the tail do not open the bound to documents labelled bad; both error rates are measured."""
    rows = [("en", 4 + i / 1000, True) for i in range(970)] + [("en", 8.0, True)] * 30 + [("en", 6.0, False)] * 45 + [("en", 9.0, False)] * 5
    rows += [("de", 4 + i / 1000, True) for i in range(1000)] + [("fr", 9.0, False)]
    reference = spark.createDataFrame(rows, "lang string, perplexity double, fine boolean").withColumn("unseen", F.lit(True))
    trained = reference.limit(0).union(spark.createDataFrame([("en", 2 + i / 1000, True, False) for i in range(1000)], "lang string, perplexity double, fine boolean, unseen boolean"))
    got = {r.lang: r for r in K.bounds_of(reference.union(trained)).collect()}
    assert got["en"].low < 2.01  # texts that the model was trained on are not below the bound
    assert set(got) == {"en", "de"} and got["de"].high == pytest.approx(4.99, abs=0.002)
    lost = sum(f and not got["en"].low <= p <= got["en"].high for lang, p, f in rows if lang == "en") / 1000
    kept = sum(not f and got["en"].low <= p <= got["en"].high for lang, p, f in rows if lang == "en") / 50
    assert kept == 0 and lost <= 0.035
    fixed = K.bounds_of(reference, highs=(0.99,)).filter("lang = 'en'").first()
    assert fixed.high == 8.0  # the fixed quantile keeps 45 of 50
