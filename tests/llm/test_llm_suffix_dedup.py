"""Removal of repeated byte strings against counting every 400-byte window."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from roadlens.llm import suffix_dedup as D

SCHEMA = "doc_id long, text string"
L = 400


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + L] for t in texts for i in range(len(t) - L + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - L + 1):
            if seen[t[i : i + L]] > 1:
                gone[i] += 1
                gone[min(i + L, len(t))] -= 1
        gone = np.cumsum(gone)[: len(t)] > 0
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def report(spark, rows, **extra):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(extra)
    return sorted(map(tuple, D.repeat_report(docs.repartition(4)).collect()), key=repr)


def corpus(seed=1):
    rng = random.Random(seed)
    fresh = lambda n: "".join(rng.choice("abcdefgh éß\n") for _ in range(n))
    shared, other = fresh(900), fresh(401)
    rows = [(i, fresh(rng.choice([0, 10, 399, 400, 700, 1500]))) for i in range(20)]
    rows += [(30 + i, fresh(rng.randrange(300)) + shared[i * 20 : 900 - i * 10] + fresh(rng.randrange(300))) for i in range(12)]
    rows += [(50, other + fresh(50) + other), (51, fresh(3) + other[:400]), (52, other[1:] + "!"), (53, other[:399])]
    rows += [(60, "For " * 700), (61, "xFor " * 90), (62, "a" * 400), (63, "a" * 401), (64, "a" * 1200), (65, "b" * 400)]
    whole = fresh(2500)
    rows += [(70, whole), (71, whole), (71, whole), (72, whole[:1200] + "?" + whole[1200:]), (73, whole[600:1700])]
    return rows + [(80, None), (81, ""), (None, whole[100:800]), (None, None), (82, "é" * 199), (83, "é" * 200), (84, "é" * 201)]


def test_report_matches_counting_all_windows(spark):
    rows = corpus()
    got = report(spark, rows, core=F.lit(1), text2=F.lit("x"), row_no=F.lit("y"))
    assert got == brute(rows) and 0 < sum(r[2] > 0 for r in got) < len(got)


@pytest.mark.parametrize("crowd, cells", [(1, (16, 1)), (3, (16, 1)), (1, (64, 7, 1)), (2, (1,))])
def test_crowded_cores_are_cut_without_loss(spark, crowd, cells):
    rows = corpus(2)
    docs = spark.createDataFrame(rows, SCHEMA)
    texts, pieces, _ = D.anchored_pieces(docs)
    live = D.live_pieces(pieces)
    bodies = D.piece_texts(docs, texts, live)
    covered = lambda df: {(*r[:3], w) for r in df.collect() for w in range(r[3], r[4] + 1)}
    want = covered(D.repeated_windows(bodies))
    assert want and covered(D.repeated_windows(bodies, crowd, cells)) == want


def test_slices_do_not_change_the_result():
    rng = random.Random(3)
    raw = bytes(rng.randrange(97, 101) for _ in range(3000)) + b"z" * 900
    raw += raw[500:1500]

    def windows(parts):
        pieces, _ = D._pieces_of(parts)
        return Counter(
            raw[s + w : s + w + L] for s, n, k in zip(pieces["start"], pieces["size"], pieces["n"]) for w in range(n - L + 1) for _ in range(k)
        )

    whole = windows([(0, 0, raw)])
    cut = windows([(0, i, raw[i : i + 700 + L - 1]) for i in range(0, len(raw) - L + 1, 700)])
    assert whole == cut == Counter(raw[i : i + L] for i in range(len(raw) - L + 1))


def test_order_of_columns_finds_shared_windows():
    rng = random.Random(4)
    core = "".join(rng.choice("xyz") for _ in range(390)).encode()
    bodies, lead = [], []
    for _ in range(60):
        a, b = rng.randrange(60), rng.randrange(10, 60)
        bodies.append(bytes(rng.choice(b"pq") for _ in range(a)) + core + bytes(rng.choice(b"pq") for _ in range(b)))
        lead.append(a)
    keep = [i for i in range(60) if len(bodies[i]) >= L and bodies[i] not in bodies[:i]]
    bodies, lead = [bodies[i] for i in keep], np.array([lead[i] for i in keep])
    found = D.repeats_among(np.zeros(len(keep), np.int64), lead, bodies, np.ones(len(keep), np.int64))
    seen = Counter((k - w, b[w : w + L]) for b, k in zip(bodies, lead.tolist()) for w in range(len(b) - L + 1))
    for b, k, (first, last) in zip(bodies, lead.tolist(), found):
        want = {w for w in range(len(b) - L + 1) if seen[k - w, b[w : w + L]] > 1}
        assert {w for f, t in zip(first, last) for w in range(f, t + 1)} == want
    assert any(len(f) for f, _ in found)


def test_kept_text_and_very_long_texts(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefghij") for _ in range(D.SLICE + 5000))
    rows = [(1, long), (2, "start " + long[D.SLICE - 300 : D.SLICE + 300] + " end"), (3, None)]
    got = {r.doc_id: bytes(r.kept) for r in D.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (long[: D.SLICE - 300] + long[D.SLICE + 300 :]).encode(), 2: b"start  end", 3: b""}


def test_empty_table(spark):
    assert D.repeat_report(spark.createDataFrame([], SCHEMA)).collect() == []
