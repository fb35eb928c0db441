"""Packing against an exhaustive search for the boundaries, and the shape of the batches."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F
from roadlens.llm import packing as P


def padding(lengths, rows, uppers):
    return sum(n * (min(u for u in uppers if u >= x) - x) for x, n in zip(lengths, rows))


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(60):
        lengths = sorted(rng.sample(range(0, 300), rng.randrange(1, 9)))
        rows = [rng.randrange(1, 50) for _ in lengths]
        k = rng.randrange(1, 5)
        got = P.boundaries(np.array(lengths), np.array(rows), k)
        best = min(padding(lengths, rows, [*c, lengths[-1]]) for j in range(min(k, len(lengths))) for c in combinations(lengths[:-1], j))
        assert got[-1] == lengths[-1] and len(got) <= k and padding(lengths, rows, got) == best
    assert P.boundaries(np.array([]), np.array([]), 3) == []


def check(rows, budget):
    by_bucket = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.bucket_tokens
        by_bucket[r.bucket, r.bucket_tokens].append(r)
    for (_, tokens), members in by_bucket.items():
        capacity = max(1, budget // max(1, tokens))
        places = sorted(r.batch * capacity + r.slot for r in members)
        assert places == list(range(len(members))) and all(0 <= r.slot < capacity for r in members)
        ids = [r.doc_id for r in sorted(members, key=lambda r: (r.batch, r.slot)) if r.doc_id is not None]
        assert ids == sorted(ids)


def test_pack_places_every_row_once(spark):
    rng = random.Random(2)
    docs = [(i, "word " * rng.choice([0, 1, 2, 7, 30, 31, 400, 1500])) for i in range(500)]
    docs += [(None, "a b"), (None, None), (3, "a b c"), (3, "a b c"), (900, "x " * 20_000)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, bucket int").repartition(6)
    rows = P.pack(df, buckets=5, token_budget=2000).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == sorted((str(i), len((t or "").split())) for i, t in docs)
    assert len({r.bucket for r in rows}) <= 5
    check(rows, 2000)


def test_token_counts_can_come_from_a_column(spark):
    df = spark.createDataFrame([(i, None, i % 3) for i in range(9)], "doc_id long, text string, tokens int")
    rows = P.pack(df, buckets=3, token_budget=4, length=F.col("tokens")).collect()
    assert {r.bucket_tokens for r in rows} == {0, 1, 2}
    check(rows, 4)


def slow_boundaries(lengths, rows, buckets):
    """The plain dynamic programme over all cuts; the smallest cut of equal ones."""
    total = [0]
    for n in rows:
        total.append(total[-1] + n)
    m = len(lengths)
    least = [(0, 0)] + [(total[j] * lengths[j - 1], 0) for j in range(1, m + 1)]
    cuts = [least]
    for k in range(2, min(buckets, m) + 1):
        nxt = [(0, 0)] * k + [min((cuts[-1][i][0] + (total[j] - total[i]) * lengths[j - 1], i) for i in range(k - 1, j)) for j in range(k, m + 1)]
        cuts.append(nxt)
    out, j = [], m
    for cut in reversed(cuts):
        out.append(lengths[j - 1])
        j = cut[j][1]
    return out[::-1]


def test_divide_and_conquer_finds_the_cuts_of_the_plain_programme():
    rng = random.Random(7)
    for _ in range(80):
        lengths = sorted(rng.sample(range(0, 5000), rng.randrange(1, 120)))
        rows = [rng.choice([1, 1, 2, 500]) for _ in lengths]
        k = rng.randrange(1, 12)
        assert P.boundaries(np.array(lengths), np.array(rows), k) == slow_boundaries(lengths, rows, k)


def test_boundaries_of_very_many_lengths():
    lengths = np.arange(1, 200_001) * 3
    rows = np.random.default_rng(1).integers(1, 1000, len(lengths))
    uppers = P.boundaries(lengths, rows, 8)
    assert len(uppers) == 8 and uppers == sorted(set(uppers)) and uppers[-1] == 600_000


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
