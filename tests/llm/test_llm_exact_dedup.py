"""Exact dedup against a brute-force version; nulls, repeats, clashing columns, hot groups."""

from __future__ import annotations

import hashlib
from collections import defaultdict

from roadlens.llm import exact_dedup as E

ROWS = [
    (1, "Hello World"), (2, "hello world"), (3, "HELLO WORLD"), (4, "Éa"), (5, "éa"), (6, ""), (7, None), (None, "hello world"),
    (8, "only"), (9, "x" * 200_000), (10, "X" * 200_000), (11, "again"), (11, "again"), (11, "AGAIN"), (12, "aGAIN"), (None, None),
] + [(100 + i, "hot Text" if i % 2 else "HOT text") for i in range(60)]
SCHEMA = "doc_id long, text string"


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[lower(t)] if x is not None]
        out.append((i, max(ids) if ids else None, len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups_match_brute_force(spark):
    got = E.exact_groups(spark.createDataFrame(ROWS, SCHEMA).repartition(5)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == expected(ROWS)
    kept = defaultdict(list)
    for r in got:
        kept[r.text_sha256].append((r.kept, r.doc_id == r.keep_id))
    assert all(sum(k for k, _ in v) == 1 and all(same for k, same in v if k) for v in kept.values())


def test_heavy_split_changes_nothing(spark):
    rows = E.digests(spark.createDataFrame(ROWS, SCHEMA).repartition(3))
    few, many = E.heavy_winners(rows, counters=16, candidates=2), E.heavy_winners(rows)
    assert 1 <= few.count() <= 2 < many.count()
    hot = hashlib.sha256(b"hot text").hexdigest()
    assert few.filter(f"digest = '{hot}'").first().n == 60
    key = lambda df: sorted((r.doc_id or -1, r.digest, r.n, r.winner.doc_id or -1) for r in df.collect())
    assert key(E.assign(rows, few)) == key(E.assign(rows, many)) == key(E.assign(rows, few.limit(0)))


def test_deduplicate_keeps_one_row_of_each_class_with_all_columns(spark):
    schema = SCHEMA + ", digest string, row_no int, winner string, `a.b` int, `row` int"
    df = spark.createDataFrame([(*r, "d", n, "w", n, n) for n, r in enumerate(ROWS)], schema).repartition(4)
    got = E.deduplicate(df)
    assert got.columns == df.columns
    rows = got.collect()
    want = {}
    for i, t in ROWS:
        want[lower(t)] = max(want.get(lower(t), -1), -1 if i is None else i)
    assert sorted((lower(r.text), -1 if r.doc_id is None else r.doc_id) for r in rows) == sorted(want.items())


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert E.exact_groups(df).collect() == [] and E.deduplicate(df).collect() == []
