"""SimHash near-dedup against brute force over all pairs."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
import xxhash
from roadlens.llm import components as C
from roadlens.llm import simhash as S
from roadlens.llm.common import write_table
from roadlens.llm.components import connected_components

SCHEMA = "doc_id long, text string"


def slow_fingerprint(text, k=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(keys, near):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(keys)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in keys}


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "ß x", "Ünï"]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 30, 300])))))
    for i in range(120, 260):  # near copies of one long text, by one changed word
        words = rows[5][1].split() * 3 if len(rows[5][1].split()) > 40 else ("base text of many words " * 80).split()
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(300, ""), (301, None), (302, " \t\n"), (303, "W1\tw2"), (304, "w1  W2"), (None, "w1 w2"), (305, "a b c"), (305, "a b c"), (306, "a b")]
    return rows


def test_fingerprint_matches_the_definition():
    for _, t in corpus() + [(0, "x " * 5000), (0, "one"), (0, "A b C d")]:
        assert S.fingerprint(None if t is None else t.encode(), 3) == slow_fingerprint(t)
    hashes = np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64)
    assert S.majority(S.ones(hashes), 1000) == sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > 1000)


def test_near_duplicates_match_brute_force(spark):
    rows = corpus()
    got = S.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    fps = [slow_fingerprint(t) for _, t in rows]
    roots = slow_components(set(fps), lambda a, b: (a ^ b).bit_count() <= 2)
    low = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            low[roots[f]] = min(low.get(roots[f], i), i)
    want = sorted((str(i), f"{f:016x}", low.get(roots[f])) for (i, _), f in zip(rows, fps))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert len(set(low.values())) < len(set(fps))


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_crowded_blocks_join_the_same_nodes(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(4)]
    words = set(base)
    for b in base:
        for _ in range(60):
            w = b
            for _ in range(rng.randrange(4)):
                w ^= 1 << rng.randrange(64)
            words.add(w)
    signed = [(w - 2**64 if w >= 2**63 else w,) for w in words]
    nodes = spark.createDataFrame(signed, "fp long")
    want = slow_components([w for (w,) in signed], lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= distance)
    for block_rows in (1, 8, 10_000):
        found = {r.node: r.root for r in connected_components(S.links(nodes, distance, block_rows)).collect()}
        assert {w: found.get(w, w) for (w,) in signed} == want


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 299), (299, 300)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(60)}, 299: 299, 300: 299}


def test_near_deduplicate_keeps_the_smallest_row(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, i, "k") for i, r in enumerate(rows)], SCHEMA + ", fp int, first string")
    got = S.near_deduplicate(df)
    assert got.columns == df.columns
    labels = S.near_duplicates(df).collect()
    want = sorted({str(r.component_id) for r in labels})
    ids = [str(r.doc_id) for r in got.collect()]
    assert len(ids) == len({r.component_id for r in labels}) and sorted(ids) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.near_duplicates(df).collect() == [] and S.near_deduplicate(df).collect() == []


def test_a_node_with_very_many_neighbours_is_split(spark):
    """The join of a step, on written tables, with half of all edges at one node: the adaptive plan splits it."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    hub = spark.range(1, 60_000).selectExpr("id AS a", "CAST(0 AS BIGINT) AS b")
    links = write_table(hub.union(spark.range(100_000, 160_000).selectExpr("id * 2 + 1 AS a", "id * 2 AS b")).repartition(8), "hub")
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        pairs = C.both_ways(links)
        met = C.moved(pairs, write_table(C.smallest(pairs), "low"))
        assert len(met.collect()) == 2 * 119_999
        assert "skew=true" in met._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in small:
            spark.conf.unset(k)


def test_pieces_do_not_change_a_fingerprint(monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a", "bb", "Ünï", "ccc\t", "\n"]) for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 3000)]
    want = [slow_fingerprint(t) for t in texts]
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(S, "PIECE_BYTES", size)
        assert [S.fingerprint(t.encode(), 3) for t in texts] == want


def test_a_very_long_text_takes_little_memory():
    text = b"some words that are not the same everywhere 123 " * 400_000
    tracemalloc.start()
    assert S.fingerprint(text, 3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 3 * len(text)
