"""The prefix trie against plain dictionaries of openings."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from roadlens.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()


def rebuild(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, digest(r, x), r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = abs(c) // 100 * 100 * (-1 if c < 0 else 1)
        out[c] = own.get(family, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(cs) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), kids.get(node, 0), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows):
    return sorted(map(tuple, T.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)


def conversations(seed=5):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 260, 3), 500, 501, 777, -5, -150]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 20])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "é𝄞", "a longer answer"])))
    rows += [(3, None, "user", "no turn"), (6, 2, "user", "same turn"), (6, 2, "user", "same turn"), (None, 0, "user", "no conversation")]
    rng.shuffle(rows)
    return rows


def test_nodes_match_plain_dictionaries(spark):
    rows = conversations()
    assert result(spark, rows) == brute(rebuild(rows))


def test_deep_conversations_cross_many_bands(spark):
    deep = [(c, t, "user", f"t{t % 7}") for c, n in ((100, 700), (105, 300), (130, 17), (200, 16), (201, 33)) for t in range(n)]
    assert max(t for _, t, _, _ in deep) > 2 * T.BAND**2
    assert result(spark, deep) == brute(rebuild(deep))


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 2 * T.BAND)
    rows = [(c, t, "user", f"t{t % 3}") for c in (100, 101, 250) for t in range(90)]
    assert result(spark, rows) == brute(rebuild(rows))


def test_many_equal_conversations_end_at_one_node(spark):
    rows = [(c, 0, "user", "hello") for c in range(700)]
    got = result(spark, rows)
    assert got == brute(rebuild(rows))
    assert max(r[3] for r in got if r[1] == 1) == 700 - sum(not t for t in rebuild(rows).values())


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    rows = [(c, 0, "user", "gone")]
    assert result(spark, rows) == brute(rebuild(rows)) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


@pytest.mark.parametrize("extra", [False, True])
def test_empty_table_and_other_columns(spark, extra):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.conversation_trie(empty).collect() == []
    rows = conversations(6)
    wide = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit("x"), "digest": F.lit(1), "place": F.lit(None)}) if extra else spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, T.conversation_trie(wide).collect()), key=repr) == brute(rebuild(rows))


def test_a_very_long_turn_counts_its_code_points(spark):
    rows = [(100, 0, "user", "é" * 3_000_000), (100, 1, "user", None), (101, 0, "user", "é" * 3_000_000)]
    assert result(spark, rows) == brute(rebuild(rows))
