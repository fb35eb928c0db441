"""The Merkle manifest against plain hashing of whole trees."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from roadlens.llm import merkle as M
from roadlens.llm import sha_midstate as S

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def mark(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return h(*map(mark, (row[0], row[1], row[2], row[3], text)))


def climb(nodes):
    """Root, and each leaf's [(left siblings, right siblings)] level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            lo = a // 3 * 3
            paths[i].append((nodes[lo:a], nodes[a + 1 : lo + 3]))
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        at = [a // 3 for a in at]
    return nodes[0], paths


def brute(rows, claim):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), leaf(r, claim(r)), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(groups[s], key=lambda x: x[:4])]) for s in names}
    root, outer = climb([trees[s][0] for s in names])
    out = []
    for s, over in zip(names, outer):
        for x, path in zip(sorted(groups[s], key=lambda x: x[:4]), trees[s][1]):
            folded, proof = x[3], []
            for left, right in path + over:
                folded = h(*left, folded, *right)
                proof += left + right
            out.append((x[4][0], x[2], trees[s][0], root, h(*proof), folded, folded == root))
    return sorted(out, key=repr)


def rows_of(n, sources, seed=4):
    rng = random.Random(seed)
    rows = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i, -5]), rng.choice([None, "", "a\nb", "ü\n\n", "plain"])) for i in range(n)]
    return rows + rows[:5] + [(None, "src1", None, None, None), (None, None, "", 0, "x\n"), (7, "", "en", 1, "empty name")]


def without_newlines(r):
    return None if r[4] is None else r[4].replace("\n", "")


@pytest.mark.parametrize("n, band", [(0, 2), (1, 2), (27, 1), (400, 2), (400, 7)])
def test_manifest_matches_plain_trees(spark, n, band):
    rows = rows_of(n, ["src1"] * 6 + ["src2", "src10", None, "é"])
    got = M.document_manifest(spark.createDataFrame(rows, SCHEMA), F.replace("text", F.lit("\n"), F.lit("")), band)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, without_newlines)


def test_one_leaf_is_its_root(spark):
    row = (3, "only", None, None, "t")
    (got,) = M.document_manifest(spark.createDataFrame([row], SCHEMA)).collect()
    assert got.leaf == got.subroot == got.root == got.folded_root == leaf(row, "t") and got.verified
    assert got.proof_sha256 == hashlib.sha256(b"").hexdigest()


def test_untouched_rows_verify_and_other_columns_are_ignored(spark):
    rows = rows_of(60, ["a", "b"])
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"tree": F.lit(1), "rank": F.lit(2), "leaf": F.lit("x")})
    got = M.document_manifest(docs).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)


def test_empty_table_gives_no_rows(spark):
    got = M.document_manifest(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and "verified" in got.columns


def test_a_very_long_text_is_a_leaf(spark):
    docs = spark.range(2).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).cast("long").alias("n_chars"), F.repeat(F.lit("long\n"), 1_000_000).alias("text"))
    got = {r.doc_id: r.leaf for r in M.document_manifest(docs).collect()}
    assert got[1] == leaf((1, "s", "en", 1), "long\n" * 1_000_000)


def test_states_resume_where_they_were_kept():
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(40)]
    words = S.to_words(digests)
    first = S.advance(S.start(40), S.digits(words))
    both = S.finish(S.advance(S.to_words(S.to_bytes(first)), S.digits(words[:, ::-1])), np.full(40, 2))
    assert S.to_bytes(both) == [hashlib.sha256((a.hex() + b.hex()).encode()).digest() for a, b in zip(digests, digests[::-1])]
