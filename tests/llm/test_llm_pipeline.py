"""The pipeline against brute force, and the registered queries against their SQL."""

from __future__ import annotations

import math
import zlib

import __spark_entry__ as entry
import corpus_pipeline as C
import duckdb
import pytest
from conftest import SF001
from roadlens.llm import queries as Q
from roadlens.llm.langid import MIN_SHARE
from test_llm_decontaminate import brute
from test_llm_langid import brute as brute_languages
from test_llm_simhash import slow_components, slow_fingerprint


def brute_pipeline():
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM read_parquet('{SF001}/documents.parquet')").fetchall()
    languages = brute_languages(rows, MIN_SHARE)
    # with so few rows the low quantile of a language is its lowest learning score
    low = {}
    for i, _, lang in rows:
        pred, score = languages[i]
        if lang is not None and zlib.crc32(str(i).encode()) % 5 and score > 0:
            low[pred] = min(score, low.get(pred, 1.0))
    docs = [(i, t) for i, t, _ in rows if languages[i][1] > 0 and languages[i][1] >= low.get(languages[i][0], 0) / 2]
    items = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF001}/benchmark.parquet')").fetchall()
    last = {}
    for i, t in docs:
        key = t.translate({c: c + 32 for c in range(65, 91)})
        last[key] = max(last.get(key, (i, t)), (i, t))
    docs = list(last.values())
    fps = {i: slow_fingerprint(t) for i, t in docs}
    roots = slow_components(set(fps.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    low = {}
    for i, f in fps.items():
        low[roots[f]] = min(low.get(roots[f], i), i)
    docs = [(i, t) for i, t in docs if low[roots[fps[i]]] == i]
    dirty = {r[0] for r in brute(docs, items) if r[5]}
    return {i: len(t.split()) for i, t in docs if str(i) not in dirty}


def test_run_matches_brute_force(spark):
    want = brute_pipeline()
    got = C.run(spark, SF001)
    assert got.columns == ["doc_id", "n_tokens", "bucket", "bucket_tokens", "batch", "slot"]
    assert {r.doc_id: r.n_tokens for r in got.collect()} == want and len(want) < 200


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert len(C.STAGES) == 5
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs.limit(30), SF001).schema == docs.schema
    for _, stage in C.STAGES:
        assert stage(spark, docs.limit(0), SF001).collect() == []


def canon(v):
    return "NULL" if v is None or isinstance(v, float) and math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    df = entry.queries()[name](spark, SF001)
    assert sorted(cols) == sorted(df.columns)
    assert sorted(tuple(canon(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(map(canon, r)) for r in cur.fetchall())


def test_every_operator_is_registered():
    names = list(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
