"""The driver contract: entry, registered queries and their SQL oracles (checked at sf0.001)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from conftest import SF001

TABLES = ["events"]
FAST = [
    "risk_flags", "features_tumbling_1m", "features_sliding_5m", "event_decisions", "window_decisions",
    "rolling_tick_decisions", "premium_cap", "glm_test_predictions", "union_decisions",
]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "window_start" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def _canon(v):
    if isinstance(v, float):
        return repr(v) if not math.isnan(v) else "NULL"
    return "NULL" if v is None else str(v)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    sdf = entry_mod.queries()[name](spark, SF001)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    rel = con.execute(entry_mod.oracle_sql()[name])
    d_cols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(d_cols)
    order = sorted(sdf.columns)
    s_rows = sorted("|".join(_canon(r[c]) for c in order) for r in sdf.collect())
    d_rows = sorted("|".join(_canon(row[d_cols.index(c)]) for c in order) for row in rel.fetchall())
    assert s_rows == d_rows
