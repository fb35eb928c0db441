"""Edge rows (no driver, no time, broken JSON, missing numbers) through the whole chain of operators and reports."""

from __future__ import annotations

import json

import pytest

from conftest import event_row
from roadlens import config as C
from roadlens.operators import events as E
from roadlens.operators import pricing as P
from roadlens.operators import reports as R
from roadlens.operators import rolling as RL
from roadlens.operators import windows as W


def _messages():
    good = [event_row(event_id=f"g{i}", driver_id=f"D{i % 3}", event_time=f"2026-01-01T00:0{i % 5}:10.000Z", speed_kmh=40.0 + 3 * i) for i in range(30)]
    odd = [
        event_row(event_id="no-driver", driver_id=None),
        event_row(event_id="no-time", event_time=None),
        event_row(event_id="bad-time", event_time="yesterday"),
        event_row(event_id="no-speed", speed_kmh=None),
        event_row(event_id="no-km", distance_delta_km=None),
        {"event_id": "bare"},
    ]
    return [json.dumps(e) for e in good + odd] + ["{broken", "", None, "[]", "42"]


@pytest.fixture(scope="module")
def flagged(spark):
    raw = spark.createDataFrame([(None, m) for m in _messages()], "key string, value string")
    return E.flag_events(E.parse_events(raw)).cache()


def test_event_operators_take_edge_rows(flagged):
    n = len(_messages())
    assert flagged.count() == n
    assert E.build_alert_rows(flagged).filter("event_id IS NULL").count() == 0
    assert all(r["decision_type"] for r in E.build_event_decision_rows(flagged, "stream").collect())
    windows = W.tumbling_features(flagged).collect()
    assert all(r["window_start"] is not None for r in windows) and sum(r["event_count"] for r in windows) < n


def test_reports_rank_only_known_drivers(spark, flagged):
    features = W.tumbling_features(flagged, keys=("driver_id", "driver_profile"))
    labelled = P.impute_claims(P.prepare_features(features))
    assert labelled.filter("driver_id IS NULL").count() > 0  # the edge rows do reach the reports
    predicted = P.predict(labelled, C.COMMITTED_COEFFICIENTS)
    for report in (R.top_speeding(labelled), R.top_risk(labelled), R.top_frequency(predicted)):
        rows = report.collect()
        assert rows and all(r["driver_id"] is not None for r in rows)
    assert R.risk_proxy(labelled).count() > 0 and R.profile_summary(labelled).count() >= 1
    run = P.premium_run(features, C.COMMITTED_COEFFICIENTS, scored_at="2026-01-01T00:00:00+00:00")
    assert run.filter("driver_id IS NULL").count() == 0 and run.count() == 3 + run.filter("driver_id NOT IN ('D0', 'D1', 'D2')").count()
    assert R.top_premiums(run).count() == run.count() and R.top_latest(run).count() <= 15
    train, test = P.split(labelled)
    assert train.count() + test.count() == labelled.count()


def test_count_windows_take_events_without_a_driver(flagged):
    numbered = RL.with_sequence(flagged, "event_time_ts", "event_id")
    rows = RL.rolling_features(numbered, 12, chunk_size=4).collect()
    assert len(rows) == flagged.count() and sorted(r["event_no"] for r in rows) == list(range(1, len(rows) + 1))
    assert RL.demo_decisions(numbered, chunk_size=4).filter("at_event IS NULL").count() == 0
