"""Window aggregates and the window decision rule chain (T10, T11, T13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import event_row
from roadlens.operators import windows as W
from roadlens.operators.events import flag_events


def _decide(spark, **cols):
    base = dict(
        driver_id="D1", event_count=3, km_driven=0.1, avg_speed=50.0, risk_event_count=0, risk_score_5m=0,
        speeding_count=0, hard_braking_count=0, harsh_acceleration_count=0, sharp_cornering_count=0,
        bad_weather_event_count=0, night_event_count=0, phone_usage_count=0, risk_intensity=0.0,
        risk_events_per_100km=0.0,
    )
    base.update(cols)
    df = spark.createDataFrame([base]).withColumns(
        {"window_start": F.current_timestamp(), "window_end": F.current_timestamp()}
    )
    rows = W.build_window_decision_rows(df).collect()
    return rows[0]["decision_type"] if rows else None


def test_escalate_boundaries(spark):
    assert _decide(spark, risk_score_5m=11) is None
    assert _decide(spark, risk_score_5m=12) == "ESCALATE_HIGH_RISK_REVIEW"
    assert _decide(spark, phone_usage_count=2) is None
    assert _decide(spark, phone_usage_count=3) == "ESCALATE_HIGH_RISK_REVIEW"


def test_nudge_boundaries(spark):
    assert _decide(spark, event_count=4, risk_event_count=2, risk_intensity=0.5) is None
    assert _decide(spark, event_count=5, risk_event_count=3, risk_intensity=0.6) == "SEND_SAFETY_NUDGE"
    assert _decide(spark, event_count=20, risk_event_count=9, risk_intensity=0.45) == "SEND_SAFETY_NUDGE"
    assert _decide(spark, event_count=20, risk_event_count=8, risk_intensity=0.4499) is None


def test_points_boundaries(spark):
    assert _decide(spark, event_count=9, km_driven=0.3) is None
    assert _decide(spark, event_count=10, km_driven=0.25) == "GRANT_SAFE_DRIVING_POINTS"
    assert _decide(spark, event_count=10, km_driven=0.2499) is None
    assert _decide(spark, event_count=10, km_driven=0.3, risk_event_count=1, risk_intensity=0.1) is None


def test_first_rule_wins_and_payload_text(spark):
    df = spark.createDataFrame(
        [dict(driver_id="D1", event_count=12, km_driven=0.3, avg_speed=50.0, risk_event_count=6, risk_score_5m=13,
              speeding_count=0, hard_braking_count=0, harsh_acceleration_count=0, sharp_cornering_count=0,
              bad_weather_event_count=0, night_event_count=0, phone_usage_count=1, risk_intensity=0.5,
              risk_events_per_100km=2000.0)]
    ).withColumns({"window_start": F.current_timestamp(), "window_end": F.current_timestamp()})
    r = W.build_window_decision_rows(df).first()
    assert r["decision_type"] == "ESCALATE_HIGH_RISK_REVIEW" and r["priority"] == "high"
    assert r["decision_reason"] == "5-minute window: events=12, risk_events=6, risk_score=13, phone_usage=1"


def test_sliding_windows_count_each_event_five_times(spark, make_events):
    rows = [event_row(event_id=str(i), event_time=f"2026-01-01T00:0{i}:30.000Z") for i in range(3)]
    flagged = flag_events(make_events(rows))
    sliding = W.sliding_features(flagged)
    assert sliding.agg(F.sum("event_count")).first()[0] == 15
    tumbling = W.tumbling_features(flagged)
    assert tumbling.count() == 3 and tumbling.agg(F.sum("event_count")).first()[0] == 3


def test_null_event_time_drops_out_of_windows(spark, make_events):
    flagged = flag_events(make_events([event_row(event_time=None), event_row(event_id="2")]))
    assert W.tumbling_features(flagged).agg(F.sum("event_count")).first()[0] == 1


def test_union_decisions_aligns_columns(spark):
    a = spark.createDataFrame([("event", "D1", "E1")], "decision_source string, driver_id string, event_id string")
    b = spark.createDataFrame([("sliding_window_5m", "D1", 5)], "decision_source string, driver_id string, event_count long")
    u = W.union_decisions(a, b)
    assert set(u.columns) == {"decision_source", "driver_id", "event_id", "event_count"}
    assert u.count() == 2
