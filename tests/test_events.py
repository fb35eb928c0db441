"""Event-level rules: parsing traps (T1, T2), null handling (T5, T6), thresholds (T8), rule lists (T7), decisions (T9)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from conftest import event_row
from roadlens.operators import events as E


def test_parse_bad_json_gives_null_row_and_wrong_type_null_field(spark):
    good = dict(event_row())
    wrong = dict(event_row(event_id="E2"))
    wrong["speed_kmh"] = "fast"
    missing = {k: v for k, v in event_row(event_id="E3").items() if k != "weather"}
    msgs = spark.createDataFrame(
        [("D1", json.dumps(good)), ("D1", "not json"), ("D1", json.dumps(wrong)), ("D1", json.dumps(missing))],
        "key string, value string",
    )
    rows = {r["event_id"]: r for r in E.parse_events(msgs).collect()}
    assert None in rows and all(v is None for v in rows[None].asDict().values())
    assert rows["E2"]["speed_kmh"] is None and rows["E2"]["braking_ms2"] == -1.0
    assert rows["E3"]["weather"] is None
    assert rows["E1"]["event_time_ts"] is not None


def test_event_time_pattern_needs_three_fraction_digits_offsets_work(spark, make_events):
    df = make_events(
        [
            event_row(event_id="a", event_time="2026-01-01T00:00:10.123Z"),
            event_row(event_id="b", event_time="2026-01-01T00:00:10Z"),
            event_row(event_id="c", event_time="2026-01-01T02:00:10.000+02:00"),
            event_row(event_id="d", event_time=None),
        ]
    )
    got = {r["event_id"]: r["ms"] for r in df.select("event_id", F.unix_millis("event_time_ts").alias("ms")).collect()}
    assert got["a"] == 1767225610123
    assert got["b"] is None  # no fraction digits -> null, the query does not fail
    assert got["c"] == 1767225610000
    assert got["d"] is None


def _flags(make_events, **over):
    return E.flag_events(make_events([event_row(**over)])).first()


def test_thresholds_are_strict(make_events):
    assert not _flags(make_events, speed_kmh=60.0, speed_limit_kmh=50.0)["is_speeding"]
    assert _flags(make_events, speed_kmh=60.5, speed_limit_kmh=50.0)["is_speeding"]
    assert not _flags(make_events, braking_ms2=-3.0)["is_hard_braking"]
    assert _flags(make_events, braking_ms2=-3.01)["is_hard_braking"]
    assert not _flags(make_events, braking_ms2=-5.0)["is_extreme_braking"]
    assert _flags(make_events, braking_ms2=-5.01)["is_extreme_braking"]
    assert not _flags(make_events, acceleration_ms2=2.5)["is_harsh_acceleration"]
    assert _flags(make_events, acceleration_ms2=2.51)["is_harsh_acceleration"]
    assert not _flags(make_events, cornering_g=0.35)["is_sharp_cornering"]
    assert _flags(make_events, cornering_g=0.351)["is_sharp_cornering"]
    # night risk: above the limit (no +10 tolerance), only at night
    assert _flags(make_events, is_night=True, speed_kmh=50.5)["is_night_risk"]
    assert not _flags(make_events, is_night=False, speed_kmh=50.5)["is_night_risk"]


def test_incident_rule(make_events):
    base = dict(braking_ms2=-4.21, cornering_g=0.36)
    assert _flags(make_events, speed_kmh=60.5, speed_limit_kmh=100.0, **base)["possible_crash_or_incident"]
    assert not _flags(make_events, speed_kmh=60.0, speed_limit_kmh=100.0, **base)["possible_crash_or_incident"]
    assert not _flags(make_events, speed_kmh=80.0, speed_limit_kmh=100.0, braking_ms2=-4.2, cornering_g=0.36)[
        "possible_crash_or_incident"
    ]
    assert _flags(make_events, braking_ms2=-5.01)["possible_crash_or_incident"]


def test_one_null_flag_nulls_the_score_and_blocks_alerts(spark, make_events):
    df = E.flag_events(
        make_events(
            [
                event_row(event_id="n1", braking_ms2=None, weather="rain"),
                event_row(event_id="n2", phone_usage=None, weather="rain"),
                event_row(event_id="ok", weather="rain"),
            ]
        )
    )
    rows = {r["event_id"]: r for r in df.collect()}
    assert rows["n1"]["risk_score_event"] is None and rows["n1"]["risk_event"] is None
    assert rows["n2"]["risk_score_event"] is None
    assert rows["ok"]["risk_score_event"] == 1
    assert [r["event_id"] for r in E.build_alert_rows(df).collect()] == ["ok"]


def test_greatest_ignores_null_speed(make_events):
    assert _flags(make_events, speed_kmh=None)["speeding_margin"] == 0.0


def test_rule_lists_seven_and_eight_entries(spark, make_events):
    df = E.flag_events(
        make_events([event_row(braking_ms2=-6.0, weather="snow", phone_usage=True, speed_kmh=70.0, speed_limit_kmh=50.0)])
    )
    r = df.select(E.active_rules(False).alias("a7"), E.active_rules(True).alias("a8")).first()
    assert r["a7"] == ["speeding", "hard_braking", "bad_weather", "phone_usage"]
    assert r["a8"] == ["speeding", "hard_braking", "extreme_braking", "bad_weather", "phone_usage"]
    alert = json.loads(E.build_alerts(df).first()["value"])
    assert list(alert) == list(E.ALERT_FIELDS)
    assert alert["active_rules"] == r["a7"]


def test_event_decisions_score_and_priority(spark, make_events):
    # score 3: speeding + bad weather + phone; score 4 adds harsh acceleration; 5 adds sharp cornering
    common = dict(speed_kmh=70.0, speed_limit_kmh=50.0, weather="rain", phone_usage=True)
    rows = [
        event_row(event_id="s3", **common),
        event_row(event_id="s4", acceleration_ms2=3.0, **common),
        event_row(event_id="s5", acceleration_ms2=3.0, cornering_g=0.4, **common),
        event_row(event_id="inc", braking_ms2=-5.5),
    ]
    flagged = E.flag_events(make_events(rows))
    stream = {r["event_id"]: r for r in E.build_event_decision_rows(flagged, "stream").collect()}
    demo = {r["event_id"]: r for r in E.build_event_decision_rows(flagged, "demo").collect()}
    assert set(stream) == {"s4", "s5", "inc"}
    assert (stream["s4"]["decision_type"], stream["s4"]["priority"]) == ("SEND_SAFETY_NUDGE", "medium")
    assert stream["s5"]["priority"] == "high"
    assert (stream["inc"]["decision_type"], stream["inc"]["priority"]) == ("CHECK_DRIVER_STATUS", "critical")
    assert demo["s4"]["priority"] == "high"
    payload = json.loads(E.build_event_decisions(flagged).filter(F.col("key") == "D1").first()["value"])
    assert list(payload)[:3] == ["decision_source", "decision_ts", "event_id"]


def test_payload_omits_nulls_and_writes_iso_millis(spark, make_events):
    flagged = E.flag_events(make_events([event_row(weather="rain", vehicle_id=None, event_time="2026-01-01T00:00:10.123Z")]))
    msg = E.build_alerts(flagged).first()
    payload = json.loads(msg["value"])
    assert msg["key"] == "D1"
    assert "vehicle_id" not in payload
    assert payload["event_time_ts"].startswith("2026-01-01T00:00:10.123")
    assert payload["active_rules"] == ["bad_weather"] and payload["risk_score_event"] == 1
