"""Spark schemas of the event, decision and premium tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw telematics event as carried in the JSON value of a message.  Fields are
# declared non-null, but ``from_json`` does not enforce that: parsed columns
# are always nullable.
EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), False),
        StructField("driver_id", StringType(), False),
        StructField("vehicle_id", StringType(), False),
        StructField("driver_profile", StringType(), True),
        StructField("event_time", StringType(), False),
        StructField("speed_kmh", DoubleType(), False),
        StructField("speed_limit_kmh", DoubleType(), False),
        StructField("acceleration_ms2", DoubleType(), False),
        StructField("braking_ms2", DoubleType(), False),
        StructField("cornering_g", DoubleType(), False),
        StructField("road_type", StringType(), False),
        StructField("weather", StringType(), False),
        StructField("is_night", BooleanType(), False),
        StructField("distance_delta_km", DoubleType(), False),
        StructField("phone_usage", BooleanType(), False),
    ]
)
EVENT_COLUMNS = tuple(f.name for f in EVENT_SCHEMA.fields)

# Union of every decision payload (event, sliding window, demo policy and
# count-window policy); a reader decodes any of them with this schema.
DECISION_SCHEMA = StructType(
    [
        StructField("decision_source", StringType()),
        StructField("decision_ts", TimestampType()),
        StructField("event_id", StringType()),
        StructField("driver_id", StringType()),
        StructField("vehicle_id", StringType()),
        StructField("driver_profile", StringType()),
        StructField("event_time_ts", TimestampType()),
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("decision_type", StringType()),
        StructField("priority", StringType()),
        StructField("recommended_action", StringType()),
        StructField("customer_message", StringType()),
        StructField("decision_reason", StringType()),
        StructField("active_rules", ArrayType(StringType())),
        StructField("risk_score_event", LongType()),
        StructField("speed_kmh", DoubleType()),
        StructField("speed_limit_kmh", DoubleType()),
        StructField("braking_ms2", DoubleType()),
        StructField("cornering_g", DoubleType()),
        StructField("road_type", StringType()),
        StructField("weather", StringType()),
        StructField("is_night", BooleanType()),
        StructField("phone_usage", BooleanType()),
        StructField("event_count", LongType()),
        StructField("km_driven", DoubleType()),
        StructField("avg_speed", DoubleType()),
        StructField("risk_intensity", DoubleType()),
        StructField("risk_events_per_100km", DoubleType()),
        StructField("risk_event_count", LongType()),
        StructField("risk_score_5m", LongType()),
        StructField("risk_score_window", LongType()),
        StructField("speeding_count", LongType()),
        StructField("hard_braking_count", LongType()),
        StructField("harsh_acceleration_count", LongType()),
        StructField("sharp_cornering_count", LongType()),
        StructField("bad_weather_event_count", LongType()),
        StructField("night_event_count", LongType()),
        StructField("phone_usage_count", LongType()),
    ]
)

# One row of the premium history (one scoring run per driver).
PREMIUM_HISTORY_SCHEMA = StructType(
    [
        StructField("driver_id", StringType()),
        StructField("exposure_km", DoubleType()),
        StructField("speeding_ratio", DoubleType()),
        StructField("hard_braking_count_per_100km", DoubleType()),
        StructField("harsh_acceleration_count_per_100km", DoubleType()),
        StructField("night_event_ratio", DoubleType()),
        StructField("bad_weather_event_ratio", DoubleType()),
        StructField("phone_usage_count", LongType()),
        StructField("predicted_claim_count", DoubleType()),
        StructField("predicted_frequency", DoubleType()),
        StructField("risk_multiplier", DoubleType()),
        StructField("target_technical_premium", DoubleType()),
        StructField("technical_premium_previous", DoubleType()),
        StructField("technical_premium", DoubleType()),
        StructField("scored_at", StringType()),
        StructField("base_premium", DoubleType()),
        StructField("premium_change_cap", DoubleType()),
    ]
)
PREMIUM_HISTORY_COLUMNS = tuple(f.name for f in PREMIUM_HISTORY_SCHEMA.fields)

# Windowed feature table (one-minute and sliding windows) with the optional columns that training adds.
_FEATURE_TEXT = ("driver_id", "driver_profile")
_FEATURE_TIMES = ("window_start", "window_end")
_FEATURE_COUNTS = (
    "event_count", "speeding_count", "hard_braking_count", "harsh_acceleration_count", "sharp_cornering_count", "night_event_count",
    "bad_weather_event_count", "phone_usage_count", "risk_event_count", "claim_count",
)
_FEATURE_MEASURES = (
    "km_driven", "avg_speed", "max_speed", "speeding_ratio", "night_event_ratio", "bad_weather_event_ratio", "exposure_km",
    "risk_events_per_100km", "hard_braking_count_per_100km", "harsh_acceleration_count_per_100km", "expected_claim_rate",
)
FEATURE_SCHEMA = StructType(
    [StructField(c, StringType()) for c in _FEATURE_TEXT]
    + [StructField(c, TimestampType()) for c in _FEATURE_TIMES]
    + [StructField(c, LongType()) for c in _FEATURE_COUNTS]
    + [StructField(c, DoubleType()) for c in _FEATURE_MEASURES]
)
