"""Event-level operators: parsing, risk flags, rule lists, alerts, event decisions.

All of them are narrow (row-by-row) transformations: no shuffle, one
whole-stage-codegen span, identical in batch and streaming.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.expressions import incident_flag_columns, risk_flag_columns, rule_list
from ..schemas import EVENT_SCHEMA

# fixed value: the event-time pattern of the messages (three fraction digits, offset)
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

ALERT_FIELDS = (
    "event_id",
    "driver_id",
    "vehicle_id",
    "event_time_ts",
    "active_rules",
    "risk_score_event",
    "speed_kmh",
    "speed_limit_kmh",
    "acceleration_ms2",
    "braking_ms2",
    "cornering_g",
    "road_type",
    "weather",
    "is_night",
    "distance_delta_km",
    "phone_usage",
)

EVENT_DECISION_FIELDS = (
    "decision_source",
    "decision_ts",
    "event_id",
    "driver_id",
    "vehicle_id",
    "driver_profile",
    "event_time_ts",
    "decision_type",
    "priority",
    "recommended_action",
    "customer_message",
    "active_rules",
    "risk_score_event",
    "speed_kmh",
    "speed_limit_kmh",
    "braking_ms2",
    "cornering_g",
    "road_type",
    "weather",
    "is_night",
    "phone_usage",
)

DEMO_EVENT_DECISION_FIELDS = (
    "decision_source",
    "decision_ts",
    "driver_id",
    "event_id",
    "decision_type",
    "priority",
    "recommended_action",
    "customer_message",
    "active_rules",
    "risk_score_event",
)

PREVIEW_COLUMNS = ("event_id", "driver_id", "event_time_ts", "speed_kmh", "speed_limit_kmh", "risk_score_event")


def normalise_event_time(df: DataFrame, source: str = "event_time", target: str = "event_time_ts") -> DataFrame:
    """Parse the ISO event time (trailing ``Z`` read as ``+00:00``) into a timestamp.

    ``try_to_timestamp`` keeps the lenient behaviour under ANSI mode: text
    that does not match the pattern (e.g. no fraction digits) gives null
    instead of failing the query.
    """
    clean = F.regexp_replace(F.col(source), "Z$", "+00:00")
    return df.withColumn(target, F.try_to_timestamp(clean, F.lit(EVENT_TIME_PATTERN)))


def parse_events(messages: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Message value (JSON text or bytes) -> the 15 typed event columns + ``event_time_ts``, and the message columns to ``keep``.

    Unparseable text gives an all-null row; a field of the wrong type is null
    on its own.  Catalyst prunes the JSON schema to the fields used later.
    """
    parsed = messages.select(
        F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA).alias("event"), *keep
    ).select("event.*", *keep)
    return normalise_event_time(parsed)


def add_risk_flags(df: DataFrame) -> DataFrame:
    """Seven rule flags, ``speeding_margin``, ``risk_score_event`` (int) and ``risk_event``."""
    return df.withColumns(risk_flag_columns())


def add_incident_flags(df: DataFrame) -> DataFrame:
    """``is_extreme_braking`` and ``possible_crash_or_incident`` on a flagged frame."""
    return df.withColumns(incident_flag_columns())


def flag_events(df: DataFrame, with_incident: bool = True) -> DataFrame:
    flagged = add_risk_flags(df)
    return add_incident_flags(flagged) if with_incident else flagged


def active_rules(include_extreme: bool = True) -> Column:
    """Ordered array of fired rule names: eight entries with extreme braking, seven without."""
    return rule_list(C.RULES_WITH_EXTREME if include_extreme else C.RULES_WITHOUT_EXTREME)


def filter_risky(flagged: DataFrame) -> DataFrame:
    """Rows whose ``risk_event`` is true (a null score drops the row)."""
    return flagged.filter(F.col("risk_event"))


def build_alert_rows(flagged: DataFrame) -> DataFrame:
    """Risky events with their seven-entry rule list, as the 16 alert fields (columns)."""
    return filter_risky(flagged).withColumn("active_rules", active_rules(False)).select(*ALERT_FIELDS)


def to_payload(df: DataFrame, fields: Sequence[str | Column] | None = None, key: str = "driver_id") -> DataFrame:
    """``key`` + ``value`` = JSON of the fields (nulls omitted, timestamps ISO with millis)."""
    cols = [F.col(f) if isinstance(f, str) else f for f in (fields or df.columns)]
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


def build_alerts(flagged: DataFrame) -> DataFrame:
    """Alert messages: key = driver id, value = JSON of the 16 alert fields."""
    return to_payload(build_alert_rows(flagged), ALERT_FIELDS)


def event_preview(flagged: DataFrame) -> DataFrame:
    return flagged.select(*PREVIEW_COLUMNS)


def _event_decision_columns(policy: str) -> dict[str, Column]:
    incident = F.col("possible_crash_or_incident")
    score = F.col("risk_score_event")
    decision = F.when(incident, F.lit(C.CHECK_DRIVER_STATUS)).when(
        score >= F.lit(C.EVENT_NUDGE_SCORE), F.lit(C.SEND_SAFETY_NUDGE)
    )
    if policy == "stream":
        priority = F.when(incident, F.lit("critical")).when(score >= F.lit(C.EVENT_HIGH_SCORE), F.lit("high")).otherwise(
            F.lit("medium")
        )
    elif policy == "demo":
        priority = F.when(incident, F.lit("critical")).otherwise(F.lit("high"))
    else:
        raise ValueError(f"unknown event decision policy {policy!r}")
    return {
        "decision_type": decision,
        "priority": priority,
        "recommended_action": F.when(incident, F.lit(C.ACTION_CHECK_STATUS)).otherwise(F.lit(C.ACTION_EVENT_NUDGE)),
        "customer_message": F.when(incident, F.lit(C.MESSAGE_CHECK_STATUS)).otherwise(F.lit(C.MESSAGE_EVENT_NUDGE)),
        "active_rules": active_rules(True),
        "decision_source": F.lit(C.SOURCE_EVENT),
        "decision_ts": F.current_timestamp(),
    }


def build_event_decision_rows(flagged: DataFrame, policy: str = "stream", extra: Sequence[str] = ()) -> DataFrame:
    """One decision per event that is a possible incident or scores >= 4; other events give no row.

    ``policy="stream"``: incident -> critical, score >= 5 -> high, else medium
    (21 fields).  ``policy="demo"``: every nudge is high (10 fields).
    """
    fields = EVENT_DECISION_FIELDS if policy == "stream" else DEMO_EVENT_DECISION_FIELDS
    return (
        flagged.withColumns(_event_decision_columns(policy))
        .filter(F.col("decision_type").isNotNull())
        .select(*extra, *fields)
    )


def build_event_decisions(flagged: DataFrame, policy: str = "stream") -> DataFrame:
    fields = EVENT_DECISION_FIELDS if policy == "stream" else DEMO_EVENT_DECISION_FIELDS
    return to_payload(build_event_decision_rows(flagged, policy), fields)
