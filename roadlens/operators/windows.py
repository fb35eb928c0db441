"""Time-window aggregates per driver and the decisions taken on them.

Plan shape: ``groupBy(driver_id, window(event_time_ts, size[, slide]))`` is a
hash aggregate with a map-side partial step, then one shuffle on the
(driver, window) key.  Hashing on the pair (not on the driver alone) spreads a
driver that owns a large share of the rows over many reducers: its windows
land on different partitions.  In streaming the same plan adds a watermark and
a state store; in batch the watermark is a no-op.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .events import to_payload

WINDOW_DECISION_FIELDS = (
    "decision_source",
    "decision_ts",
    "driver_id",
    "window_start",
    "window_end",
    "decision_type",
    "priority",
    "recommended_action",
    "customer_message",
    "decision_reason",
    "event_count",
    "km_driven",
    "avg_speed",
    "risk_intensity",
    "risk_events_per_100km",
    "risk_event_count",
    "risk_score_5m",
    "speeding_count",
    "hard_braking_count",
    "harsh_acceleration_count",
    "sharp_cornering_count",
    "bad_weather_event_count",
    "night_event_count",
    "phone_usage_count",
)


def _count_true(name: str) -> Column:
    return F.sum(F.col(name).cast("int"))


def _window(duration: str, slide: str | None) -> Column:
    ts = F.col("event_time_ts")
    return F.window(ts, duration, slide) if slide else F.window(ts, duration)


def _grouped(flagged: DataFrame, duration: str, slide: str | None, watermark: str | None, keys: Sequence[str]):
    src = flagged.withWatermark("event_time_ts", watermark) if watermark else flagged
    return src.groupBy(*[F.col(k) for k in keys], _window(duration, slide).alias("window"))


def _window_aggregates() -> dict[str, Column]:
    """The aggregates that feature windows and decision windows share, by name."""
    counted = {
        "speeding_count": "is_speeding",
        "hard_braking_count": "is_hard_braking",
        "harsh_acceleration_count": "is_harsh_acceleration",
        "sharp_cornering_count": "is_sharp_cornering",
        "night_event_count": "is_night",
        "bad_weather_event_count": "is_bad_weather",
        "phone_usage_count": "phone_usage",
        "risk_event_count": "risk_event",
    }
    return {
        "event_count": F.count(F.lit(1)),
        "km_driven": F.round(F.sum("distance_delta_km"), 4),
        "avg_speed": F.round(F.avg("speed_kmh"), 2),
        **{name: _count_true(flag) for name, flag in counted.items()},
    }


def _aggregate(grouped, **more: Column) -> DataFrame:
    return grouped.agg(*[c.alias(name) for name, c in {**_window_aggregates(), **more}.items()])


def _unpack_window(df: DataFrame) -> DataFrame:
    return df.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")


def window_features(
    flagged: DataFrame,
    duration: str = C.TUMBLING,
    slide: str | None = None,
    watermark: str | None = C.WATERMARK,
    keys: Sequence[str] = ("driver_id",),
) -> DataFrame:
    """Per driver and window: counts, km, speeds, conditional counts, ratios, exposure.

    ``keys`` may add columns that are functions of the driver (e.g. its
    profile) without changing the grouping.
    """
    agg = _aggregate(_grouped(flagged, duration, slide, watermark, keys), max_speed=F.max("speed_kmh"))
    exposure = F.greatest(F.col("km_driven"), F.lit(C.EXPOSURE_FLOOR_KM))
    derived = agg.withColumns(
        {
            "speeding_ratio": F.col("speeding_count") / F.col("event_count"),
            "night_event_ratio": F.col("night_event_count") / F.col("event_count"),
            "bad_weather_event_ratio": F.col("bad_weather_event_count") / F.col("event_count"),
            "exposure_km": exposure,
        }
    ).withColumn("risk_events_per_100km", F.col("risk_event_count") / F.col("exposure_km") * F.lit(100.0))
    return _unpack_window(derived)


def tumbling_features(flagged: DataFrame, watermark: str | None = C.WATERMARK, keys: Sequence[str] = ("driver_id",)) -> DataFrame:
    return window_features(flagged, C.TUMBLING, None, watermark, keys)


def sliding_features(flagged: DataFrame, watermark: str | None = C.WATERMARK, keys: Sequence[str] = ("driver_id",)) -> DataFrame:
    return window_features(flagged, C.SLIDING_SIZE, C.SLIDING_STEP, watermark, keys)


def decision_windows(
    flagged: DataFrame,
    duration: str = C.SLIDING_SIZE,
    slide: str | None = C.SLIDING_STEP,
    watermark: str | None = C.WATERMARK,
) -> DataFrame:
    """Per driver x 5-minute window sliding by 1 minute: the 12 aggregates the decisions need."""
    agg = _aggregate(_grouped(flagged, duration, slide, watermark, ("driver_id",)), risk_score_5m=F.sum("risk_score_event"))
    derived = agg.withColumns(
        {
            "risk_intensity": F.col("risk_event_count") / F.col("event_count"),
            "risk_events_per_100km": F.col("risk_event_count")
            / F.greatest(F.col("km_driven"), F.lit(C.EXPOSURE_FLOOR_KM))
            * F.lit(100.0),
        }
    )
    return _unpack_window(derived)


def window_decision_type(score: str, phone: str, count: str, intensity: str, risk_count: str, km: str) -> Column:
    """First matching rule wins: escalate, then nudge, then safe-driving points; else null."""
    return (
        F.when(
            (F.col(score) >= F.lit(C.ESCALATE_SCORE)) | (F.col(phone) >= F.lit(C.ESCALATE_PHONE)),
            F.lit(C.ESCALATE_HIGH_RISK_REVIEW),
        )
        .when(
            (F.col(count) >= F.lit(C.NUDGE_MIN_EVENTS)) & (F.col(intensity) >= F.lit(C.NUDGE_INTENSITY)),
            F.lit(C.SEND_SAFETY_NUDGE),
        )
        .when(
            (F.col(count) >= F.lit(C.POINTS_MIN_EVENTS))
            & (F.col(risk_count) == F.lit(0))
            & (F.col(km) >= F.lit(C.POINTS_MIN_KM)),
            F.lit(C.GRANT_SAFE_DRIVING_POINTS),
        )
    )


def window_priority(decision: Column) -> Column:
    return (
        F.when(decision == F.lit(C.ESCALATE_HIGH_RISK_REVIEW), F.lit("high"))
        .when(decision == F.lit(C.SEND_SAFETY_NUDGE), F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def window_action(decision: Column) -> Column:
    return (
        F.when(decision == F.lit(C.ESCALATE_HIGH_RISK_REVIEW), F.lit(C.ACTION_ESCALATE))
        .when(decision == F.lit(C.SEND_SAFETY_NUDGE), F.lit(C.ACTION_WINDOW_NUDGE))
        .otherwise(F.lit(C.ACTION_POINTS))
    )


def build_window_decision_rows(windowed: DataFrame) -> DataFrame:
    """Decision rows (24 fields) for the windows that match a rule.

    The unrounded ``risk_intensity`` is compared; the payload shows it
    rounded to 3 places and ``risk_events_per_100km`` to 2.
    """
    decision = F.col("decision_type")
    reason = F.concat(
        F.lit(C.WINDOW_REASON_PREFIX),
        F.col("event_count").cast("string"),
        F.lit(", risk_events="),
        F.col("risk_event_count").cast("string"),
        F.lit(", risk_score="),
        F.col("risk_score_5m").cast("string"),
        F.lit(", phone_usage="),
        F.col("phone_usage_count").cast("string"),
    )
    return (
        windowed.withColumn(
            "decision_type",
            window_decision_type(
                "risk_score_5m", "phone_usage_count", "event_count", "risk_intensity", "risk_event_count", "km_driven"
            ),
        )
        .filter(decision.isNotNull())
        .withColumns(
            {
                "decision_source": F.lit(C.SOURCE_SLIDING),
                "decision_ts": F.current_timestamp(),
                "priority": window_priority(decision),
                "recommended_action": window_action(decision),
                "customer_message": F.when(
                    decision == F.lit(C.GRANT_SAFE_DRIVING_POINTS), F.lit(C.MESSAGE_POINTS)
                ).otherwise(F.lit(C.MESSAGE_WINDOW_RISK)),
                "decision_reason": reason,
                "risk_intensity": F.round(F.col("risk_intensity"), 3),
                "risk_events_per_100km": F.round(F.col("risk_events_per_100km"), 2),
            }
        )
        .select(*WINDOW_DECISION_FIELDS)
    )


def build_window_decisions(windowed: DataFrame) -> DataFrame:
    return to_payload(build_window_decision_rows(windowed), WINDOW_DECISION_FIELDS)


def union_decisions(*frames: DataFrame) -> DataFrame:
    """Decisions of several sources in one output; columns aligned by name, absent ones null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
