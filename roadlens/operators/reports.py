"""Ranked summaries over the training set, test predictions and premium history.

Top-k reports use ``orderBy(...).limit(n)``, which Spark plans as
``TakeOrderedAndProject``: each partition keeps its own top n and only those
reach the final merge.  Ties are broken by ``driver_id`` so the output is
deterministic.  Scores are rounded to 9 places before ranking so that
engines with different summation orders rank the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .pricing import latest_premium


def _top(df: DataFrame, value: str, n: int) -> DataFrame:
    return df.orderBy(F.col(value).desc(), F.col("driver_id")).limit(n)


def with_driver_risk_score(features: DataFrame) -> DataFrame:
    """speeding + hard/100 + harsh/100 + night + weather (per window)."""
    return features.withColumn(
        "risk_score_driver",
        F.col("speeding_ratio")
        + F.col("hard_braking_count_per_100km") / F.lit(100.0)
        + F.col("harsh_acceleration_count_per_100km") / F.lit(100.0)
        + F.col("night_event_ratio")
        + F.col("bad_weather_event_ratio"),
    )


def _known(df: DataFrame) -> DataFrame:
    """Rows with a driver: a missing driver id is not a driver to rank."""
    return df.filter(F.col("driver_id").isNotNull())


def risk_proxy(features: DataFrame, window_key: str = "window_start") -> DataFrame:
    """Sum over drivers of (speeding ratio + night ratio) per window."""
    return features.groupBy(window_key).agg(
        F.round(F.sum(F.col("speeding_ratio") + F.col("night_event_ratio")), 9).alias("risk_proxy")
    )


def top_speeding(features: DataFrame, n: int = 15) -> DataFrame:
    agg = _known(features).groupBy("driver_id").agg(F.round(F.avg("speeding_ratio"), 9).alias("speeding_ratio"))
    return _top(agg, "speeding_ratio", n)


def top_risk(features: DataFrame, n: int = 15) -> DataFrame:
    agg = with_driver_risk_score(_known(features)).groupBy("driver_id").agg(
        F.round(F.avg("risk_score_driver"), 9).alias("risk_score_driver")
    )
    return _top(agg, "risk_score_driver", n)


def top_frequency(predictions: DataFrame, n: int = 15) -> DataFrame:
    agg = _known(predictions).groupBy("driver_id").agg(F.round(F.avg("predicted_frequency"), 9).alias("predicted_frequency"))
    return _top(agg, "predicted_frequency", n)


def profile_summary(features: DataFrame) -> DataFrame:
    """Mean of four measures for the safe / average / aggressive profiles, with their display order."""
    order = F.array_position(F.array(*[F.lit(p) for p in C.PROFILE_REPORT_ORDER]), F.col("driver_profile"))
    return (
        with_driver_risk_score(features)
        .filter(F.col("driver_profile").isin(*C.PROFILE_REPORT_ORDER))
        .groupBy("driver_profile")
        .agg(
            F.round(F.avg("speeding_ratio"), 9).alias("speeding_ratio"),
            F.round(F.avg("night_event_ratio"), 9).alias("night_event_ratio"),
            F.round(F.avg("bad_weather_event_ratio"), 9).alias("bad_weather_event_ratio"),
            F.round(F.avg("risk_score_driver"), 9).alias("risk_score_driver"),
        )
        .withColumn("profile_order", order.cast("int"))
        .orderBy("profile_order")
    )


def top_premiums(run: DataFrame, n: int = 20) -> DataFrame:
    return _top(run, "technical_premium", n)


def top_latest(history: DataFrame, n: int = 15) -> DataFrame:
    return _top(latest_premium(history), "technical_premium", n)


def trajectory(history: DataFrame, n: int = 5) -> DataFrame:
    """History rows of the n drivers with the highest latest premium, in time order per driver.

    The n driver ids come from a top-k (bounded by n), and the history is
    filtered by a left-semi join against them.  A stamp that is no instant
    comes first, as it is older than any in ``latest_premium``; ties by its text.
    """
    top = top_latest(history, n).select("driver_id")
    return (
        history.join(F.broadcast(top), "driver_id", "left_semi")
        .withColumn("scored_at_ts", F.try_to_timestamp("scored_at"))
        .orderBy("driver_id", "scored_at_ts", "scored_at")
    )
