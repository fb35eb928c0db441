"""Per-driver roll-up that is topped up by date instead of computed from all windows at every run.

Partial sums and counts per driver and period (a date of the feature store)
add up to the sums and means of ``driver_rollup``.  ``top_up`` reads the
periods of the feature store that are new since the last time, and the last
one known again, as it may have been open: a feature stream appends windows in
the order of their ends, so once a later period has windows an earlier one is
complete.  A period's partials replace those stored for it (dynamic partition
overwrite), so a repeated top-up changes nothing.

The store has one row per driver and period; a roll-up aggregates it with
partial sums, whatever the number of windows behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURE_COLUMNS
from ..operators.pricing import prepare_features
from .io import load_features, path_exists

PERIOD = "window_date"
#: Averaged over windows; exposure and phone usage are summed.
MEANS = tuple(c for c in FEATURE_COLUMNS if c != "phone_usage_count")


def partials(features: DataFrame, period: str = PERIOD) -> DataFrame:
    """Per driver and period: sums, and for every mean its sum and the number of its values."""
    sums = [F.sum("exposure_km").alias("exposure_km"), F.sum("phone_usage_count").cast("long").alias("phone_usage_count")]
    parts = [f(c).alias(f"{c}_{name}") for c in MEANS for name, f in (("sum", F.sum), ("n", F.count))]
    known = prepare_features(features).filter(F.col("driver_id").isNotNull())
    return known.groupBy("driver_id", period).agg(*sums, *parts)


def _mean(name: str) -> Column:
    total, n = F.sum(f"{name}_sum"), F.sum(f"{name}_n")
    return F.when(n > 0, total / n).alias(name)


def rollup_of_partials(stored: DataFrame) -> DataFrame:
    """The rows of ``driver_rollup`` from partial sums."""
    return stored.groupBy("driver_id").agg(
        F.sum("exposure_km").alias("exposure_km"), *[_mean(c) for c in MEANS], F.sum("phone_usage_count").cast("long").alias("phone_usage_count")
    )


def new_periods(spark: SparkSession, features_path: str, store_path: str, period: str = PERIOD) -> DataFrame:
    """The feature rows that a top-up has to read."""
    features = load_features(spark, features_path)
    if not path_exists(spark, store_path):
        return features
    last = spark.read.parquet(store_path).agg(F.max(period)).first()[0]  # one value, of the partition column alone
    return features if last is None else features.filter(F.col(period) >= F.lit(last))


def top_up(spark: SparkSession, features_path: str, store_path: str, period: str = PERIOD) -> None:
    """Bring the store up to the feature table, reading new periods and the last known one."""
    rows = partials(new_periods(spark, features_path, store_path, period), period)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(store_path)


def stored_rollup(spark: SparkSession, store_path: str) -> DataFrame:
    return rollup_of_partials(spark.read.parquet(store_path))
