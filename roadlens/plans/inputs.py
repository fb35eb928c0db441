"""Derived inputs shared by the registered queries (all computed by Spark from the given tables).

* pricing features: one-minute windows of the projected events per driver
  (with the driver's profile), exposure scaled x10 so that the claim-rate
  rule is not saturated by the fixture's short windows;
* the claim label, drawn with a uniform that is plain arithmetic on the
  driver number and the window minute (so SQL can reproduce it);
* the test split, also arithmetic on the same two numbers;
* premium history: three scoring runs over all drivers and all windows that
  differ in base premium and cap, each taking the history of the runs before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import events as E
from ..operators import pricing as P
from ..operators import windows as W
from ..session import materialize
from .fixture import TARGET_EPOCH_MS, raw_events

# fixed values: fixture parameters of the pricing inputs
EXPOSURE_SCALE = 10.0
LABEL_MOD = 10007
LABEL_D_MULT = 7919
LABEL_MINUTE_MULT = 104729
SPLIT_D_MULT = 31
SPLIT_MINUTE_MULT = 17
SPLIT_MOD = 4
RUNS = (
    # (base premium, cap, scored_at)
    (900.0, 0.20, "2026-01-01T01:12:00+00:00"),
    (950.0, 0.15, "2026-01-01T02:24:00+00:00"),
    (1000.0, 0.10, "2026-01-01T03:36:00+00:00"),
)


def flagged_events(spark: SparkSession, sf_dir: str, with_incident: bool = True) -> DataFrame:
    """Flagged events of the typed table (its ``event_time_ts`` is native; messages are parsed instead)."""
    return E.flag_events(raw_events(spark, sf_dir), with_incident)


def pricing_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    fl = flagged_events(spark, sf_dir, with_incident=False)
    feats = W.tumbling_features(fl, keys=("driver_id", "driver_profile"))
    return feats.withColumns(
        {
            "exposure_km": F.col("exposure_km") * F.lit(EXPOSURE_SCALE),
            "d": F.substring("driver_id", 2, 32).cast("long") - F.lit(1),
            "minute": F.expr(f"(unix_seconds(window_start) - {TARGET_EPOCH_MS // 1000}) div 60"),
        }
    )


def label_uniform() -> Column:
    return (
        ((F.col("d") * F.lit(LABEL_D_MULT) + F.col("minute") * F.lit(LABEL_MINUTE_MULT)) % F.lit(LABEL_MOD)).cast("double")
        + F.lit(0.5)
    ) / F.lit(float(LABEL_MOD))


def test_flag() -> Column:
    return (F.col("d") * F.lit(SPLIT_D_MULT) + F.col("minute") * F.lit(SPLIT_MINUTE_MULT)) % F.lit(SPLIT_MOD) == F.lit(0)


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared, labelled pricing features (the training data set)."""
    return P.impute_claims(P.prepare_features(pricing_features(spark, sf_dir)), u=label_uniform())


def train_test(spark: SparkSession, sf_dir: str, materialized: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train and test parts of the training set (materialised once first when both parts feed several jobs)."""
    data = training_set(spark, sf_dir)
    return P.split(materialize(data) if materialized else data, test_flag())


def test_predictions(spark: SparkSession, sf_dir: str, coefficients=C.COMMITTED_COEFFICIENTS) -> DataFrame:
    """Held-out windows scored with the given coefficients (count and frequency)."""
    _, test = train_test(spark, sf_dir)
    return P.predict(test, coefficients).select(
        "driver_id", "window_start", "exposure_km", "claim_count", "predicted_claim_count", "predicted_frequency"
    )


def premium_runs(spark: SparkSession, sf_dir: str, n: int = len(RUNS), coefficients=C.COMMITTED_COEFFICIENTS) -> list[DataFrame]:
    """The first ``n`` scoring runs, each over all drivers and taking the history of the runs before it.

    The drivers' roll-up is the same for all runs; it is written once (one row
    per driver), and so is each run that a later one builds on, as a history
    would be: a run's plan holds no earlier run's plan.
    """
    rolled = materialize(P.driver_rollup(P.prepare_features(pricing_features(spark, sf_dir))), "rollup")
    runs: list[DataFrame] = []
    history: DataFrame | None = None
    for k, (base, cap, stamp) in enumerate(RUNS[:n], 1):
        run = P.premium_run_of_rollup(rolled, coefficients, history, base, cap, scored_at=stamp)
        run = run if k == n else materialize(run, "premium_run")
        runs.append(run)
        history = P.union_history(history, run)
    return runs


def premium_history(spark: SparkSession, sf_dir: str, n: int = len(RUNS)) -> DataFrame:
    """The history after the first ``n`` runs."""
    history: DataFrame | None = None
    for run in premium_runs(spark, sf_dir, n):
        history = P.union_history(history, run)
    return history
