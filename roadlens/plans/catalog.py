"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the given tables (the ``events`` table, projected to vehicle
events) and runs one operator of the library over the whole input.  Output
timestamps are given as epoch seconds / millis (bigint) so that they compare
equal across engines; derived doubles that the operator itself does not round
are rounded to 9 places for the same reason, and rule arrays are joined to
``|``-separated text.
"""

from __future__ import annotations

import math

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import events as E
from ..operators import pricing as P
from ..operators import reports as R
from ..operators import rolling as RL
from ..operators import windows as W
from ..schemas import EVENT_COLUMNS, PREMIUM_HISTORY_COLUMNS
from .fixture import raw_events, raw_messages
from . import inputs as I
from .inputs import flagged_events

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


def r9(c: str | Column, alias: str | None = None) -> Column:
    out = F.round(F.col(c) if isinstance(c, str) else c, 9)
    name = alias or (c if isinstance(c, str) else None)
    return out.alias(name) if name else out


def epoch_s(name: str) -> Column:
    return F.unix_seconds(F.col(name)).alias(name)


def epoch_ms(name: str) -> Column:
    return F.unix_millis(F.col(name)).alias(name)


def joined(name: str) -> Column:
    return F.concat_ws("|", F.col(name)).alias(name)


FLAG_OUTPUT = (
    "is_speeding",
    "speeding_margin",
    "is_hard_braking",
    "is_harsh_acceleration",
    "is_sharp_cornering",
    "is_night_risk",
    "is_bad_weather",
    "is_phone_usage",
    "risk_score_event",
    "risk_event",
)

FEATURE_OUTPUT = (
    "driver_id",
    "event_count",
    "km_driven",
    "avg_speed",
    "max_speed",
    "speeding_count",
    "hard_braking_count",
    "harsh_acceleration_count",
    "sharp_cornering_count",
    "night_event_count",
    "bad_weather_event_count",
    "phone_usage_count",
    "risk_event_count",
)

DECISION_WINDOW_OUTPUT = (
    "driver_id",
    "event_count",
    "km_driven",
    "avg_speed",
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


def feature_output(df: DataFrame, *extra: str) -> DataFrame:
    """Window features with epoch-second bounds and 9-place derived doubles."""
    return df.select(
        *extra,
        *FEATURE_OUTPUT,
        r9("speeding_ratio"),
        r9("night_event_ratio"),
        r9("bad_weather_event_ratio"),
        F.col("exposure_km"),
        r9("risk_events_per_100km"),
        epoch_s("window_start"),
        epoch_s("window_end"),
    )


def alert_output(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            epoch_ms(c) if c == "event_time_ts" else joined(c) if c == "active_rules" else F.col(c)
            for c in E.ALERT_FIELDS
        ]
    )


def event_decision_output(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != "decision_ts"]
    return df.select(
        *[epoch_ms(c) if c == "event_time_ts" else joined(c) if c == "active_rules" else F.col(c) for c in cols]
    )


def window_decision_output(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != "decision_ts"]
    return df.select(*[epoch_s(c) if c in ("window_start", "window_end") else F.col(c) for c in cols])


def target_premium() -> Column:
    """The target premium to 6 places: in the hundreds, 9 places would reach into the order of a floating-point sum."""
    return F.round("target_technical_premium", 6).alias("target_technical_premium")


def history_output(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        *extra,
        *[
            r9(c) if c in ("exposure_km", "speeding_ratio", "hard_braking_count_per_100km",
                           "harsh_acceleration_count_per_100km", "night_event_ratio", "bad_weather_event_ratio",
                           "predicted_claim_count", "predicted_frequency", "risk_multiplier")
            else target_premium() if c == "target_technical_premium" else F.col(c)
            for c in PREMIUM_HISTORY_COLUMNS
        ]
    )


# --- 2.2 event level --------------------------------------------------------------------------


@register("parse_events")
def q_parse_events(spark, sf_dir):
    parsed = E.parse_events(raw_messages(spark, sf_dir))
    return parsed.select(*EVENT_COLUMNS, epoch_ms("event_time_ts"))


@register("event_time_normalise")
def q_event_time_normalise(spark, sf_dir):
    ev = E.normalise_event_time(raw_events(spark, sf_dir))
    return ev.select("event_id", "event_time", epoch_ms("event_time_ts"))


@register("risk_flags")
def q_risk_flags(spark, sf_dir):
    fl = flagged_events(spark, sf_dir, with_incident=False)
    return fl.select("event_id", "driver_id", epoch_ms("event_time_ts"), *FLAG_OUTPUT)


@register("incident_flags")
def q_incident_flags(spark, sf_dir):
    fl = flagged_events(spark, sf_dir)
    return fl.select("event_id", "driver_id", "is_sharp_cornering", "is_extreme_braking", "possible_crash_or_incident")


@register("active_rules")
def q_active_rules(spark, sf_dir):
    fl = flagged_events(spark, sf_dir)
    return fl.select(
        "event_id",
        F.concat_ws("|", E.active_rules(False)).alias("alert_rules"),
        F.concat_ws("|", E.active_rules(True)).alias("decision_rules"),
    )


@register("risk_filter")
def q_risk_filter(spark, sf_dir):
    return E.filter_risky(flagged_events(spark, sf_dir, with_incident=False)).select(
        "event_id", "driver_id", "risk_score_event"
    )


@register("alerts")
def q_alerts(spark, sf_dir):
    return alert_output(E.build_alert_rows(flagged_events(spark, sf_dir, with_incident=False)))


@register("event_preview")
def q_event_preview(spark, sf_dir):
    pv = E.event_preview(flagged_events(spark, sf_dir, with_incident=False))
    return pv.select(*[epoch_ms(c) if c == "event_time_ts" else F.col(c) for c in pv.columns])


@register("event_decisions")
def q_event_decisions(spark, sf_dir):
    return event_decision_output(E.build_event_decision_rows(flagged_events(spark, sf_dir), "stream"))


@register("event_decisions_demo_policy")
def q_event_decisions_demo(spark, sf_dir):
    return event_decision_output(E.build_event_decision_rows(flagged_events(spark, sf_dir), "demo"))


@register("payload_encode")
def q_payload_encode(spark, sf_dir):
    """Alert messages encoded to JSON, then decoded again with the alert schema."""
    msgs = E.build_alerts(flagged_events(spark, sf_dir, with_incident=False))
    schema = E.build_alert_rows(flagged_events(spark, sf_dir, with_incident=False)).schema
    decoded = msgs.select("key", F.from_json("value", schema).alias("v")).select("key", "v.*")
    return decoded.select(
        "key",
        *[epoch_ms(c) if c == "event_time_ts" else joined(c) if c == "active_rules" else F.col(c) for c in E.ALERT_FIELDS],
    )


def _pricing_output(df: DataFrame) -> DataFrame:
    return df.select(
        "driver_id",
        epoch_s("window_start"),
        r9("exposure_km"),
        r9("speeding_ratio"),
        r9("hard_braking_count_per_100km"),
        r9("harsh_acceleration_count_per_100km"),
        r9("night_event_ratio"),
        r9("bad_weather_event_ratio"),
        "phone_usage_count",
    )


@register("prepare_features")
def q_prepare_features(spark, sf_dir):
    return _pricing_output(P.prepare_features(I.pricing_features(spark, sf_dir)))


@register("expected_claim_rate")
def q_expected_claim_rate(spark, sf_dir):
    df = P.expected_claim_rate(P.prepare_features(I.pricing_features(spark, sf_dir)))
    return df.select("driver_id", "driver_profile", epoch_s("window_start"), r9("expected_claim_rate"))


@register("impute_claim_count")
def q_impute_claim_count(spark, sf_dir):
    return I.training_set(spark, sf_dir).select("driver_id", epoch_s("window_start"), "claim_count")


# --- 2.3 aggregations -------------------------------------------------------------------------


@register("features_tumbling_1m")
def q_features_tumbling(spark, sf_dir):
    return feature_output(W.tumbling_features(flagged_events(spark, sf_dir, with_incident=False)))


@register("features_sliding_5m")
def q_features_sliding(spark, sf_dir):
    return feature_output(W.sliding_features(flagged_events(spark, sf_dir, with_incident=False)))


def decision_window_frame(spark, sf_dir) -> DataFrame:
    return W.decision_windows(flagged_events(spark, sf_dir))


@register("decision_window_features")
def q_decision_windows(spark, sf_dir):
    df = decision_window_frame(spark, sf_dir)
    return df.select(
        *DECISION_WINDOW_OUTPUT,
        r9("risk_intensity"),
        r9("risk_events_per_100km"),
        epoch_s("window_start"),
        epoch_s("window_end"),
    )


@register("window_decisions")
def q_window_decisions(spark, sf_dir):
    return window_decision_output(W.build_window_decision_rows(decision_window_frame(spark, sf_dir)))


def rollup_output(roll: DataFrame) -> DataFrame:
    return roll.select(
        "driver_id",
        r9("exposure_km"),
        r9("speeding_ratio"),
        r9("hard_braking_count_per_100km"),
        r9("harsh_acceleration_count_per_100km"),
        r9("night_event_ratio"),
        r9("bad_weather_event_ratio"),
        "phone_usage_count",
    )


@register("driver_rollup")
def q_driver_rollup(spark, sf_dir):
    return rollup_output(P.driver_rollup(I.training_set(spark, sf_dir)))


@register("mean_frequency")
def q_mean_frequency(spark, sf_dir):
    rolled = P.driver_rollup(I.training_set(spark, sf_dir))
    return P.mean_frequency(P.predict(rolled, C.COMMITTED_COEFFICIENTS)).select(r9("mean_frequency"))


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    from ..operators.model import evaluate

    m = evaluate(I.test_predictions(spark, sf_dir))
    return m.select(
        r9("mae"), r9("rmse"), r9("mean_claim_count"), r9("mean_predicted_claim_count"), "poisson_note"
    )


@register("risk_proxy_by_window")
def q_risk_proxy(spark, sf_dir):
    return R.risk_proxy(I.training_set(spark, sf_dir)).select(epoch_s("window_start"), "risk_proxy")


@register("mean_speeding_by_driver")
def q_top_speeding(spark, sf_dir):
    return R.top_speeding(I.training_set(spark, sf_dir), 15)


@register("driver_risk_score")
def q_top_risk(spark, sf_dir):
    return R.top_risk(I.training_set(spark, sf_dir), 15)


@register("predicted_frequency_by_driver")
def q_top_frequency(spark, sf_dir):
    return R.top_frequency(I.test_predictions(spark, sf_dir), 15)


@register("profile_comparison")
def q_profile_comparison(spark, sf_dir):
    return R.profile_summary(I.training_set(spark, sf_dir))


# --- 2.4 window functions / 2.5 joins / 2.6 sort, set ops --------------------------------------


@register("rolling_last_n_features")
def q_rolling_features(spark, sf_dir):
    rolled = RL.rolling_features(flagged_events(spark, sf_dir), n=C.JobConfig.window_events)
    return rolled.select(
        "driver_id",
        "event_id",
        "event_no",
        "event_count",
        F.round("km_window", 4).alias("km_driven"),
        "risk_event_count",
        "risk_score_window",
        "phone_usage_count",
        "next_seq",
    )


@register("rolling_tick_decisions")
def q_rolling_ticks(spark, sf_dir):
    """Each buffer state with a decision once, with the range of ticks it is judged at (one row per state)."""
    ranges = RL.tick_decision_ranges(flagged_events(spark, sf_dir), n=C.JobConfig.window_events, every=C.JobConfig.tick_every)
    return ranges.drop("decision_ts")


@register("latest_premium")
def q_latest_premium(spark, sf_dir):
    return history_output(P.latest_premium(I.premium_history(spark, sf_dir, 2)))


@register("join_previous_premium")
def q_join_previous(spark, sf_dir):
    rolled = P.driver_rollup(P.prepare_features(I.pricing_features(spark, sf_dir)))
    joined_prev = P.with_previous(rolled, I.premium_history(spark, sf_dir, 2))
    return joined_prev.select("driver_id", "technical_premium_previous")


@register("premium_trajectory_top5")
def q_trajectory(spark, sf_dir):
    traj = R.trajectory(I.premium_history(spark, sf_dir), 5)
    return traj.select("driver_id", "scored_at", "technical_premium", "technical_premium_previous")


@register("top_premiums")
def q_top_premiums(spark, sf_dir):
    run = I.premium_runs(spark, sf_dir)[-1]
    return R.top_premiums(run, 20).select("driver_id", "technical_premium", target_premium())


@register("top_latest_premiums")
def q_top_latest(spark, sf_dir):
    return R.top_latest(I.premium_history(spark, sf_dir), 15).select("driver_id", "scored_at", "technical_premium")


@register("union_history")
def q_union_history(spark, sf_dir):
    return history_output(I.premium_history(spark, sf_dir))


@register("union_decisions")
def q_union_decisions(spark, sf_dir):
    ev = E.build_event_decision_rows(flagged_events(spark, sf_dir), "stream")
    win = W.build_window_decision_rows(decision_window_frame(spark, sf_dir))
    both = W.union_decisions(ev, win)
    return both.select(
        "decision_source",
        "driver_id",
        F.coalesce(F.col("event_id"), F.lit("")).alias("event_id"),
        F.coalesce(F.unix_seconds("window_start"), F.lit(-1)).alias("window_start"),
        "decision_type",
        "priority",
    )


# --- 2.7 scoring with fixed coefficients --------------------------------------------------------


@register("train_test_split")
def q_train_test_split(spark, sf_dir):
    train, test = I.train_test(spark, sf_dir)
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True))).select(
        "driver_id", epoch_s("window_start"), "is_test"
    )


@register("glm_test_predictions")
def q_glm_test_predictions(spark, sf_dir):
    pred = I.test_predictions(spark, sf_dir)
    return pred.select(
        "driver_id",
        epoch_s("window_start"),
        r9("exposure_km"),
        "claim_count",
        r9("predicted_claim_count"),
        r9("predicted_frequency"),
    )


@register("premium_score")
def q_premium_score(spark, sf_dir):
    rolled = P.driver_rollup(P.prepare_features(I.pricing_features(spark, sf_dir)))
    scored = P.score(rolled, C.COMMITTED_COEFFICIENTS, 1000.0)
    return scored.select(
        "driver_id",
        r9("predicted_claim_count"),
        r9("predicted_frequency"),
        r9("risk_multiplier"),
        target_premium(),
    )


@register("premium_cap")
def q_premium_cap(spark, sf_dir):
    return history_output(I.premium_runs(spark, sf_dir)[-1])


# --- 2.7 model fits: what the optimum fixes, so that SQL can tell without fitting ----------------


def moment_output(moments: DataFrame) -> DataFrame:
    """(term, moment) rounded to what the fit's tolerance allows."""
    return moments.select("term", F.round("moment", 4).alias("moment"))


def _fit(spark, sf_dir, kind: str):
    from ..operators.model import fit_glm

    train, _ = I.train_test(spark, sf_dir, materialized=True)  # the fit and the moments both read it
    return fit_glm(train, kind, written=True), train


@register("glm_offset")
def q_glm_offset(spark, sf_dir):
    """Per term, the sum of the feature times the fitted claim count; at the optimum that of the actual count."""
    from ..operators.model import moments

    fit, train = _fit(spark, sf_dir, "offset")
    return moment_output(moments(fit.coefficient_pairs(), train))


@register("glm_rate_weighted")
def q_glm_rate(spark, sf_dir):
    """As ``glm_offset`` for the penalised rate form: the penalty's gradient is part of the moment."""
    from ..operators.model import moments

    fit, train = _fit(spark, sf_dir, "rate")
    return moment_output(moments(fit.coefficient_pairs(), train, C.RATE_MODEL_ALPHA))


@register("glm_coefficients")
def q_glm_coefficients(spark, sf_dir):
    """The coefficient table as it is given out: terms in order, the moment each meets, and how far ``exp_coef`` is from exp(coef)."""
    from ..operators.model import coefficients, moments

    fit, train = _fit(spark, sf_dir, "rate")
    table = coefficients(spark, fit).collect()  # one row per term, in the order of the table
    met = moments([(r["term"], r["coef"]) for r in table], train, C.RATE_MODEL_ALPHA)
    given = [(i, r["term"], round(r["exp_coef"] - math.exp(r["coef"]), 9) + 0.0) for i, r in enumerate(table)]
    return moment_output(met).join(spark.createDataFrame(given, "position int, term string, exp_gap double"), "term")


@register("glm_summary")
def q_glm_summary(spark, sf_dir):
    """The summary text, line by line: how far each term's standard error, z and p are from those of the information
    matrix (summed over the training rows); the number of rows and the null deviance."""
    from ..operators.model import information, standard_errors, summary_rows, summary_text

    fit, train = _fit(spark, sf_dir, "offset")
    errors = standard_errors(information(fit, train))
    rows = []
    for i, (line, error) in enumerate(zip(summary_rows(summary_text(fit)), errors)):
        z = line["coef"] / error
        p = math.erfc(abs(z) / math.sqrt(2.0))
        rows.append((i, line["term"], round(line["std_err"] - error, 4) + 0.0, round(line["z"] - z, 2) + 0.0, round(line["p"] - p, 3) + 0.0))
    s = fit.model.summary
    found = spark.createDataFrame(rows, "position int, term string, std_err_gap double, z_gap double, p_gap double")
    return found.withColumns({"n_rows": F.lit(s.numInstances).cast("long"), "null_deviance": F.lit(round(s.nullDeviance, 4))})


@register("model_dispersion")
def q_model_dispersion(spark, sf_dir):
    """How much more the held-out counts vary than the Poisson form says, for the committed coefficients."""
    from ..operators.model import dispersion

    found = dispersion(I.test_predictions(spark, sf_dir), len(C.COMMITTED_COEFFICIENTS))
    return found.select("n_rows", r9("mean_claim_count"), r9("variance_claim_count"), r9("dispersion"))


@register("glm_tweedie")
def q_glm_tweedie(spark, sf_dir):
    """Two Tweedie fits: per term, how far the estimating equations are from their solution."""
    from ..operators.model import fit_tweedie, tweedie_gradient

    train, _ = I.train_test(spark, sf_dir, materialized=True)
    parts = [
        tweedie_gradient(fit_tweedie(train, power, written=True), train, power).select(F.lit(power).alias("power"), "term", (F.round("gradient", 3) + 0.0).alias("gradient"))
        for power in (1.2, 1.5)
    ]
    return parts[0].unionByName(parts[1])
