"""Pricing: features, label rule, scoring, cap and rounding (T15-T19, T21), golden rows of the committed run."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens import config as C
from roadlens.operators import pricing as P
from roadlens.schemas import PREMIUM_HISTORY_COLUMNS

# fixed values: two rows of the committed premium run (roll-up features and scored outputs) and its mean frequency
GOLDEN = [
    ("D001", 35.64339402325726, 0.06891611382129623, 38.077249760695096, 29.686029173702018, 0.10391003227292675,
     0.15679291771404527, 2, 0.9252976980127371, 0.025959865028818013, 0.6449073338437774, 644.9073338437775, 900.0),
    ("D002", 32.39399638342718, 0.21503527673831885, 97.90086705482497, 76.24275128996958, 0.17311133831039702,
     0.30185889516669606, 5, 1.371234565446689, 0.04232989808408495, 1.0515794933826357, 1051.5794933826357, 1051.58),
]
GOLDEN_MEAN_FREQUENCY = 0.04025363593571183


def test_golden_rows_reproduce(spark):
    cols = ["driver_id", *["exposure_km", *C.FEATURE_COLUMNS[:5], "phone_usage_count"]]
    df = spark.createDataFrame([g[:8] for g in GOLDEN], cols)
    pred = P.predict(df, C.COMMITTED_COEFFICIENTS).withColumn(
        "risk_multiplier", F.col("predicted_frequency") / F.lit(GOLDEN_MEAN_FREQUENCY)
    ).withColumn("target_technical_premium", F.lit(1000.0) * F.col("risk_multiplier"))
    capped = P.cap_change(pred.withColumn("technical_premium_previous", F.lit(1000.0)), 0.10, "t")
    got = {r["driver_id"]: r for r in capped.collect()}
    for g in GOLDEN:
        r = got[g[0]]
        assert abs(r["predicted_claim_count"] / g[8] - 1) < 1e-12
        assert abs(r["predicted_frequency"] / g[9] - 1) < 1e-12
        assert abs(r["risk_multiplier"] / g[10] - 1) < 1e-12
        assert r["technical_premium"] == g[12]


def _cap(spark, prev, target):
    df = spark.createDataFrame([(prev, target)], "technical_premium_previous double, target_technical_premium double")
    return P.cap_change(df, 0.10, "t").first()["technical_premium"]


def test_cap_then_round_half_even(spark):
    assert _cap(spark, 1000.0, 899.994) == 900.0
    assert _cap(spark, 1000.0, 1100.006) == 1100.0
    assert _cap(spark, 1000.0, 1050.125) == 1050.12
    assert _cap(spark, 1000.0, 1050.135) == 1050.14


def test_latest_premium_tie_break_and_first_time_driver(spark):
    hist = spark.createDataFrame(
        [("D1", "2026-01-01T00:00:00+00:00", 990.0), ("D1", "2026-02-01T00:00:00+00:00", 1010.0),
         ("D1", "2026-02-01T00:00:00+00:00", 1020.0), ("D2", "2026-01-01T00:00:00+00:00", 950.0)],
        "driver_id string, scored_at string, technical_premium double",
    )
    latest = {r["driver_id"]: r["technical_premium"] for r in P.latest_premium(hist).collect()}
    assert latest == {"D1": 1020.0, "D2": 950.0}
    assert P.latest_premium(hist, "D2").first()["technical_premium"] == 950.0
    assert P.latest_premium(hist, "D9").count() == 0
    scored = spark.createDataFrame([("D1",), ("D3",)], "driver_id string")
    prev = {r["driver_id"]: r["technical_premium_previous"] for r in P.with_previous(scored, hist, 1000.0).collect()}
    assert prev == {"D1": 1020.0, "D3": 1000.0}


def test_prepare_features_floor_and_missing_columns(spark):
    df = spark.createDataFrame([("D1", 0.0, 2, 1)], "driver_id string, exposure_km double, hard_braking_count long, harsh_acceleration_count long")
    r = P.prepare_features(df).first()
    assert r["exposure_km"] == 0.001
    assert r["hard_braking_count_per_100km"] == 2 / 0.001 * 100
    assert r["speeding_ratio"] == 0.0 and r["phone_usage_count"] == 0.0


def test_profile_effect_unknown_and_null(spark):
    df = spark.createDataFrame(
        [("safe",), ("pirate",), (None,)], "driver_profile string"
    ).withColumns({c: F.lit(0.0) for c in C.FEATURE_COLUMNS}).withColumn("exposure_km", F.lit(1.0))
    rates = [r["expected_claim_rate"] for r in P.expected_claim_rate(df).collect()]
    import math

    assert abs(rates[0] - math.exp(-5.15 - 0.45)) < 1e-15
    assert rates[1] == rates[2] == math.exp(-5.15)


def poisson_inverse_cdf(lam, u, max_count: int = 30):
    """Smallest k with P(X <= k) >= u for X ~ Poisson(lam), searched over 0..max_count.

    Computed as the number of k in [0, max_count] whose CDF is still below u,
    with the pmf built by the recurrence p(k) = p(k-1) * lam / k inside one
    ``aggregate`` over a literal sequence (JVM-side, per row, no UDF).
    """
    p0 = F.exp(-lam)
    init = F.struct(p0.alias("pmf"), p0.alias("cdf"), F.when(p0 < u, 1).otherwise(0).alias("n"))

    def step(acc, k):
        pmf = acc["pmf"] * lam / k.cast("double")
        cdf = acc["cdf"] + pmf
        return F.struct(pmf.alias("pmf"), cdf.alias("cdf"), (acc["n"] + F.when(cdf < u, 1).otherwise(0)).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max_count)), init, step)["n"].cast("long")


def test_poisson_inverse_cdf_moments(spark):
    n = 20000
    df = spark.range(n).withColumn("u", (F.col("id") + F.lit(0.5)) / F.lit(float(n)))
    stats = df.select(poisson_inverse_cdf(F.lit(0.7), F.col("u")).alias("k")).agg(
        F.avg("k").alias("m"), F.var_pop("k").alias("v")
    ).first()
    assert abs(stats["m"] - 0.7) < 0.01 and abs(stats["v"] - 0.7) < 0.02


def test_rollup_sums_exposure_and_phone_means_rates(spark):
    df = spark.createDataFrame(
        [("D1", 1.0, 0.2, 10.0, 5.0, 0.1, 0.0, 1), ("D1", 3.0, 0.4, 30.0, 15.0, 0.3, 1.0, 2), (None, 9.0, 1.0, 1.0, 1.0, 1.0, 1.0, 9)],
        ["driver_id", "exposure_km", *C.FEATURE_COLUMNS[:5], "phone_usage_count"],
    )
    r = P.driver_rollup(df).collect()
    assert len(r) == 1 and r[0]["exposure_km"] == 4.0 and r[0]["phone_usage_count"] == 3
    assert abs(r[0]["speeding_ratio"] - 0.3) < 1e-15


def test_premium_run_has_history_columns(spark):
    feats = spark.createDataFrame(
        [("D1", 1.0, 0.1, 0, 0, 0.0, 0.0, 0), ("D2", 2.0, 0.5, 3, 2, 0.5, 0.5, 1)],
        ["driver_id", "exposure_km", "speeding_ratio", "hard_braking_count", "harsh_acceleration_count",
         "night_event_ratio", "bad_weather_event_ratio", "phone_usage_count"],
    )
    run = P.premium_run(feats, C.COMMITTED_COEFFICIENTS, None, scored_at="s1")
    assert tuple(run.columns) == PREMIUM_HISTORY_COLUMNS
    rows = run.collect()
    assert all(r["technical_premium_previous"] == 1000.0 for r in rows)
    assert abs(sum(r["risk_multiplier"] for r in rows) / 2 - 1.0) < 1e-12


def test_single_driver_lookup_pushes_the_filter_into_the_scan(spark):
    from roadlens.session import scratch_path
    from roadlens.sources import io as IO

    path = scratch_path(spark, "history-pushdown") + "/premium_history"
    feats = spark.createDataFrame(
        [("D1", 1.0, 0.1, 0, 0, 0.0, 0.0, 0), ("D2", 2.0, 0.5, 3, 2, 0.5, 0.5, 1)],
        ["driver_id", "exposure_km", "speeding_ratio", "hard_braking_count", "harsh_acceleration_count",
         "night_event_ratio", "bad_weather_event_ratio", "phone_usage_count"],
    )
    IO.append_history(P.premium_run(feats, C.COMMITTED_COEFFICIENTS, None, scored_at="s1"), path)
    lookup = P.latest_premium(IO.load_history(spark, path), "D2")
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(driver_id), EqualTo(driver_id,D2)]" in plan
    assert lookup.first()["driver_id"] == "D2"


def test_unrolled_poisson_draw_equals_the_recurrence(spark):
    df = spark.range(5000).select(
        (F.col("id") % 97 / F.lit(40.0) + F.lit(0.0001)).alias("lam"),
        ((F.col("id") * 7919 % 10007 + F.lit(0.5)) / F.lit(10007.0)).alias("u"),
        "id",
    )
    a = P._poisson_draw(df, F.col("lam"), F.col("u"), "k").select("id", "k")
    b = df.select("id", poisson_inverse_cdf(F.col("lam"), F.col("u")).alias("k"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_missing_exposure_stays_missing_in_training_features(spark):
    df = spark.createDataFrame([("D1", None, 1, 1), ("D2", 0.0, 1, 1)], "driver_id string, exposure_km double, hard_braking_count long, harsh_acceleration_count long")
    rows = {r["driver_id"]: r for r in P.prepare_features(df).collect()}
    assert rows["D1"]["exposure_km"] is None and rows["D1"]["hard_braking_count_per_100km"] is None
    assert rows["D2"]["exposure_km"] == 0.001


def test_hash_uniform_and_split_are_stable_under_repartitioning(spark):
    from roadlens.functions.expressions import hash_uniform

    df = spark.range(2000).select(
        F.concat(F.lit("D"), (F.col("id") % 37).cast("string")).alias("driver_id"),
        F.timestamp_seconds(F.col("id") * 60).alias("window_start"),
    )
    u = hash_uniform(F.col("driver_id"), F.col("window_start"))
    a = df.select("driver_id", "window_start", u.alias("u"))
    b = df.repartition(7, "window_start").select("driver_id", "window_start", u.alias("u"))
    assert a.exceptAll(b).count() == 0
    stats = a.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0.0 < stats[0] and stats[1] < 1.0 and abs(stats[2] - 0.5) < 0.03
    _, test1 = P.split(df)
    _, test2 = P.split(df.repartition(5))
    assert test1.exceptAll(test2).count() == 0 and abs(test1.count() / 2000 - 0.25) < 0.04


def test_history_csv_is_read_by_column_name(spark):
    from roadlens.session import scratch_path
    from roadlens.sources import io as IO

    folder = scratch_path(spark, "history-csv")
    path = f"{folder}/premium_history.csv"
    # an older file: columns in another order and without premium_change_cap
    spark.createDataFrame(
        [("2026-01-01T00:00:00+00:00", 1010.5, "D7", 1000.0)],
        "scored_at string, technical_premium double, driver_id string, base_premium double",
    ).write.option("header", True).csv(path)
    r = IO.load_history(spark, path).first()
    assert (r["driver_id"], r["technical_premium"], r["base_premium"]) == ("D7", 1010.5, 1000.0)
    assert r["premium_change_cap"] is None and r["scored_at"].startswith("2026-01-01")


def test_split_loses_no_row(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, flag boolean")
    train, test = P.split(df, F.col("flag"))
    assert sorted(r["id"] for r in train.collect()) == [2, 3] and [r["id"] for r in test.collect()] == [1]


def test_every_driver_is_in_every_run(spark):
    from conftest import SF001
    from roadlens.plans import inputs as I

    drivers = I.pricing_features(spark, SF001).select("driver_id").distinct().count()
    assert [run.select("driver_id").distinct().count() for run in I.premium_runs(spark, SF001)] == [drivers] * 3


def test_stamp_is_utc_in_any_session_zone_and_instants_decide(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    feats = spark.createDataFrame(
        [("D1", 1.0, 0.1, 0, 0, 0.0, 0.0, 0)],
        ["driver_id", "exposure_km", "speeding_ratio", "hard_braking_count", "harsh_acceleration_count",
         "night_event_ratio", "bad_weather_event_ratio", "phone_usage_count"],
    )
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        stamp = P.premium_run(feats, C.COMMITTED_COEFFICIENTS).first()["scored_at"]
        import datetime

        assert stamp.endswith("+00:00")
        assert abs((datetime.datetime.now(datetime.timezone.utc) - datetime.datetime.fromisoformat(stamp)).total_seconds()) < 120
        rows = [("D1", "2026-01-01T09:30:00-08:00", 2.0), ("D1", "2026-01-01T17:00:00+00:00", 1.0), ("D1", "2026-01-01T17:20:00Z", 3.0), ("D1", "soon", 9.0)]
        history = spark.createDataFrame(rows, "driver_id string, scored_at string, technical_premium double")
        assert P.latest_premium(history).first()["technical_premium"] == 2.0  # 17:30 UTC
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_history_of_mixed_files_is_read_by_name(spark):
    from roadlens.session import scratch_path
    from roadlens.sources import io as IO

    feats = spark.createDataFrame(
        [("D1", 1.0, 0.1, 0, 0, 0.0, 0.0, 0), ("D2", 2.0, 0.5, 3, 2, 0.5, 0.5, 1)],
        ["driver_id", "exposure_km", "speeding_ratio", "hard_braking_count", "harsh_acceleration_count",
         "night_event_ratio", "bad_weather_event_ratio", "phone_usage_count"],
    )
    run = P.premium_run(feats, C.COMMITTED_COEFFICIENTS, None, scored_at="2026-01-02T00:00:00+00:00")
    for name in ("h.csv", "h.parquet"):
        path = scratch_path(spark, "mixed") + f"/{name}"
        old = spark.createDataFrame([("2026-01-01T00:00:00+00:00", 7.5, "D7")], "scored_at string, technical_premium double, driver_id string")
        old.write.option("header", True).csv(path) if name.endswith("csv") else old.write.parquet(path)
        IO.append_history(run, path)
        IO.append_history(run.withColumn("extra", F.lit(1)).select("extra", *reversed(run.columns)), path)
        history = IO.load_history(spark, path)
        assert tuple(history.columns) == PREMIUM_HISTORY_COLUMNS
        rows = {r["driver_id"]: r for r in history.collect()}
        assert history.count() == 5 and rows["D7"]["technical_premium"] == 7.5 and rows["D7"]["exposure_km"] is None
        assert rows["D2"]["exposure_km"] == 2.0 and rows["D2"]["premium_change_cap"] == 0.1


def test_reports_leave_out_rows_without_a_driver(spark):
    from roadlens.operators import reports as R

    cols = ["speeding_ratio", "hard_braking_count_per_100km", "harsh_acceleration_count_per_100km", "night_event_ratio", "bad_weather_event_ratio"]
    df = spark.createDataFrame([(None, *[9.0] * 5, 9.0), ("D1", *[1.0] * 5, 1.0)], ["driver_id", *cols, "predicted_frequency"])
    for top in (R.top_speeding, R.top_risk, R.top_frequency):
        assert [r["driver_id"] for r in top(df).collect()] == ["D1"]
