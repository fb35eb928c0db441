"""GLM fits: both forms meet their optimum conditions; outputs and store round trip."""

from __future__ import annotations

import math

import numpy as np
import pytest

from conftest import SF01
from roadlens.operators import model as M
from roadlens.plans import inputs as I
from roadlens.session import materialize


def test_fits_meet_optimum_conditions(spark, tmp_path):
    train, test = I.train_test(spark, SF01)
    train = materialize(train)
    for kind in ("offset", "rate"):
        fit = M.fit_glm(train, kind)
        grads = M.score_equations(fit, train)
        scale = 1.0 if kind == "rate" else float(train.count())
        assert max(abs(g) for g in grads) / scale < 1e-8, (kind, grads)
    # the rate model's penalty is on the per-observation scale: regParam = alpha * sum(w) / sum(claims)
    assert fit.reg_param > 0
    coef = M.coefficients(spark, fit).collect()
    assert coef[0]["term"] == "intercept" and len(coef) == 7
    text = M.summary_text(M.fit_glm(train, "offset"))
    assert text.splitlines()[1].startswith("const")


def test_model_store_round_trip(spark):
    from roadlens.session import scratch_path

    train, _ = I.train_test(spark, SF01)
    fit = M.fit_glm(materialize(train), "rate")
    path = scratch_path(spark, "test-model")
    M.save_model(fit, path)
    back = M.load_model(path)
    assert back.kind == "rate" and back.feature_columns == fit.feature_columns
    assert back.coefficient_pairs() == fit.coefficient_pairs()


def test_metrics(spark):
    pred = spark.createDataFrame([(0, 0.5), (2, 1.0)], "claim_count long, predicted_claim_count double")
    m = M.evaluate(pred).first()
    assert m["mae"] == 0.75 and abs(m["rmse"] - ((0.25 + 1.0) / 2) ** 0.5) < 1e-15
    assert m["mean_claim_count"] == 1.0 and m["mean_predicted_claim_count"] == 0.75


def test_iterations_are_the_callers(spark, monkeypatch):
    seen = []

    class Recorded(M.GeneralizedLinearRegression):
        def __init__(self, **kw):
            seen.append(kw["maxIter"])
            super().__init__(**kw)

    monkeypatch.setattr(M, "GeneralizedLinearRegression", Recorded)
    train, _ = I.train_test(spark, SF01)
    train = materialize(train)
    for kind in ("offset", "rate"):
        M.fit_glm(train, kind, max_iter=300, written=True)
        M.fit_glm(train, kind, written=True)
    assert seen == [300, 100, 300, 1000]


def test_no_claims_and_null_features_are_errors(spark):
    from pyspark.sql import functions as F

    train = materialize(I.train_test(spark, SF01)[0])
    with pytest.raises(ValueError):
        M.fit_glm(train.withColumn("claim_count", F.lit(0)), "rate")
    holed = train.withColumn("speeding_ratio", F.when(F.col("d") > 3, F.col("speeding_ratio")))
    with pytest.raises(Exception):
        M.fit_glm(holed, "offset")


def test_deviance_of_the_summary(spark):
    import math

    train = materialize(I.train_test(spark, SF01)[0])
    fit = M.fit_glm(train, "offset", written=True)
    rows = M.predict_with(fit, train).select("claim_count", "predicted_claim_count").collect()
    want = 2 * sum((y * math.log(y / mu) if y else 0.0) - (y - mu) for y, mu in rows)
    assert abs(fit.model.summary.deviance - want) < 1e-6 * want


def test_tweedie_fits_solve_their_equations_and_the_profile_finds_the_power(spark):
    rng = np.random.default_rng(5)
    n = 4000
    x = rng.uniform(0, 1, (n, 2))
    mu = np.exp(0.3 + 0.8 * x[:, 0] - 0.5 * x[:, 1])
    counts = rng.poisson(mu).astype(int)
    heavy = np.where(rng.random(n) < 0.5, 0, rng.poisson(2 * mu * rng.gamma(0.8, 1 / 0.8, n))).astype(int)
    for y, low, high in ((counts, 0.9, 1.1), (heavy, 1.8, 9.0)):
        df = spark.createDataFrame([(float(a), float(b), 1.0, int(c)) for (a, b), c in zip(x, y)], "a double, b double, exposure_km double, claim_count long").repartition(4)
        for power in (1.0, 1.3, 1.7):
            fit = M.fit_tweedie(df, power, ("a", "b"))
            assert max(abs(r.gradient) for r in M.tweedie_gradient(fit, df, power).collect()) < 1e-5
            # the same solution by plain iterations
            design, beta = np.column_stack([np.ones(n), x]), np.array([math.log(y.mean()), 0.0, 0.0])
            for _ in range(60):
                m = np.exp(design @ beta)
                w = m ** (2 - power)
                beta = beta + np.linalg.solve(design.T @ (design * w[:, None]), design.T @ ((y - m) * m ** (1 - power)))
            assert np.allclose([b for _, b in fit.coefficient_pairs()], beta, atol=1e-6)
        pred = M.predict_with(M.fit_tweedie(df, 1.0, ("a", "b")), df)
        row = M.dispersion(pred, 3).first()
        m, c = np.array([(r.predicted_claim_count, r.claim_count) for r in pred.collect()]).T
        assert math.isclose(row.dispersion, ((c - m) ** 2 / m).sum() / (n - 3), rel_tol=1e-9) and low < row.dispersion < high
    best, _ = M.profile_power(df, (1.0, 1.5), ("a", "b"))
    assert best == 1.5  # the heavy counts
    with pytest.raises(ValueError):
        M.fit_tweedie(df, 2.0, ("a", "b"))
