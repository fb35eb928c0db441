"""Poisson claim-frequency GLMs on Spark ML, their outputs and the model store.

Two forms:
* ``offset``: claim_count ~ Poisson, log link, offset ln(max(exposure, .001));
* ``rate``: claims / exposure ~ Poisson, weight = exposure, L2 penalty.  The
  penalty is given in the per-observation scale (``alpha``) and converted to
  Spark's ``regParam``: Spark's IRLS normalises the penalised least squares by
  the sum of working weights, which at the optimum equals the sum of claims,
  so ``regParam = alpha * sum(exposure) / sum(claims)`` meets the optimum
  condition (1/sum w) X'W(y - mu) = alpha * beta.

Fitting is iteratively reweighted least squares over the distributed rows
(one aggregation pass per iteration); only the 7 coefficients come back to
the driver.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import materialize
from .pricing import exposure, predict


@dataclass
class GlmFit:
    model: GeneralizedLinearRegressionModel
    kind: str
    feature_columns: tuple[str, ...]
    reg_param: float = 0.0

    def coefficient_pairs(self) -> list[tuple[str, float]]:
        intercept_name = "intercept" if self.kind == "rate" else "const"
        pairs = [(intercept_name, float(self.model.intercept))]
        pairs += [(name, float(b)) for name, b in zip(self.feature_columns, self.model.coefficients.toArray())]
        return pairs


def _design(df: DataFrame, features) -> DataFrame:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return assembler.transform(df.withColumn("exposure_c", exposure()))


def fit_glm(
    train: DataFrame,
    kind: str = "rate",
    features=C.FEATURE_COLUMNS,
    alpha: float = C.RATE_MODEL_ALPHA,
    max_iter: int | None = None,
    label: str = "claim_count",
    written: bool = False,
) -> GlmFit:
    """Fit one of the two forms.  ``max_iter`` defaults to the form's own number of iterations.

    IRLS reads the training rows once per iteration, so they are written to
    the shared folder first, unless the caller says that ``train`` already is
    a ``written`` table.  Rows with a null feature or label are an error, and
    so is the rate form without any claim (its optimum does not exist).
    """
    columns = [label, "exposure_km", *features]
    data = _design(train if written else materialize(train.select(*columns), "design"), features)
    if kind == "offset":
        glr = GeneralizedLinearRegression(
            family="poisson", link="log", labelCol=label, featuresCol="features", offsetCol="log_exposure",
            maxIter=C.OFFSET_MODEL_MAX_ITER if max_iter is None else max_iter, regParam=0.0, tol=1e-10,
        )
        design = data.select(
            F.col(label).cast("double").alias(label), F.log("exposure_c").alias("log_exposure"), "features"
        )
        model = glr.fit(design)
        return GlmFit(model, kind, tuple(features), 0.0)
    if kind != "rate":
        raise ValueError(f"unknown model kind {kind!r}")
    design = data.select((F.col(label) / F.col("exposure_c")).alias("rate"), "exposure_c", "features", label)
    totals = design.agg(F.sum("exposure_c").alias("w"), F.sum(label).alias("y")).first()  # one row
    if not totals["y"]:
        raise ValueError("no claims in the training rows: the penalised rate model has no optimum")
    reg = alpha * float(totals["w"]) / float(totals["y"])
    glr = GeneralizedLinearRegression(
        family="poisson", link="log", labelCol="rate", featuresCol="features", weightCol="exposure_c",
        maxIter=C.RATE_MODEL_MAX_ITER if max_iter is None else max_iter, regParam=reg, tol=1e-10,
    )
    model = glr.fit(design)
    return GlmFit(model, kind, tuple(features), reg)


def coefficients(spark: SparkSession, fit: GlmFit) -> DataFrame:
    """term, coef, exp_coef; intercept first (7 rows)."""
    rows = [(t, b) for t, b in fit.coefficient_pairs()]
    df = spark.createDataFrame(rows, "term string, coef double")
    return df.withColumn("exp_coef", F.exp("coef"))


def summary_text(fit: GlmFit) -> str:
    """Estimates with standard errors, z and p values (unpenalised fits); intercept and coefficients otherwise."""
    pairs = fit.coefficient_pairs()
    if fit.reg_param == 0.0:
        s = fit.model.summary
        # Spark lists the intercept last in the per-coefficient statistics.
        se, z, p = s.coefficientStandardErrors, s.tValues, s.pValues
        order = [len(pairs) - 1, *range(len(pairs) - 1)]
        lines = [f"{'term':40s} {'coef':>14s} {'std_err':>12s} {'z':>10s} {'p':>10s}"]
        for (term, b), i in zip(pairs, order):
            lines.append(f"{term:40s} {b:14.6f} {se[i]:12.6f} {z[i]:10.3f} {p[i]:10.4f}")
        lines.append(f"deviance={s.deviance} null_deviance={s.nullDeviance} aic={s.aic} iterations={s.numIterations}")
        return "\n".join(lines) + "\n"
    return (
        "Poisson GLM on claim frequency with exposure_km as weight, L2 penalty.\n"
        f"intercept={pairs[0][1]}\n"
        f"coefficients={dict(pairs[1:])}\n"
    )


def summary_rows(text: str) -> list[dict]:
    """The lines of a summary with one term each: term, coef, std_err, z, p."""
    head, *lines = text.splitlines()
    names = head.split()
    return [dict(zip(names, [term, *map(float, rest)])) for term, *rest in (line.split() for line in lines if "=" not in line)]


def information(fit: GlmFit, train: DataFrame) -> np.ndarray:
    """X'WX of an unpenalised fit at its solution (W: the fitted counts), intercept first; one distributed sum per pair of terms."""
    terms = [F.lit(1.0), *[F.col(c).cast("double") for c in fit.feature_columns]]
    pairs = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
    sums = predict_with(fit, train).agg(*[F.sum(F.col("predicted_claim_count") * terms[i] * terms[j]) for i, j in pairs]).first()  # one row
    out = np.zeros((len(terms), len(terms)))
    for (i, j), v in zip(pairs, sums):
        out[i, j] = out[j, i] = v
    return out


def standard_errors(matrix: np.ndarray) -> list[float]:
    """Of each term, from the information matrix."""
    return np.sqrt(np.diag(np.linalg.inv(matrix))).tolist()


def predict_with(fit: GlmFit, df: DataFrame) -> DataFrame:
    """predicted_claim_count and predicted_frequency for rows of ``df`` (both model forms give the same values)."""
    return predict(df, fit.coefficient_pairs())


def dispersion(pred: DataFrame, n_terms: int, power: float = 1.0) -> DataFrame:
    """One row: rows, mean and variance of the counts, and Pearson's dispersion for the variance ``mean ** power``.

    Above 1 for the Poisson form (``power`` 1), the counts vary more than it
    says, and its standard errors are too small by the square root.
    """
    mu = F.col("predicted_claim_count")
    resid = F.col("claim_count") - mu
    return pred.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col("claim_count").cast("double")).alias("mean_claim_count"),
        F.var_samp(F.col("claim_count").cast("double")).alias("variance_claim_count"),
        (F.sum(resid * resid / F.pow(mu, F.lit(float(power)))) / (F.count(F.lit(1)) - F.lit(n_terms))).alias("dispersion"),
    )


def fit_tweedie(train: DataFrame, power: float, features=C.FEATURE_COLUMNS, label: str = "claim_count", written: bool = False) -> GlmFit:
    """Counts with the variance ``dispersion * mean ** power``, log link, offset ln(exposure); ``power`` between 1 and 2."""
    if not 1.0 <= power < 2.0:
        raise ValueError("power must be at least 1 and below 2: counts may be 0")
    data = _design(train if written else materialize(train.select(label, "exposure_km", *features), "design"), features)
    glr = GeneralizedLinearRegression(
        family="tweedie", variancePower=float(power), linkPower=0.0, labelCol=label, featuresCol="features", offsetCol="log_exposure",
        maxIter=C.OFFSET_MODEL_MAX_ITER, regParam=0.0, tol=1e-10,
    )
    design = data.select(F.col(label).cast("double").alias(label), F.log("exposure_c").alias("log_exposure"), "features")
    return GlmFit(glr.fit(design), "tweedie", tuple(features), 0.0)


def tweedie_gradient(fit: GlmFit, train: DataFrame, power: float, label: str = "claim_count") -> DataFrame:
    """(term, gradient): the estimating equations of ``fit_tweedie``, all 0 at its solution."""
    pred = predict_with(fit, train)
    weighted = (F.col(label) - F.col("predicted_claim_count")) * F.pow("predicted_claim_count", F.lit(1.0 - power))
    terms = [t for t, _ in fit.coefficient_pairs()]
    sums = [F.sum(weighted * (F.lit(1.0) if i == 0 else F.col(t))).alias(t) for i, t in enumerate(terms)]
    row = pred.agg(*sums).first()
    return train.sparkSession.createDataFrame([(t, float(row[t])) for t in terms], "term string, gradient double")


#: Added to a count where its variance is taken, so that 0 has one (the usual sixth).
ZERO_SHIFT = 1.0 / 6.0


def quasi_likelihood(fit: GlmFit, train: DataFrame, power: float, label: str = "claim_count") -> float:
    """Extended quasi-likelihood of a fit: comparable between powers, one distributed sum."""
    pred = predict_with(fit, train)
    y, mu = F.col(label).cast("double"), F.col("predicted_claim_count")
    if power == 1.0:
        unit = 2.0 * (F.when(y > 0, y * F.log(y / mu)).otherwise(0.0) - (y - mu))
    else:
        a, b = 1.0 - power, 2.0 - power
        unit = 2.0 * (F.when(y > 0, F.pow(y, F.lit(b))).otherwise(0.0) / (a * b) - y * F.pow(mu, F.lit(a)) / a + F.pow(mu, F.lit(b)) / b)
    phi = float(dispersion(pred, len(fit.feature_columns) + 1, power).first()["dispersion"])
    spread = F.log(F.lit(2.0 * math.pi * phi) * F.pow(y + F.lit(ZERO_SHIFT), F.lit(power)))
    return float(pred.agg(F.sum(-(unit / F.lit(phi) + spread) / 2.0)).first()[0])


def profile_power(train: DataFrame, powers=(1.0, 1.2, 1.4, 1.6, 1.8), features=C.FEATURE_COLUMNS, label: str = "claim_count") -> tuple[float, GlmFit]:
    """The power (and its fit) with the highest extended quasi-likelihood; the rows are written once for all fits."""
    rows = materialize(train.select(label, "exposure_km", *features), "design")
    fits = [(p, fit_tweedie(rows, p, features, label, written=True)) for p in powers]
    return max(fits, key=lambda f: quasi_likelihood(f[1], rows, f[0], label))


def evaluate(pred: DataFrame) -> DataFrame:
    """One row: MAE, RMSE, mean actual, mean predicted, and the dispersion note."""
    err = F.col("claim_count") - F.col("predicted_claim_count")
    return pred.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.col("claim_count").cast("double")).alias("mean_claim_count"),
        F.avg("predicted_claim_count").alias("mean_predicted_claim_count"),
    ).withColumn("poisson_note", F.lit(C.METRICS_NOTE))


def score_equations(fit: GlmFit, train: DataFrame, label: str = "claim_count") -> list[float]:
    """Gradient of the fitted objective at the solution (all ~0 at the optimum); for tests."""
    pred = predict_with(fit, train).withColumn("exposure_c", exposure())
    resid = F.col(label) - F.col("predicted_claim_count")  # w * (y/e - mu/e) = claims - predicted count
    sums = [F.sum(resid).alias("intercept")] + [F.sum(resid * F.col(c)).alias(c) for c in fit.feature_columns]
    row = pred.agg(*sums, F.sum("exposure_c").alias("w")).first()
    if fit.kind == "offset":
        return [float(row[i]) for i in range(len(sums))]
    w = float(row["w"])
    betas = [b for _, b in fit.coefficient_pairs()]
    grads = [float(row[0]) / w]
    grads += [float(row[i + 1]) / w - fit_alpha(fit, train) * betas[i + 1] for i in range(len(fit.feature_columns))]
    return grads


def fit_alpha(fit: GlmFit, train: DataFrame, label: str = "claim_count") -> float:
    totals = train.withColumn("exposure_c", exposure()).agg(F.sum("exposure_c").alias("w"), F.sum(label).alias("y")).first()
    return fit.reg_param * float(totals["y"]) / float(totals["w"])


def moments(pairs: list[tuple[str, float]], train: DataFrame, alpha: float | None = None, label: str = "claim_count") -> DataFrame:
    """(term, moment): per term the sum of feature times predicted count, plus the penalty's gradient if ``alpha`` is given.

    At the optimum each equals the sum of feature times actual count, which
    needs no fit to compute.
    """
    pred = predict(train, pairs).withColumn("exposure_c", exposure())
    terms = [t for t, _ in pairs]
    sums = [F.sum(F.col("predicted_claim_count") * (F.lit(1.0) if i == 0 else F.col(t))).alias(t) for i, t in enumerate(terms)]
    row = pred.agg(*sums, F.sum("exposure_c").alias("exposure_sum")).first()
    rows = [(t, float(row[t]) + (alpha * float(row["exposure_sum"]) * b if alpha and i else 0.0)) for i, (t, b) in enumerate(pairs)]
    return train.sparkSession.createDataFrame(rows, "term string, moment double")


def save_model(fit: GlmFit, path: str) -> None:
    """Spark ML writer for the model + a one-line JSON with its form and feature list."""
    fit.model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    meta = json.dumps({"model_type": fit.kind, "feature_columns": list(fit.feature_columns), "reg_param": fit.reg_param})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(path: str) -> GlmFit:
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    model = GeneralizedLinearRegressionModel.load(f"{path}/model")
    return GlmFit(model, meta["model_type"], tuple(meta["feature_columns"]), float(meta.get("reg_param", 0.0)))
