import numpy as np
import pytest
from pyspark.sql import functions as F

from monthpanel.operators.features import supervised_sparse, supervised_strict
from monthpanel.operators.learn import (
    RIDGE_ALPHAS, impute_medians, lagged_contest, ridge_by_leave_one_out, sparse_contest, standardize, train_medians,
)
from monthpanel.plans.lifecycle import forecast_contest


def series(n=72):
    t = np.arange(n, dtype=float)
    return 100 + 0.8 * t + 10 * np.sin(2 * np.pi * t / 12) + np.random.default_rng(1).normal(size=n)


@pytest.fixture(scope="module")
def strict(monthly):
    frame = supervised_strict(monthly("2018-01", y=list(series()), x=list(95 + 0.4 * np.arange(72))), "y", windows=[3, 6])
    return frame, [c for c in frame.columns if c not in ("date", "__target__")]


def arrays(frame, features, target="__target__", test=12):
    pdf = frame.toPandas().sort_values("date")
    x, y = pdf[features].to_numpy(float), pdf[target].to_numpy(float)
    mean, std = x[:-test].mean(0), x[:-test].std(0)
    z = (x - mean) / np.where(std == 0, 1, std)
    return z[:-test], y[:-test], z[-test:]


def ridge(z, y, alpha):
    return np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))


def elastic(z, y, alpha, ratio):
    n, p = z.shape
    w, r = np.zeros(p), y - y.mean()
    for _ in range(20000):
        for j in range(p):
            r = r + z[:, j] * w[j]
            rho = z[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / (z[:, j] @ z[:, j] / n + alpha * (1 - ratio))
            r = r - z[:, j] * w[j]
    return w


def predicted(predictions, model):
    return [r["prediction"] for r in predictions.where(F.col("model") == model).orderBy("date").collect()]


def test_linear_models_equal_their_definitions(strict):
    frame, features = strict
    comparison, predictions = lagged_contest(frame, "y", features, 12, models=["ridge_lagged", "elasticnet_lagged"])
    z, y, zt = arrays(frame, features)
    assert np.allclose(predicted(predictions, "ridge_lagged"), y.mean() + zt @ ridge(z, y, 1.0), atol=1e-6)
    assert np.allclose(predicted(predictions, "elasticnet_lagged"), y.mean() + zt @ elastic(z, y, 0.02, 0.2), atol=1e-4)
    assert {r["model"] for r in comparison.collect()} == {"ridge_lagged", "elasticnet_lagged"}
    assert set(predictions.columns) == {"date", "target", "model", "actual", "prediction"}


def test_trees_are_reasonable(strict):
    frame, features = strict
    comparison, predictions = lagged_contest(frame, "y", features, 12, models=["random_forest_lagged", "gradient_boosting_lagged"])
    assert predictions.count() == 24
    spread = float(np.std(series()))
    assert all(0 < r["rmse"] < 2 * spread for r in comparison.collect())


def test_too_short(strict):
    frame, features = strict
    with pytest.raises(ValueError, match="Not enough"):
        lagged_contest(frame.limit(10), "y", features, 12)


def test_leave_one_out_ridge(strict):
    frame, features = strict
    pdf = frame.orderBy("date")
    z, y, zt = arrays(frame, features)
    losses = []
    for alpha in RIDGE_ALPHAS:
        errors = []
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            zi, yi = z[keep], y[keep]
            centre = zi.mean(0)
            w = np.linalg.solve((zi - centre).T @ (zi - centre) + alpha * np.eye(z.shape[1]), (zi - centre).T @ (yi - yi.mean()))
            errors.append((y[i] - yi.mean() - (z[i] - centre) @ w) ** 2)
        losses.append(np.mean(errors))
    best = RIDGE_ALPHAS[int(np.argmin(losses))]
    spark = frame.sparkSession
    rows = [r for r in pdf.collect()]
    train, test = spark.createDataFrame(rows[:-12], frame.schema), spark.createDataFrame(rows[-12:], frame.schema)
    made, alpha = ridge_by_leave_one_out(standardize(train, train, features), standardize(test, train, features), features, "__target__")
    assert alpha == best
    got = [r["prediction"] for r in made.orderBy("date").collect()]
    assert np.allclose(got, y.mean() + zt @ ridge(z, y, best), atol=1e-7)


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (None, None, 6.0), (4.0, None, 9.0), (2.0, None, None)], "a double, b double, c double")
    medians = train_medians(df, ["a", "b", "c"])
    assert medians == {"a": 2.0, "b": None, "c": 6.0}
    filled = impute_medians(df, medians)
    assert filled.columns == ["a", "c"] and sorted(r["a"] for r in filled.collect()) == [1.0, 2.0, 2.0, 4.0]


def test_sparse_contest(monthly):
    n = 60
    df = monthly("2018-01", t=list(series(n)), a=list(np.cos(np.arange(n) / 4)), b=[None] * 20 + [1.0] * 40)
    frame, features = supervised_sparse(df, "t", lags=[1, 2], windows=[3])
    comparison, wide = sparse_contest(frame, features, "t", 6, models=["ridge", "gradient_boosting"])
    assert wide.columns == ["date", "t", "pred_ridge", "pred_gradient_boosting"] and wide.count() == 6
    assert comparison.where("rmse is null").isEmpty()
    with pytest.raises(ValueError, match="cannot be empty"):
        sparse_contest(frame, [], "t", 6)


def test_pooled_contest_keeps_keys_apart(monthly):
    both = monthly("2018-01", y=list(series())).withColumn("k", F.lit("a")).unionByName(
        monthly("2018-01", y=list(series() * 2)).withColumn("k", F.lit("b")))
    made = forecast_contest(both, "y", 12, ["k"], models=["ridge_lagged"])
    assert made["comparison"].count() == 2 and made["improvement"].count() == 2
    counts = {r["model"]: r["count"] for r in made["predictions"].groupBy("model").count().collect()}
    assert counts == {m: 24 for m in ("naive", "moving_average_3", "moving_average_6", "seasonal_naive_12", "ridge_lagged")}
    assert made["lag_correlations"].count() == 24
