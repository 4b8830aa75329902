"""Lagged regression contests with Spark ML.

With ``keys=[]`` the frame is one series. With keys, one pooled model is fitted
on the rows of all keys; lags, holdout and metrics stay per key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from monthpanel.operators.baselines import compare_models, mark_holdout, union_predictions
from monthpanel.operators.moments import comoments
from monthpanel.operators.quantiles import exact_quantiles
from monthpanel.sources.tables import stored_at

# Parameters of the two model sets.
RIDGE_ALPHA = 1.0
ELASTIC_ALPHA, ELASTIC_L1_RATIO = 0.02, 0.20
FOREST = {"numTrees": 250, "maxDepth": 6, "minInstancesPerNode": 3}
BOOSTING = {"maxIter": 150, "stepSize": 0.05, "maxDepth": 2}
SECOND_FOREST = {"numTrees": 80, "maxDepth": 30, "minInstancesPerNode": 3}
SECOND_BOOSTING = {"maxIter": 120, "stepSize": 0.04, "maxDepth": 2}
RIDGE_ALPHAS = [10 ** (-3 + i / 2) for i in range(13)]


def train_medians(train: DataFrame, features: list[str]) -> dict[str, float | None]:
    """Exact median of each feature over the train rows; None where a feature has no value.

    The long form makes each feature a group of its own, so the medians of all
    features and all pooled keys are found in parallel.
    """
    long = train.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot([], features, "feature", "v")
    rows = exact_quantiles(long, "v", [0.5], ["feature"]).collect()
    found = {r["feature"]: r["quantiles"][0] for r in rows}
    return {c: found.get(c) for c in features}


def impute_medians(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Fill features with their train median; features without one are dropped."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(medians[c])).alias(c) if c in medians else F.col(c)
        for c in df.columns if c not in medians or medians[c] is not None
    ])


def standardize(df: DataFrame, train: DataFrame, features: list[str]) -> DataFrame:
    """z-scores with the train rows' mean and population deviation; constant features become 0."""
    stats = train.agg(*[f(F.col(c)).alias(f"{c}__{n}") for c in features
                        for n, f in (("mean", F.avg), ("std", F.stddev_pop))]).first()
    scaled = {
        c: (F.col(c) - F.lit(stats[f"{c}__mean"])) / F.lit(stats[f"{c}__std"] or 1.0) for c in features
    }
    return df.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def _assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="__features").transform(df)


def _fit(estimator, train: DataFrame, target: str):
    return estimator.setFeaturesCol("__features").setLabelCol(target).setPredictionCol("prediction").fit(train)


def linear_estimator(alpha: float, l1_ratio: float | None, rows: int, label_std: float) -> LinearRegression:
    """Spark estimator with the penalty of ``||y-Xw||^2 + alpha ||w||^2`` (ridge, no ratio) or of
    ``||y-Xw||^2 / 2n + alpha (r |w|_1 + (1-r)/2 ||w||^2)``.

    Spark scales the label by its population deviation, hence the factor on the
    quadratic part. The normal solver reads the rows once, whatever the penalty.
    """
    if l1_ratio is None:
        penalty, mix = alpha * label_std / rows, 0.0
    else:
        l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * label_std
        penalty, mix = l1 + l2, l1 / (l1 + l2)
    return LinearRegression(
        regParam=penalty, elasticNetParam=mix, standardization=False, solver="normal", tol=1e-10, maxIter=20000
    )


def _linear_fit(train: DataFrame, target: str, alpha: float, l1_ratio: float | None):
    facts = train.agg(F.count("*").alias("n"), F.stddev_pop(target).alias("sd")).first()
    return _fit(linear_estimator(alpha, l1_ratio, facts["n"], facts["sd"]), train, target)


def ridge_by_leave_one_out(train: DataFrame, test: DataFrame, features: list[str], target: str,
                           alphas: list[float] = RIDGE_ALPHAS) -> tuple[DataFrame, float]:
    """Ridge on z-scored features with the alpha of least leave-one-out error: ``prediction`` added to test.

    Two passes over the train rows: one sums the co-moments as arrays (only features x
    features numbers reach the driver), one sums the squared left-out errors of
    every alpha, with the leverage of a row taken in the Gram's eigenbasis.
    """
    found = comoments(train, [*features, target]).first()
    n, means = found["n"], np.array(found["mean"])
    mean = float(means[-1])
    product = np.array(found["product"]).reshape(len(means), len(means)) + n * np.outer(means, np.append(means[:-1], 0.0))
    gram = product[:-1, :-1]
    values, vectors = np.linalg.eigh(gram)
    values = np.clip(values, 0.0, None)
    moment = vectors.T @ product[:-1, -1]
    shrink = 1.0 / (values[:, None] + np.array(alphas)[None, :])

    @pandas_udf("array<double>")
    def left_out_errors(row: pd.Series, label: pd.Series) -> pd.Series:
        u = np.stack(row.to_numpy()) @ vectors
        error = label.to_numpy()[:, None] - u @ (moment[:, None] * shrink)
        leverage = 1.0 / n + (u * u) @ shrink
        return pd.Series(list((error / (1.0 - leverage)) ** 2))

    values_of_row = F.array(*[F.col(c).cast("double") for c in features])
    errors = train.select(left_out_errors(values_of_row, F.col(target) - F.lit(mean)).alias("e"))
    loss = errors.agg(*[F.avg(F.get("e", F.lit(k))).alias(f"a{k}") for k in range(len(alphas))]).first()
    best = int(np.argmin(list(loss)))
    weights = vectors @ (moment * shrink[:, best])
    terms = F.zip_with(values_of_row, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
    prediction = F.aggregate(terms, F.lit(mean), lambda a, b: a + b)
    return test.withColumn("prediction", prediction), alphas[best]


def _holdout(frame: DataFrame, target: str, test_size: int, keys: list[str], folder: str | None) -> tuple[DataFrame, DataFrame]:
    """Mark the holdout; keys too short for it take no part."""
    marked = stored_at(mark_holdout(frame, test_size, keys).where("train_rows > 0").drop("step", "train_rows"), folder)
    return marked.where("part = 'train'").drop("part"), marked.where("part = 'test'").drop("part")


def _long(scored: DataFrame, model: str, target_name: str, target: str, keys: list[str]) -> DataFrame:
    return scored.select(
        *keys, "date", F.lit(target_name).alias("target"), F.lit(model).alias("model"),
        F.col(target).alias("actual"), "prediction",
    )


def _check_rows(train: DataFrame, test_size: int) -> None:
    if train.isEmpty():
        raise ValueError(f"Not enough supervised rows for test_size={test_size}.")


def lagged_contest(frame: DataFrame, target_name: str, features: list[str], test_size: int = 12,
                   keys: list[str] = (), models: list[str] | None = None, seed: int = 42,
                   folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Ridge, elastic net, random forest and boosting on a supervised frame (``__target__``).

    Returns the comparison and the long predictions. Every fit reads the frame; with a ``folder`` it is written
    there once and read from there, else it is computed each time.
    """
    train, test = _holdout(frame, "__target__", test_size, keys, folder)
    _check_rows(train, test_size)
    linear = (_assembled(standardize(train, train, features), features),
              _assembled(standardize(test, train, features), features))
    raw = (_assembled(train, features), _assembled(test, features))
    fits = {
        "ridge_lagged": lambda: _linear_fit(linear[0], "__target__", RIDGE_ALPHA, None).transform(linear[1]),
        "elasticnet_lagged": lambda: _linear_fit(
            linear[0], "__target__", ELASTIC_ALPHA, ELASTIC_L1_RATIO).transform(linear[1]),
        "random_forest_lagged": lambda: _fit(
            RandomForestRegressor(featureSubsetStrategy="all", seed=seed, **FOREST), raw[0], "__target__"
        ).transform(raw[1]),
        "gradient_boosting_lagged": lambda: _fit(
            GBTRegressor(seed=seed, **BOOSTING), raw[0], "__target__").transform(raw[1]),
    }
    predictions = union_predictions([
        _long(fits[m](), m, target_name, "__target__", keys) for m in models or fits
    ])
    return compare_models(predictions, keys), predictions


def sparse_contest(frame: DataFrame, features: list[str], target: str, test_size: int = 12,
                   keys: list[str] = (), models: list[str] | None = None, seed: int = 42,
                   folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Second model set with median imputation: ridge with chosen alpha, forest, boosting.

    Returns the comparison and wide predictions, ``pred_<model>`` per column; ``folder`` as in ``lagged_contest``.
    """
    if not features:
        raise ValueError("feature_cols cannot be empty")
    rows = frame.select(*keys, "date", F.col(target).cast("double").alias(target),
                        *[F.col(c).cast("double").alias(c) for c in features if c != target])
    train, test = _holdout(rows, target, test_size, keys, folder)
    _check_rows(train, test_size)
    medians = train_medians(train, features)
    used = [c for c in features if medians[c] is not None]
    train, test = impute_medians(train, medians), impute_medians(test, medians)
    raw = (_assembled(train, used), _assembled(test, used))
    fits = {
        "ridge": lambda: ridge_by_leave_one_out(
            standardize(train, train, used), standardize(test, train, used), used, target)[0],
        "random_forest": lambda: _fit(
            RandomForestRegressor(featureSubsetStrategy="all", seed=seed, **SECOND_FOREST), raw[0], target
        ).transform(raw[1]),
        "gradient_boosting": lambda: _fit(
            GBTRegressor(seed=seed, **SECOND_BOOSTING), raw[0], target).transform(raw[1]),
    }
    chosen = list(models or fits)
    predictions = union_predictions([_long(fits[m](), m, target, target, keys) for m in chosen])
    return compare_models(predictions, keys), wide_predictions(predictions, chosen, target, keys)


def wide_predictions(predictions: DataFrame, models: list[str], target: str, keys: list[str] = ()) -> DataFrame:
    """Long predictions as one row per month: the actual value and ``pred_<model>`` columns."""
    wide = predictions.groupBy(*keys, "date", F.col("actual").alias(target)).pivot("model", models)
    values = wide.agg(F.max("prediction"))
    return values.select(*keys, "date", target, *[F.col(m).alias(f"pred_{m}") for m in models])
