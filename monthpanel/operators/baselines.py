"""Temporal holdout and simple forecasters, for all keys at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.functions.stats import forecast_errors

# The baseline contest's models and what a failing one reports.
BASELINES = {"naive": 1, "moving_average_3": 3, "moving_average_6": 6, "seasonal_naive_12": 12}
SHORT_FOR = {
    "naive": "Cannot fit NaiveForecaster on an empty series",
    "moving_average": "Series length must be at least the moving-average window",
    "seasonal_naive": "Series length must be at least the season length",
}
TRAINED = "trained"


def _positive(value: int, name: str) -> None:
    if value <= 0:
        raise ValueError(f"{name} must be positive")


def mark_holdout(df: DataFrame, test_size: int, keys: list[str] = ()) -> DataFrame:
    """Add ``part`` (train or test), ``step`` (1.. from the first test month, 0 and below before it)
    and ``train_rows``: the last ``test_size`` rows of a key by date are its test."""
    _positive(test_size, "test_size")
    whole = Window.partitionBy(*keys)
    at = F.row_number().over(whole.orderBy("date"))
    train_rows = F.count("*").over(whole) - test_size
    return df.select("*", at.alias("__at"), train_rows.cast("int").alias("train_rows")).select(
        *df.columns, F.when(F.col("__at") > F.col("train_rows"), "test").otherwise("train").alias("part"),
        (F.col("__at") - F.col("train_rows")).alias("step"), "train_rows",
    )


def temporal_split(df: DataFrame, test_size: int, keys: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Train and test frames; a key without a train row fails the query."""
    marked = mark_holdout(df, test_size, keys)
    problem = F.raise_error(F.lit("the test takes all rows of a series")).cast("string")
    part = F.when(F.col("train_rows") <= 0, problem).otherwise(F.col("part"))
    checked = marked.withColumn("part", part)
    return tuple(checked.where(F.col("part") == p).select(*df.columns) for p in ("train", "test"))


def naive(value: Column, keys: list[str] = ()) -> Column:
    """Last train value, for every step. Over a marked frame."""
    return F.max(F.when(F.col("step") == 0, value)).over(Window.partitionBy(*keys))


def moving_average(value: Column, window: int, keys: list[str] = ()) -> Column:
    """Mean of the last ``window`` train values; null when there are fewer. Over a marked frame."""
    _positive(window, "window")
    recent = F.when(F.col("step").between(1 - window, 0), value)
    mean = F.avg(recent).over(Window.partitionBy(*keys))
    return F.when(F.col("train_rows") >= window, mean)


def seasonal_naive(value: Column, season: int, horizon: int, keys: list[str] = ()) -> Column:
    """The last ``season`` train values, repeated; null when there are fewer. Over a marked frame.

    Step h of repetition k looks back k seasons, which is a lag: no join.
    """
    _positive(season, "season_length")
    _positive(horizon, "horizon")
    by_date = Window.partitionBy(*keys).orderBy("date")
    rounds = range(1, -(-horizon // season) + 1)
    looks = [F.when(F.ceil(F.col("step") / season) == k, F.lag(value, k * season).over(by_date)) for k in rounds]
    return F.when((F.col("train_rows") >= season) & (F.col("step") > 0), F.coalesce(*looks))


def _kind(model: str) -> str:
    return model if model == "naive" else model.rsplit("_", 1)[0]


def model_status(train_rows: Column, model: str, need: int) -> Column:
    """``trained``, or why the model is skipped."""
    return F.when(train_rows >= need, TRAINED).otherwise(F.lit(f"skipped: {SHORT_FOR[_kind(model)]}"))


def baseline_forecasts(df: DataFrame, target: str, test_size: int = 12, keys: list[str] = (),
                       models: dict[str, int] = BASELINES) -> DataFrame:
    """Test months of every model: ``keys, date, target, model, actual, prediction, status``.

    Rows without a target go first. One exchange by key serves the split and all
    models; a model a key is too short for keeps its rows, without predictions.
    """
    present = df.select(*keys, "date", F.col(target).cast("double").alias("actual")).where("actual is not null")
    marked = mark_holdout(present, test_size, keys)
    actual = F.col("actual")

    def predict(model: str, need: int) -> Column:
        kind = _kind(model)
        if kind == "naive":
            return naive(actual, keys)
        if kind == "moving_average":
            return moving_average(actual, need, keys)
        return seasonal_naive(actual, need, test_size, keys)

    predicted = marked.select("*", *[predict(m, n).alias(f"__{m}") for m, n in models.items()])
    entries = F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"__{m}").alias("prediction"),
                 model_status(F.col("train_rows"), m, n).alias("status"))
        for m, n in models.items()
    ])
    tests = predicted.where("part = 'test'").select(*keys, "date", "actual", F.explode(entries).alias("e"))
    return tests.select(
        *keys, "date", F.lit(target).alias("target"), "e.model", "actual", "e.prediction", "e.status"
    )


def baseline_predictions(forecasts: DataFrame) -> DataFrame:
    """Predictions of the models that trained."""
    return forecasts.where(F.col("status") == TRAINED).drop("status")


def score_forecasts(forecasts: DataFrame, keys: list[str] = (), by: list[str] = ("model",)) -> DataFrame:
    """MAE, RMSE, MAPE and sMAPE per key and model, all in one aggregation."""
    errors = forecast_errors(F.col("actual"), F.col("prediction"))
    return forecasts.groupBy(*keys, *by).agg(*[c.alias(n) for n, c in errors.items()])


def compare_models(forecasts: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Metrics and status per key and model, skipped models with empty metrics."""
    by = ["model", "status"] if "status" in forecasts.columns else ["model"]
    return score_forecasts(forecasts, keys, by)


def ordered_comparison(comparison: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Comparison in report order: by RMSE, ties by name, skipped models last."""
    return comparison.orderBy(*keys, F.asc_nulls_last("rmse"), "model")


def check_any_trained(comparison: DataFrame, target: str) -> None:
    """Raise when no model trained."""
    if comparison.where(F.col("status") == TRAINED).isEmpty():
        raise ValueError(f"no baseline fits the target {target!r}")


def union_predictions(frames: list[DataFrame]) -> DataFrame:
    """All models' predictions as one table."""
    return reduce(DataFrame.unionByName, frames)
