"""Guarded statistics used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; null without variance.

    ``corr`` fails on zero variance under ANSI mode, hence the guarded quotient.
    """
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(px) * F.stddev_pop(py)
    return F.try_divide(F.covar_pop(px, py), F.nullif(spread, F.lit(0.0)))


def row_mean(columns: list[Column]) -> Column:
    """Mean of the values present in a row; null when none is."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in columns), F.lit(0.0))
    return total / F.nullif(row_count(columns), F.lit(0))


def row_count(columns: list[Column]) -> Column:
    """How many of the columns are present in a row."""
    return sum((c.isNotNull().cast("int") for c in columns), F.lit(0))


def forecast_errors(actual: Column, prediction: Column) -> dict[str, Column]:
    """MAE, RMSE, MAPE and sMAPE as aggregates; rows with a missing side are skipped."""
    error = F.abs(actual - prediction)
    size = F.abs(actual) + F.abs(prediction)
    return {
        "mae": F.avg(error),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape": F.avg(F.when(F.abs(actual) > 1e-12, error / F.abs(actual))) * 100,
        "smape": F.avg(F.when(size > 1e-12, 2 * error / size)) * 100,
    }


def improvement_pct(baseline: Column, value: Column) -> Column:
    """Percentage gain of a lower-is-better metric; null for a zero baseline."""
    return F.when(baseline != 0, (baseline - value) / baseline * 100)
