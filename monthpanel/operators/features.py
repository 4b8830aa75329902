"""Calendar, lag and rolling features, interpolation and the composite target.

Inputs are monthly frames (one row per key and month). All window columns of a
frame share one partitioning and order, so a frame costs one exchange and sort.
Lags and windows count rows; build the frame on a spine for calendar distance.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.fixed import DEFAULT_LAGS, DEFAULT_WINDOWS, PROXY_TARGET
from monthpanel.functions.numbers import to_number
from monthpanel.functions.stats import row_count, row_mean
from monthpanel.operators.clean import numeric_columns, proxy_candidates

CALENDAR = ["year", "month", "quarter", "month_sin", "month_cos"]


def _by_date(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("date")


def calendar_columns(names: list[str] = CALENDAR, date_col: str = "date") -> list[Column]:
    """Calendar features of the date column."""
    day = F.col(date_col)
    angle = F.month(day) * F.lit(2 * math.pi / 12)
    made = {
        "year": F.year(day), "month": F.month(day), "quarter": F.quarter(day),
        "month_sin": F.sin(angle), "month_cos": F.cos(angle),
    }
    return [made[n].alias(n) for n in names]


def add_calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add year, month, quarter and the month's sine and cosine."""
    return df.select("*", *calendar_columns(date_col=date_col))


def _lags(columns: list[str], lags: list[int], keys: list[str]) -> list[Column]:
    if any(k <= 0 for k in lags):
        raise ValueError("a lag is at least one row")
    w = _by_date(keys)
    return [F.lag(c, k).over(w).alias(f"{c}_lag_{k}") for c in columns for k in lags]


def _rolling(columns: list[str], windows: list[int], keys: list[str]) -> list[Column]:
    if any(n <= 1 for n in windows):
        raise ValueError("a rolling window spans at least two rows")
    made = []
    for c in columns:
        for n in windows:
            w = _by_date(keys).rowsBetween(-n, -1)
            full = F.count(c).over(w) == n
            made.append(F.when(full, F.avg(c).over(w)).alias(f"{c}_roll_mean_{n}"))
            made.append(F.when(full, F.stddev_samp(c).over(w)).alias(f"{c}_roll_std_{n}"))
    return made


def add_lags(df: DataFrame, columns: list[str], lags: list[int], keys: list[str] = ()) -> DataFrame:
    """Add ``<column>_lag_<k>``: the value k rows earlier."""
    return df.select("*", *_lags(columns, lags, keys))


def add_rolling(df: DataFrame, columns: list[str], windows: list[int], keys: list[str] = ()) -> DataFrame:
    """Add mean and standard deviation of the previous n values; null unless all n are there."""
    return df.select("*", *_rolling(columns, windows, keys))


def supervised_basic(df: DataFrame, target: str, predictors: list[str] = (), lags: list[int] = DEFAULT_LAGS,
                     windows: list[int] = DEFAULT_WINDOWS, keys: list[str] = ()) -> DataFrame:
    """All columns plus calendar, lags and target windows; rows with any null dropped."""
    return df.select(
        "*", *calendar_columns(), *_lags([target, *predictors], lags, keys), *_rolling([target], windows, keys)
    ).na.drop("any")


def supervised_strict(df: DataFrame, target: str, lags: list[int] = DEFAULT_LAGS,
                      windows: list[int] = DEFAULT_WINDOWS, exogenous: list[str] | None = None,
                      calendar: bool = True, keys: list[str] = (), check: bool = False) -> DataFrame:
    """``keys, date, __target__`` and features known before the month.

    Only lags and windows of the target and, one month late, the exogenous
    columns. ``check`` runs the query once to fail when no row remains.
    """
    if "date" not in df.columns:
        raise ValueError("a supervised frame needs the column 'date'")
    if target not in df.columns:
        raise ValueError(f"no column {target!r} to forecast")
    others = [c for c in dict.fromkeys(exogenous or []) if c in df.columns and c not in (target, "date", *keys)]
    numbers = df.select(*keys, "date", *[to_number(F.col(c)).alias(c) for c in [target, *others]])
    frame = numbers.select(
        *keys, "date", F.col(target).alias("__target__"),
        *(calendar_columns(["month_sin", "month_cos"]) if calendar else []),
        *_lags([target], sorted(set(lags)), keys), *_rolling([target], sorted(set(windows)), keys),
        *_lags(others, [1], keys),
    ).na.drop("any")
    if check and frame.isEmpty():
        raise ValueError("the lags and windows leave no supervised row")
    return frame


def supervised_sparse(df: DataFrame, target: str, predictors: list[str] | None = None,
                      lags: list[int] = DEFAULT_LAGS, windows: list[int] = DEFAULT_WINDOWS,
                      keys: list[str] = ()) -> tuple[DataFrame, list[str]]:
    """Frame and feature names for models that impute: predictor lags may be missing.

    Rows without a target go first, so lags step over them. Without
    ``predictors`` those that pass :func:`predictor_columns` are used.
    """
    if predictors is None:
        predictors = predictor_columns(df, target, keys)
    lagged = _lags([target], lags, keys) + _rolling([target], windows, keys)
    own = [f"{target}_lag_{k}" for k in lags] + [
        f"{target}_roll_{s}_{n}" for n in windows for s in ("mean", "std")
    ]
    frame = df.na.drop(subset=[target]).select(
        "*", *calendar_columns(), *lagged, *_lags(list(predictors), lags, keys)
    ).na.drop(subset=own)
    features = CALENDAR + own + [f"{p}_lag_{k}" for p in predictors for k in lags]
    return frame, features


def predictor_screen(df: DataFrame, target: str, keys: list[str] = (), min_ratio: float = 0.5) -> DataFrame:
    """Share of present values per possible predictor: ``column, ratio, is_predictor``."""
    columns = numeric_columns(df, but=["date", target, f"{target}_source_count", *keys])
    if not columns:
        raise ValueError("no numeric column is left as a predictor")
    shares = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    long = shares.unpivot([], columns, "column", "ratio")
    return long.withColumn("is_predictor", F.col("ratio") >= min_ratio)


def predictor_columns(df: DataFrame, target: str, keys: list[str] = (), min_ratio: float = 0.5) -> list[str]:
    """Numeric columns dense enough to lag, in schema order (one row to the driver)."""
    columns = numeric_columns(df, but=["date", target, f"{target}_source_count", *keys])
    if not columns:
        return []
    ratios = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns]).first()
    return [c for c in columns if (ratios[c] or 0.0) >= min_ratio]


def interpolate_inside(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """Fill gaps between two observations linearly by row; ends stay empty."""
    order = _by_date(keys)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    placed = df.withColumn("__row", F.row_number().over(order))

    def filled(c: str) -> Column:
        point = F.when(F.col(c).isNotNull(), F.struct(F.col("__row").alias("at"), F.col(c).alias("v")))
        left, right = F.last(point, ignorenulls=True).over(before), F.first(point, ignorenulls=True).over(after)
        share = (F.col("__row") - left["at"]) / (right["at"] - left["at"])
        return F.coalesce(F.col(c), left["v"] + share * (right["v"] - left["v"]))

    kept = [c for c in df.columns if c not in columns]
    return placed.select(*kept, *[filled(c).alias(c) for c in columns]).select(*df.columns)


def composite_target(df: DataFrame, candidates: list[str] | None = None, target: str = PROXY_TARGET,
                     min_observed: int = 1, interpolate: bool = False, keys: list[str] = ()) -> DataFrame:
    """Add the mean z-score of the candidate columns and ``<target>_source_count``.

    Mean and deviation are those of the key's whole series; a constant series
    contributes nothing. Rows with fewer observed candidates than
    ``min_observed`` get no target.
    """
    chosen = proxy_candidates(df.columns, keys) if candidates is None else candidates
    chosen = [c for c in chosen if c in df.columns]
    if not chosen:
        raise ValueError("no columns to make the composite target from")
    hidden = {c: f"__{c}" for c in chosen}
    numbers = df.select("*", *[to_number(F.col(c)).alias(h) for c, h in hidden.items()])
    if interpolate:
        numbers = interpolate_inside(numbers, list(hidden.values()), keys)
    stats = {f"{h}_{n}": f(F.col(h)) for h in hidden.values() for n, f in (("mean", F.avg), ("std", F.stddev_pop))}
    if keys:
        by_key = Window.partitionBy(*keys)
        value = lambda name: stats[name].over(by_key)
    else:
        whole = numbers.agg(F.struct(*[c.alias(n) for n, c in stats.items()])).scalar()
        value = lambda name: whole[name]
    scores = [
        F.try_divide(F.col(h) - value(f"{h}_mean"), F.nullif(value(f"{h}_std"), F.lit(0.0)))
        for h in hidden.values()
    ]
    count = row_count([F.col(h) for h in hidden.values()])
    return numbers.select(
        *[F.col(c) for c in df.columns],
        F.when(count >= min_observed, row_mean(scores)).alias(target),
        count.alias(f"{target}_source_count"),
    )
