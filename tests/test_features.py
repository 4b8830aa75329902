import datetime
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from monthpanel.operators.features import (
    CALENDAR, add_calendar, add_lags, add_rolling, composite_target, interpolate_inside, predictor_columns,
    predictor_screen, supervised_basic, supervised_sparse, supervised_strict,
)


def frame(df):
    pdf = df.toPandas().sort_values("date").reset_index(drop=True)
    return pdf.astype({c: float for c in pdf.columns if c not in ("date", "k")})


def close(a, b):
    assert np.allclose(np.array(a, float), np.array(b, float), equal_nan=True), (list(a), list(b))


def test_calendar(monthly):
    pdf = frame(add_calendar(monthly("2024-01", y=[1, 2])))
    assert list(pdf["month"]) == [1, 2] and list(pdf["quarter"]) == [1, 1] and list(pdf["year"]) == [2024, 2024]
    close(pdf["month_sin"], [math.sin(math.pi / 6), math.sin(math.pi / 3)])
    close(pdf["month_cos"], [math.cos(math.pi / 6), math.cos(math.pi / 3)])


def test_lags_and_windows(monthly):
    y = [1.0, 4.0, None, 2.0, 7.0, 1.0, 5.0, 3.0]
    df = monthly("2024-01", y=y)
    s = pd.Series(y, dtype=float)
    pdf = frame(add_rolling(add_lags(df, ["y"], [1, 2]), ["y"], [2, 3]))
    for k in (1, 2):
        close(pdf[f"y_lag_{k}"], s.shift(k))
    for n in (2, 3):
        close(pdf[f"y_roll_mean_{n}"], s.shift(1).rolling(n).mean())
        close(pdf[f"y_roll_std_{n}"], s.shift(1).rolling(n).std())
    with pytest.raises(ValueError, match="a lag"):
        add_lags(df, ["y"], [0])
    with pytest.raises(ValueError, match="rolling window"):
        add_rolling(df, ["y"], [1])


def test_keys_are_independent(monthly):
    a = monthly("2024-01", y=[1, 2, 3]).withColumn("k", F.lit("a"))
    b = monthly("2024-01", y=[10, 20, 30]).withColumn("k", F.lit("b"))
    got = {(r["k"], r["y"]): r["y_lag_1"] for r in add_lags(a.unionByName(b), ["y"], [1], ["k"]).collect()}
    assert got == {("a", 1): None, ("a", 2): 1, ("a", 3): 2, ("b", 10): None, ("b", 20): 10, ("b", 30): 20}


def test_supervised_basic(monthly):
    df = monthly("2022-01", target=list(range(24)), x=list(range(100, 124)))
    pdf = frame(supervised_basic(df, "target", ["x"]))
    assert len(pdf) == 12 and not pdf.isna().any().any()
    assert {"target_lag_12", "x_lag_12", "target_roll_mean_3", "x", "target", *CALENDAR} <= set(pdf.columns)


def test_supervised_strict(monthly):
    t = np.arange(72)
    df = monthly("2018-01", y=list(100 + 0.8 * t), x=list(95 + 0.4 * t))
    made = supervised_strict(df, "y")
    assert len([c for c in made.columns if c not in ("date", "__target__")]) == 13 and made.count() == 60
    exog = frame(supervised_strict(df, "y", [12, 1, 1], [3], ["x", "y", "date", "nope"]))
    assert list(exog.columns) == ["date", "__target__", "month_sin", "month_cos", "y_lag_1", "y_lag_12", "y_roll_mean_3",
                                  "y_roll_std_3", "x_lag_1"]
    close(exog["x_lag_1"], 95 + 0.4 * np.arange(11, 71))
    with pytest.raises(ValueError, match="leave no supervised row"):
        supervised_strict(df.limit(5), "y", check=True)
    with pytest.raises(ValueError, match="to forecast"):
        supervised_strict(df, "z")
    with pytest.raises(ValueError, match="date"):
        supervised_strict(df.drop("date"), "y")


def test_supervised_sparse(monthly):
    n = 48
    df = monthly("2020-01", t=[None if i == 5 else float(i) for i in range(n)], t_source_count=[3.0] * n,
                 a=[i * 2.0 for i in range(n)], b=[None] * 30 + [1.0] * 18, c=["x"] * n)
    assert predictor_columns(df, "t") == ["a"]
    screened = {r["column"]: (round(r["ratio"], 4), r["is_predictor"]) for r in predictor_screen(df, "t").collect()}
    assert screened == {"a": (1.0, True), "b": (0.375, False)}
    made, features = supervised_sparse(df, "t", lags=[1, 2], windows=[3])
    assert "a" not in features and {"a_lag_1", "t_lag_1", "t_roll_mean_3"} <= set(features)
    pdf = frame(made.select("date", "t", *features))
    assert len(pdf) == n - 1 - 3
    six = pdf[pdf["t"] == 6]
    assert float(six["t_lag_1"].iloc[0]) == 4.0 and float(six["a_lag_1"].iloc[0]) == 8.0


def test_interpolation(monthly):
    y = [None, 1.0, None, None, 4.0, None, 6.0, None]
    pdf = frame(interpolate_inside(monthly("2024-01", y=y), ["y"]))
    close(pdf["y"], pd.Series(y, dtype=float).interpolate(limit_area="inside"))


def reference_composite(pdf, columns, least=1, interpolate=False):
    numbers = pdf[columns].astype(float)
    if interpolate:
        numbers = numbers.interpolate(limit_area="inside")
    z = (numbers - numbers.mean()) / numbers.std(ddof=0).replace(0, np.nan)
    target = z.mean(axis=1)
    target[numbers.notna().sum(axis=1) < least] = np.nan
    return target, numbers.notna().sum(axis=1)


@pytest.mark.parametrize("least, interpolate", [(1, False), (2, True)])
def test_composite(monthly, least, interpolate):
    columns = {"ipmc_a": [None, 110.0, None, 130.0], "area_b": [1000.0, 1050.0, 1100.0, None], "cost": [1.0] * 4, "costo": [5.0] * 4}
    df = monthly("2023-01", **columns)
    used = ["ipmc_a", "area_b", "costo"]
    target, count = reference_composite(pd.DataFrame(columns), used, least, interpolate)
    for keys in ([], ["k"]):
        source = df.withColumn("k", F.lit("a")) if keys else df
        pdf = frame(composite_target(source, target="p", min_observed=least, interpolate=interpolate, keys=keys))
        close(pdf["p"], target)
        close(pdf["p_source_count"], count)
        close(pdf["ipmc_a"], pd.Series(columns["ipmc_a"], dtype=float))


def test_composite_needs_candidates(monthly):
    with pytest.raises(ValueError, match="composite target from"):
        composite_target(monthly("2023-01", x=[1, 2]))
    assert datetime.date(2023, 1, 1) in [r["date"] for r in composite_target(monthly("2023-01", x=[1, 2]), ["x"]).collect()]
