import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from monthpanel.operators.baselines import (
    baseline_forecasts, baseline_predictions, check_any_trained, compare_models, mark_holdout, ordered_comparison,
    score_forecasts, temporal_split,
)
from monthpanel.operators.diagnose import (
    add_residuals, best_model, check_best, improvements, lag_correlations, model_predictions, top_lag_correlations,
)

# Published holdout values of 2025 and two models' predictions for them.
ACTUAL = [
    155.78966364853875, 163.45166452983088, 166.86386046987312, 154.3111291932252, 172.41235868557422, 164.9459634143343,
    181.02161454253152, 180.96605412702377, 171.0075915118597, 174.233565500684, 178.19385273708605, 166.7907460847583,
]
SEASONAL = [
    155.8987635372856, 150.27935991098508, 152.23190517112062, 138.35044343650782, 155.5855232231258, 151.7373813484777,
    163.18892742666415, 166.314026127196, 157.06986776389812, 165.47928264319748, 165.39019230428997, 149.6370974930005,
]
ELASTIC = [
    156.51623818430082, 153.26366665933338, 152.11031034270837, 153.28755138849306, 162.15688144427227, 166.76987222186975,
    167.34769232653775, 179.4207166242657, 174.8553264209381, 180.47912182979616, 173.56685881180877, 163.95636279004438,
]
CONSTANT = {"naive": 149.6370974930005, "moving_average_3": 160.16885748016264, "moving_average_6": 161.17989895970769}
PUBLISHED = {
    "moving_average_6": (10.028941, 11.644662, 5.795924, 5.997955),
    "moving_average_3": (10.702968, 12.359946, 6.177751, 6.416727),
    "seasonal_naive_12": (13.253624, 14.028940, 7.800050, 8.157731),
    "naive": (19.528575, 21.288279, 11.318186, 12.117473),
    "elasticnet_lagged": (5.962085, 7.660280, 3.483057, 3.570353),
}


def predictions_of(spark, models):
    rows = [
        (datetime.date(2025, i + 1, 1), m, ACTUAL[i], p[i] if isinstance(p, list) else p)
        for m, p in models.items() for i in range(12)
    ]
    return spark.createDataFrame(rows, "date date, model string, actual double, prediction double")


def test_published_metrics_and_improvement(spark):
    baselines = score_forecasts(predictions_of(spark, {**CONSTANT, "seasonal_naive_12": SEASONAL}))
    models = score_forecasts(predictions_of(spark, {"elasticnet_lagged": ELASTIC}))
    got = {r["model"]: tuple(round(r[c], 6) for c in ("mae", "rmse", "mape", "smape"))
           for r in baselines.unionByName(models).collect()}
    assert got == PUBLISHED
    assert [r["model"] for r in ordered_comparison(baselines).collect()] == [
        "moving_average_6", "moving_average_3", "seasonal_naive_12", "naive"]
    assert best_model(baselines).first()["model"] == "moving_average_6"
    row = improvements(models, baselines).first()
    assert round(row["rmse_improvement_pct"], 2) == 34.22 and round(row["mae_improvement_pct"], 2) == 40.55
    assert row["beats_baseline"] and row["baseline_model"] == "moving_average_6"


def test_baselines_reproduce_the_published_forecasts(spark, monthly):
    # The seasonal forecast repeats 2024, whose tail also gives the other baselines.
    made = baseline_forecasts(monthly("2024-01", y=SEASONAL + ACTUAL), "y", 12).collect()
    got = {(r["model"], r["date"].month): r["prediction"] for r in made}
    assert len(got) == 48 and {r["status"] for r in made} == {"trained"}
    for m, value in CONSTANT.items():
        assert all(abs(got[m, k] - value) < 1e-9 for k in range(1, 13))
    assert [got["seasonal_naive_12", k] for k in range(1, 13)] == SEASONAL


def test_metric_rules(spark):
    rows = [("a", 100.0, 110.0), ("a", 200.0, 190.0), ("a", 300.0, 330.0), ("z", 0.0, 0.0), ("z", 0.0, 2.0), ("n", 1.0, None)]
    got = {r["model"]: r for r in score_forecasts(
        spark.createDataFrame(rows, "model string, actual double, prediction double")).collect()}
    assert abs(got["a"]["mae"] - 50 / 3) < 1e-9 and abs(got["a"]["rmse"] - (1100 / 3) ** 0.5) < 1e-9
    assert abs(got["a"]["mape"] - (0.1 + 0.05 + 0.1) / 3 * 100) < 1e-9
    assert got["z"]["mape"] is None and got["z"]["smape"] == 200.0
    assert got["n"]["mae"] is None and got["n"]["rmse"] is None


def test_split(spark, monthly):
    train, test = temporal_split(monthly("2024-01", y=[0, 1, 2, 3, 4, 5]), 2)
    assert sorted(r["y"] for r in test.collect()) == [4, 5] and train.count() == 4
    with pytest.raises(ValueError):
        temporal_split(monthly("2024-01", y=[0]), 0)
    with pytest.raises(Exception, match="takes all rows"):
        temporal_split(monthly("2024-01", y=[0, 1, 2]), 3)[1].collect()
    marked = mark_holdout(monthly("2024-01", y=[0, 1, 2]), 5)
    assert {(r["part"], r["train_rows"]) for r in marked.collect()} == {("test", -2)}


def test_small_baselines(spark, monthly):
    def forecast(values, horizon, **models):
        made = baseline_forecasts(monthly("2024-01", y=values + [0.0] * horizon), "y", horizon, models=models)
        return [r["prediction"] for r in made.orderBy("date").collect()]

    assert forecast([1, 2, 5], 3, naive=1) == [5, 5, 5]
    assert forecast([1, 2, 3, 4, 5, 6], 5, seasonal_naive_3=3) == [4, 5, 6, 4, 5]
    assert np.allclose(forecast([1, 2, 7, 10], 2, moving_average_3=3), [19 / 3] * 2)
    with pytest.raises(ValueError):
        forecast([1], 0, naive=1)


def test_skipped_models(spark, monthly):
    y = [5.0, None, 7.0, 9.0, 8.0, 1.0]
    forecasts = baseline_forecasts(monthly("2024-01", y=y), "y", 2)
    comparison = compare_models(forecasts)
    got = {r["model"]: (r["status"], r["rmse"]) for r in comparison.collect()}
    assert got["naive"][0] == "trained" and got["moving_average_3"][0] == "trained"
    assert got["moving_average_6"] == ("skipped: Series length must be at least the moving-average window", None)
    assert got["seasonal_naive_12"][0] == "skipped: Series length must be at least the season length"
    assert [r["model"] for r in ordered_comparison(comparison).collect()][2:] == ["moving_average_6", "seasonal_naive_12"]
    assert baseline_predictions(forecasts).select("model").distinct().count() == 2
    check_any_trained(comparison, "y")
    none = compare_models(baseline_forecasts(monthly("2024-01", y=[1.0, 2.0]), "y", 2))
    with pytest.raises(ValueError, match="no baseline"):
        check_any_trained(none, "y")
    with pytest.raises(ValueError, match="no model was trained"):
        check_best(none)


def test_best_and_filter(spark):
    rows = spark.createDataFrame([("a", 4.0, "trained"), ("b", 2.0, "Trained"), ("c", 1.0, "skipped: x"), ("d", None, "trained"),
                                  ("aa", 2.0, "trained")], "model string, rmse double, status string")
    assert best_model(rows).first()["model"] == "aa"
    predictions = predictions_of(spark, {"x": 1.0, "y": SEASONAL})
    only = model_predictions(predictions, "x")
    assert only.count() == 12 and add_residuals(only).first()["residual"] == only.first()["actual"] - 1.0
    with pytest.raises(ValueError, match="has no predictions"):
        model_predictions(predictions, "nope", check=True)


def test_lag_correlations(spark, monthly):
    rng = np.random.default_rng(3)
    feature = rng.normal(size=40)
    target = np.roll(feature, 1)
    target[0] = 0.0
    holes = [None if i % 9 == 4 else float(v) for i, v in enumerate(feature * 2 + rng.normal(size=40))]
    df = monthly("2021-01", target=list(target), feature=list(feature), holes=holes, flat=[2.0] * 40, short=[1.0] * 20 + [None] * 20)
    got = {(r["feature"], r["lag"]): r for r in lag_correlations(df, "target", 3, 24).collect()}
    pdf = pd.DataFrame({"target": target, "feature": feature, "holes": pd.Series(holes, dtype=float)})
    assert set(got) == {(f, k) for f in ("target", "feature", "holes") for k in (1, 2, 3)}
    for (f, k), r in got.items():
        pair = pd.DataFrame({"t": pdf["target"], "f": pdf[f].shift(k)}).dropna()
        assert abs(r["correlation"] - pair["t"].corr(pair["f"])) < 1e-12
        assert r["observations"] == len(pair) and r["abs_correlation"] == abs(r["correlation"])
    top = top_lag_correlations(lag_correlations(df, "target", 3, 24), 2).orderBy("rank").collect()
    assert (top[0]["feature"], top[0]["lag"], len(top)) == ("feature", 1, 2)
    with pytest.raises(ValueError):
        lag_correlations(df, "absent")
    keyed = df.withColumn("k", F.lit(1)).unionByName(df.withColumn("k", F.lit(2)))
    assert lag_correlations(keyed, "target", 3, 24, ["k"]).count() == 18
