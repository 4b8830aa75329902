"""Registered queries: holdout, baselines, metrics, comparisons, lag correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthpanel.operators.baselines import (
    BASELINES, baseline_forecasts, baseline_predictions, compare_models, mark_holdout, score_forecasts,
)
from monthpanel.operators.diagnose import (
    add_residuals, best_model, improvements, lag_correlations, model_predictions, top_lag_correlations,
)
from monthpanel.plans.views import CUSTOMER_MONTH, SUPPLIER_MONTH, customer_month, rounded, supplier_month

KEYS = ["supplier"]
METRICS = {"mae": 5, "rmse": 5, "mape": 6, "smape": 6}


def _forecasts(spark, sf_dir, *models):
    chosen = {m: BASELINES[m] for m in models} if models else BASELINES
    months = supplier_month(spark, sf_dir).select("supplier", "date", "revenue")
    return baseline_forecasts(months, "revenue", 12, KEYS, chosen)


def _short(spark, sf_dir):
    """Customers have a handful of months each: many are too short for some models."""
    return baseline_forecasts(customer_month(spark, sf_dir), "revenue", 3, ["customer"])


def temporal_split_query(spark, sf_dir):
    return mark_holdout(supplier_month(spark, sf_dir).select("supplier", "date", "revenue"), 12, KEYS)


def _one(model):
    def query(spark, sf_dir):
        return rounded(_forecasts(spark, sf_dir, model).drop("status"), prediction=4)
    return query


def baseline_ma(spark, sf_dir):
    return rounded(_forecasts(spark, sf_dir, "moving_average_3", "moving_average_6").drop("status"), prediction=4)


def baseline_predictions_query(spark, sf_dir):
    return rounded(baseline_predictions(_short(spark, sf_dir)), prediction=4)


def forecast_metrics(spark, sf_dir):
    return rounded(score_forecasts(_forecasts(spark, sf_dir), KEYS), **METRICS)


def model_comparison(spark, sf_dir):
    return rounded(compare_models(_short(spark, sf_dir), ["customer"]), **METRICS)


def model_status_query(spark, sf_dir):
    return _short(spark, sf_dir).groupBy("model", "status").agg(F.countDistinct("customer").alias("customers"))


def best_model_query(spark, sf_dir):
    return rounded(best_model(compare_models(_short(spark, sf_dir), ["customer"]), ["customer"]), **METRICS)


def model_filter(spark, sf_dir):
    return rounded(model_predictions(baseline_predictions(_short(spark, sf_dir)), "moving_average_3"), prediction=4)


def residuals(spark, sf_dir):
    return rounded(add_residuals(baseline_predictions(_forecasts(spark, sf_dir))), prediction=4, residual=4)


def improvement(spark, sf_dir):
    """Averages and seasons against the naive forecast."""
    models = compare_models(_forecasts(spark, sf_dir, "moving_average_3", "moving_average_6", "seasonal_naive_12"), KEYS)
    made = improvements(models, compare_models(_forecasts(spark, sf_dir, "naive"), KEYS), KEYS)
    return rounded(made, **{c: 5 for c in made.columns if c.endswith(("rmse", "mae", "delta"))},
                   rmse_improvement_pct=6, mae_improvement_pct=6)


def _correlations(spark, sf_dir):
    months = supplier_month(spark, sf_dir).select("supplier", "date", "quantity", "steady", "discount")
    return lag_correlations(months, "quantity", 6, 24, KEYS)


def lag_correlation(spark, sf_dir):
    return rounded(_correlations(spark, sf_dir), correlation=8, abs_correlation=8)


def lag_correlation_topk(spark, sf_dir):
    return rounded(top_lag_correlations(_correlations(spark, sf_dir), 5, KEYS), correlation=8, abs_correlation=8)


def _forecast_sql(base, key, n):
    """CTE ``f``: every baseline's test rows, with status, for one base table."""
    models = []
    for model, need in BASELINES.items():
        reason = {"naive": "Cannot fit NaiveForecaster on an empty series",
                  "moving_average_3": "Series length must be at least the moving-average window",
                  "moving_average_6": "Series length must be at least the moving-average window",
                  "seasonal_naive_12": "Series length must be at least the season length"}[model]
        value = {"naive": "last", "moving_average_3": "ma3", "moving_average_6": "ma6",
                 "seasonal_naive_12": "(SELECT t.revenue FROM marked t WHERE t.{0} = m.{0} AND t.back = {1} + 12 - ((m.step - 1) % 12))"
                 .format(key, n)}[model]
        models.append(f"""SELECT {key}, date, 'revenue' AS target, '{model}' AS model, revenue AS actual,
  CASE WHEN train_rows >= {need} THEN {value} END AS prediction,
  CASE WHEN train_rows >= {need} THEN 'trained' ELSE 'skipped: {reason}' END AS status
FROM marked m JOIN train USING ({key}) WHERE back <= {n}""")
    return f"""placed AS (
  SELECT {key}, date, revenue, row_number() OVER (PARTITION BY {key} ORDER BY date DESC) AS back,
         count(*) OVER (PARTITION BY {key}) AS total FROM {base}),
marked AS (SELECT *, total - {n} AS train_rows, {n} - back + 1 AS step FROM placed),
train AS (
  SELECT {key}, max(CASE WHEN back = {n} + 1 THEN revenue END) AS last,
         avg(CASE WHEN back BETWEEN {n} + 1 AND {n} + 3 THEN revenue END) AS ma3,
         avg(CASE WHEN back BETWEEN {n} + 1 AND {n} + 6 THEN revenue END) AS ma6 FROM placed GROUP BY 1),
f AS ({' UNION ALL '.join(models)})"""


def _metrics_sql(*by):
    keys = ", ".join(by)
    return f"""m AS (
  SELECT {keys}, avg(abs(actual - prediction)) AS mae, sqrt(avg(pow(actual - prediction, 2))) AS rmse,
    avg(CASE WHEN abs(actual) > 1e-12 THEN abs(actual - prediction) / abs(actual) END) * 100 AS mape,
    avg(CASE WHEN abs(actual) + abs(prediction) > 1e-12
        THEN 2 * abs(actual - prediction) / (abs(actual) + abs(prediction)) END) * 100 AS smape
  FROM f GROUP BY {keys})"""


_ROUNDED = "round(mae, 5) AS mae, round(rmse, 5) AS rmse, round(mape, 6) AS mape, round(smape, 6) AS smape"
_SUPPLIER = f"WITH {SUPPLIER_MONTH}, {_forecast_sql('supplier_month', 'supplier', 12)}"
_CUSTOMER = f"WITH {CUSTOMER_MONTH}, {_forecast_sql('customer_month', 'customer', 3)}"
_ROWS = "date, target, model, actual, round(prediction, 4) AS prediction"

_CORR = f"""WITH {SUPPLIER_MONTH},
long AS (
  SELECT supplier, date, quantity AS target, 'quantity' AS feature, quantity AS v FROM supplier_month UNION ALL
  SELECT supplier, date, quantity, 'steady', steady FROM supplier_month UNION ALL
  SELECT supplier, date, quantity, 'discount', discount FROM supplier_month),
placed AS (SELECT *, row_number() OVER (PARTITION BY supplier, feature ORDER BY date) AS i FROM long),
lags AS (SELECT unnest(range(1, 7)) AS lag),
pairs AS (
  SELECT a.supplier, a.feature, l.lag, a.target, b.v FROM placed a, lags l, placed b
  WHERE b.supplier = a.supplier AND b.feature = a.feature AND b.i = a.i - l.lag AND a.target IS NOT NULL AND b.v IS NOT NULL),
made AS (SELECT supplier, feature, CAST(lag AS INT) AS lag, count(*) AS observations,
    CASE WHEN stddev_pop(v) > 0 AND stddev_pop(target) > 0 THEN corr(target, v) END AS c FROM pairs GROUP BY 1, 2, 3),
kept AS (SELECT * FROM made WHERE observations >= 24 AND c IS NOT NULL)"""

QUERIES = {
    "temporal_split": (temporal_split_query, f"""
WITH {SUPPLIER_MONTH}, placed AS (
  SELECT supplier, date, revenue, row_number() OVER (PARTITION BY supplier ORDER BY date) AS pos,
         count(*) OVER (PARTITION BY supplier) - 12 AS n FROM supplier_month)
SELECT supplier, date, revenue, CASE WHEN pos > n THEN 'test' ELSE 'train' END AS part, CAST(pos - n AS INT) AS step,
       CAST(n AS INT) AS train_rows FROM placed"""),
    "baseline_naive": (_one("naive"), f"{_SUPPLIER} SELECT supplier, {_ROWS} FROM f WHERE model = 'naive'"),
    "baseline_seasonal": (_one("seasonal_naive_12"),
                          f"{_SUPPLIER} SELECT supplier, {_ROWS} FROM f WHERE model = 'seasonal_naive_12'"),
    "baseline_ma": (baseline_ma, f"{_SUPPLIER} SELECT supplier, {_ROWS} FROM f WHERE model LIKE 'moving%'"),
    "baseline_predictions": (baseline_predictions_query,
                             f"{_CUSTOMER} SELECT customer, {_ROWS} FROM f WHERE status = 'trained'"),
    "forecast_metrics": (forecast_metrics,
                         f"{_SUPPLIER}, {_metrics_sql('supplier', 'model')} SELECT supplier, model, {_ROUNDED} FROM m"),
    "model_comparison": (model_comparison, f"""{_CUSTOMER}, {_metrics_sql('customer', 'model', 'status')}
SELECT customer, model, status, {_ROUNDED} FROM m"""),
    "model_status": (model_status_query,
                     f"{_CUSTOMER} SELECT model, status, count(DISTINCT customer) AS customers FROM f GROUP BY 1, 2"),
    "best_model": (best_model_query, f"""{_CUSTOMER}, {_metrics_sql('customer', 'model', 'status')}
SELECT customer, model, status, {_ROUNDED} FROM m WHERE status = 'trained'
QUALIFY row_number() OVER (PARTITION BY customer ORDER BY m.rmse, model) = 1"""),
    "model_filter": (model_filter,
                     f"{_CUSTOMER} SELECT customer, {_ROWS} FROM f WHERE status = 'trained' AND model = 'moving_average_3'"),
    "residuals": (residuals, f"""{_SUPPLIER}
SELECT supplier, {_ROWS}, round(actual - prediction, 4) AS residual FROM f WHERE status = 'trained'"""),
    "improvement": (improvement, f"""{_SUPPLIER}, {_metrics_sql('supplier', 'model')},
best AS (SELECT * FROM m WHERE model <> 'naive' AND rmse IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY supplier ORDER BY rmse, model) = 1),
base AS (SELECT * FROM m WHERE model = 'naive' AND rmse IS NOT NULL)
SELECT supplier, base.model AS baseline_model, round(base.rmse, 5) AS baseline_rmse, round(base.mae, 5) AS baseline_mae,
  best.model AS best_model, round(best.rmse, 5) AS best_rmse, round(best.mae, 5) AS best_mae,
  round(best.rmse - base.rmse, 5) AS rmse_delta, round(best.mae - base.mae, 5) AS mae_delta,
  round((base.rmse - best.rmse) / nullif(base.rmse, 0) * 100, 6) AS rmse_improvement_pct,
  round((base.mae - best.mae) / nullif(base.mae, 0) * 100, 6) AS mae_improvement_pct, best.rmse < base.rmse AS beats_baseline
FROM best JOIN base USING (supplier)"""),
    "lag_correlation": (lag_correlation, f"""{_CORR}
SELECT supplier, feature, lag, round(c, 8) AS correlation, round(abs(c), 8) AS abs_correlation, observations FROM kept"""),
    "lag_correlation_topk": (lag_correlation_topk, f"""{_CORR}
SELECT supplier, feature, lag, round(c, 8) AS correlation, round(abs(c), 8) AS abs_correlation, observations,
       CAST(row_number() OVER (PARTITION BY supplier ORDER BY abs(c) DESC, feature, lag) AS INT) AS rank
FROM kept QUALIFY rank <= 5"""),
}
