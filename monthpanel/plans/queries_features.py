"""Registered queries: features, interpolation, composite target, imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthpanel.operators.baselines import mark_holdout
from monthpanel.operators.clean import keep_rows_with_target
from monthpanel.operators.features import (
    add_calendar, add_lags, add_rolling, composite_target, interpolate_inside, predictor_screen, supervised_basic,
    supervised_sparse, supervised_strict,
)
from monthpanel.operators.learn import impute_medians, train_medians
from monthpanel.operators.panel import month_spine
from monthpanel.plans.views import SUPPLIER_MONTH, rounded, supplier_month, supplier_spine_sql

KEYS = ["supplier"]
LAGS, WINDOWS = [1, 2, 3, 6, 12], [3, 6, 12]


def _months(spark, sf_dir, *columns):
    return supplier_month(spark, sf_dir).select("supplier", "date", *columns)


def _digits(df, n, *prefixes):
    """Round columns by prefix; deviations to fewer digits, as their rounding errors are larger."""
    return rounded(df, **{c: 3 if "_roll_std_" in c else n for c in df.columns if c.startswith(prefixes)})


def calendar_features(spark, sf_dir):
    return rounded(add_calendar(_months(spark, sf_dir, "quantity")), month_sin=9, month_cos=9)


def lag_features(spark, sf_dir):
    return add_lags(_months(spark, sf_dir, "quantity", "revenue"), ["quantity", "revenue"], [1, 12], KEYS)


def rolling_features(spark, sf_dir):
    rolled = add_rolling(_months(spark, sf_dir, "quantity", "revenue"), ["quantity", "revenue"], [3, 6], KEYS)
    return _digits(rolled, 6, "quantity_", "revenue_")


def interpolate_inside_query(spark, sf_dir):
    spine = month_spine(_months(spark, sf_dir, "steady"), keys=KEYS)
    return rounded(interpolate_inside(spine, ["steady"], KEYS), steady=5)


def proxy_target(spark, sf_dir):
    made = composite_target(_months(spark, sf_dir, "quantity", "steady"), ["quantity", "steady"], "proxy", 2, keys=KEYS)
    return rounded(made, proxy=6)


def keep_target(spark, sf_dir):
    return keep_rows_with_target(month_spine(_months(spark, sf_dir, "steady"), keys=KEYS), "steady")


def supervised_basic_query(spark, sf_dir):
    frame = supervised_basic(_months(spark, sf_dir, "quantity", "steady"), "quantity", ["steady"], keys=KEYS)
    return _digits(rounded(frame, month_sin=9, month_cos=9), 6, "quantity_roll")


def supervised_strict_query(spark, sf_dir):
    frame = supervised_strict(_months(spark, sf_dir, "quantity", "steady"), "quantity", keys=KEYS)
    return _digits(rounded(frame, month_sin=9, month_cos=9), 6, "quantity_roll")


def supervised_exog(spark, sf_dir):
    months = _months(spark, sf_dir, "quantity", "steady", "discount")
    frame = supervised_strict(months, "quantity", [1, 2], [3], ["steady", "discount", "absent"], False, KEYS)
    return _digits(frame, 6, "quantity_roll")


def supervised_sparse_query(spark, sf_dir):
    months = _months(spark, sf_dir, "steady", "quantity", "discount")
    frame, features = supervised_sparse(months, "steady", ["quantity"], [1, 12], [3], KEYS)
    return _digits(rounded(frame.select("supplier", "date", *features), month_sin=9, month_cos=9), 6, "steady_roll")


def impute_median_query(spark, sf_dir):
    spine = month_spine(_months(spark, sf_dir, "quantity", "steady"), keys=KEYS)
    marked = mark_holdout(spine, 12, KEYS)
    medians = train_medians(marked.where("part = 'train'"), ["quantity", "steady"])
    return rounded(impute_medians(marked.drop("step", "train_rows"), medians), steady=5)


def predictor_screen_query(spark, sf_dir):
    months = supplier_month(spark, sf_dir).withColumn("rare", F.when(F.col("lines") >= 20, F.col("revenue")))
    return rounded(predictor_screen(months, "quantity", KEYS), ratio=9)





def _lag_sql(column, lags=LAGS):
    return ", ".join(f"lag({column}, {k}) OVER w AS {column}_lag_{k}" for k in lags)


def _roll_sql(column, windows=WINDOWS):
    parts = []
    for n in windows:
        frame = f"OVER (PARTITION BY supplier ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        for name, f, digits in (("mean", "avg", 6), ("std", "stddev_samp", 3)):
            parts.append(f"CASE WHEN count({column}) {frame} = {n} THEN round({f}({column}) {frame}, {digits}) END "
                         f"AS {column}_roll_{name}_{n}")
    return ", ".join(parts)


_W = "WINDOW w AS (PARTITION BY supplier ORDER BY date)"
_YMQ = """CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(quarter(date) AS INT) AS quarter"""
_SINCOS = """round(sin(2 * pi() * month(date) / 12), 9) AS month_sin, round(cos(2 * pi() * month(date) / 12), 9) AS month_cos"""
_ROLLED = [f"quantity_roll_{s}_{n}" for n in WINDOWS for s in ("mean", "std")]
_LAGGED = [f"quantity_lag_{k}" for k in LAGS]


def _present(columns):
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


QUERIES = {
    "calendar_features": (calendar_features, f"""
WITH {SUPPLIER_MONTH} SELECT supplier, date, quantity, {_YMQ}, {_SINCOS} FROM supplier_month"""),
    "lag_features": (lag_features, f"""
WITH {SUPPLIER_MONTH}
SELECT supplier, date, quantity, revenue, {_lag_sql('quantity', [1, 12])}, {_lag_sql('revenue', [1, 12])}
FROM supplier_month {_W}"""),
    "rolling_features": (rolling_features, f"""
WITH {SUPPLIER_MONTH}
SELECT supplier, date, quantity, revenue, {_roll_sql('quantity', [3, 6])}, {_roll_sql('revenue', [3, 6])}
FROM supplier_month"""),
    "interpolate_inside": (interpolate_inside_query, f"""
WITH {SUPPLIER_MONTH}, {supplier_spine_sql('steady')},
placed AS (SELECT *, row_number() OVER (PARTITION BY supplier ORDER BY date) AS i FROM spine),
sides AS (
  SELECT *, max(CASE WHEN steady IS NOT NULL THEN i END) OVER (PARTITION BY supplier ORDER BY i) AS a,
         min(CASE WHEN steady IS NOT NULL THEN i END) OVER (PARTITION BY supplier ORDER BY i
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM placed)
SELECT s.supplier, s.date, round(CASE WHEN s.steady IS NOT NULL THEN s.steady
  ELSE l.steady + (s.i - s.a) / (s.b - s.a)::DOUBLE * (r.steady - l.steady) END, 5) AS steady
FROM sides s LEFT JOIN placed l ON l.supplier = s.supplier AND l.i = s.a
LEFT JOIN placed r ON r.supplier = s.supplier AND r.i = s.b"""),
    "proxy_target": (proxy_target, f"""
WITH {SUPPLIER_MONTH},
stats AS (SELECT supplier, avg(quantity) qm, stddev_pop(quantity) qs, avg(steady) sm, stddev_pop(steady) ss
          FROM supplier_month GROUP BY 1),
z AS (SELECT m.supplier, m.date, m.quantity, m.steady, (m.quantity - qm) / nullif(qs, 0) AS zq,
             (m.steady - sm) / nullif(ss, 0) AS zs FROM supplier_month m JOIN stats USING (supplier))
SELECT supplier, date, quantity, steady,
       CASE WHEN steady IS NOT NULL THEN round(list_avg([zq, zs]), 6) END AS proxy,
       CAST((quantity IS NOT NULL)::INT + (steady IS NOT NULL)::INT AS INT) AS proxy_source_count
FROM z"""),
    "keep_target": (keep_target, f"""
WITH {SUPPLIER_MONTH} SELECT supplier, date, steady FROM supplier_month WHERE steady IS NOT NULL"""),
    "supervised_basic": (supervised_basic_query, f"""
WITH {SUPPLIER_MONTH}, made AS (
  SELECT supplier, date, quantity, steady, {_YMQ}, {_SINCOS}, {_lag_sql('quantity')}, {_lag_sql('steady')},
         {_roll_sql('quantity')} FROM supplier_month {_W})
SELECT * FROM made WHERE {_present(['steady'] + _LAGGED + [f'steady_lag_{k}' for k in LAGS] + _ROLLED)}"""),
    "supervised_strict": (supervised_strict_query, f"""
WITH {SUPPLIER_MONTH}, made AS (
  SELECT supplier, date, quantity AS __target__, {_SINCOS}, {_lag_sql('quantity')}, {_roll_sql('quantity')}
  FROM supplier_month {_W})
SELECT * FROM made WHERE {_present(_LAGGED + _ROLLED)}"""),
    "supervised_exog": (supervised_exog, f"""
WITH {SUPPLIER_MONTH}, made AS (
  SELECT supplier, date, quantity AS __target__, {_lag_sql('quantity', [1, 2])}, {_roll_sql('quantity', [3])},
         lag(steady, 1) OVER w AS steady_lag_1, lag(discount, 1) OVER w AS discount_lag_1
  FROM supplier_month {_W})
SELECT * FROM made WHERE {_present(['quantity_lag_1', 'quantity_lag_2', 'quantity_roll_mean_3',
                                    'steady_lag_1', 'discount_lag_1'])}"""),
    "supervised_sparse": (supervised_sparse_query, f"""
WITH {SUPPLIER_MONTH}, made AS (
  SELECT supplier, date, {_YMQ}, {_SINCOS}, {_lag_sql('steady', [1, 12])}, {_roll_sql('steady', [3])},
         {_lag_sql('quantity', [1, 12])}
  FROM supplier_month WHERE steady IS NOT NULL {_W})
SELECT * FROM made WHERE {_present(['steady_lag_1', 'steady_lag_12', 'steady_roll_mean_3'])}"""),
    "impute_median": (impute_median_query, f"""
WITH {SUPPLIER_MONTH},
spine AS (
  SELECT k.supplier, CAST(m.d AS DATE) AS date, s.quantity, s.steady
  FROM (SELECT DISTINCT supplier FROM supplier_month) k
  CROSS JOIN (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS d FROM supplier_month) m
  LEFT JOIN supplier_month s ON s.supplier = k.supplier AND s.date = CAST(m.d AS DATE)),
marked AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY supplier ORDER BY date DESC) <= 12 THEN 'test'
                     ELSE 'train' END AS part FROM spine),
medians AS (SELECT median(quantity) AS mq, median(steady) AS ms FROM marked WHERE part = 'train')
SELECT supplier, date, coalesce(quantity, mq) AS quantity, round(coalesce(steady, ms), 5) AS steady, part
FROM marked, medians"""),
    "predictor_screen": (predictor_screen_query, f"""
WITH {SUPPLIER_MONTH}, shares AS (
  SELECT count(revenue) / count(*)::DOUBLE AS revenue, count(discount) / count(*)::DOUBLE AS discount,
         count(lines) / count(*)::DOUBLE AS lines, count(steady) / count(*)::DOUBLE AS steady,
         count(*) FILTER (WHERE lines >= 20) / count(*)::DOUBLE AS rare FROM supplier_month),
long AS (UNPIVOT shares ON revenue, discount, lines, steady, rare INTO NAME "column" VALUE ratio)
SELECT "column", round(ratio, 9) AS ratio, ratio >= 0.5 AS is_predictor FROM long"""),
}
