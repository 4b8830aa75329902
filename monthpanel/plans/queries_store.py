"""Registered queries: sinks that are safe to rerun, bucketed panels, scans with rejects, an end-to-end contest per series."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from monthpanel.operators.features import add_lags
from monthpanel.operators.learn import RIDGE_ALPHA
from monthpanel.plans.lifecycle import forecast_contest
from monthpanel.plans.queries_learn import KEYED
from monthpanel.plans.views import SUPPLIER_MONTH, nation_month, rounded, supplier_month
from monthpanel.sources.store import read_committed, read_panel, scan_with_rejects, write_committed, write_panel
from monthpanel.sources.tables import new_folder


def _models(spark, sf_dir):
    months = supplier_month(spark, sf_dir)
    return months.select("supplier", "date", F.when(F.col("lines") > 4, "many").when(F.col("lines") > 1, "few").otherwise("one").alias("model"), "quantity")


def sink_versions(spark, sf_dir):
    """Three models written, then one of them replaced, then a new one added."""
    path, rows = new_folder(spark, "versions"), _models(spark, sf_dir)
    write_committed(rows, path, "model")
    write_committed(rows.where("model = 'few'").withColumn("quantity", -F.col("quantity")), path, "model")
    write_committed(rows.where("model = 'one'").withColumn("model", F.lit("new")), path, "model")
    return read_committed(spark, path, rows.schema, "model")


def bucketed_merge(spark, sf_dir):
    """Two sources stored by supplier, merged and lagged where they lie."""
    months, table = supplier_month(spark, sf_dir), f"panel_{uuid.uuid4().hex}"
    sources = {"shipped": months.select("supplier", "date", "quantity"), "sold": months.where("lines > 1").select("supplier", "date", "lines")}
    write_panel(sources, table, new_folder(spark, "buckets"), ["supplier"], 8)
    return add_lags(read_panel(spark, table, ["supplier"]), ["quantity", "lines"], [1, 12], ["supplier"])


def _spoiled(spark, sf_dir):
    """Supplier months as delimited files in which some cells are no numbers or dates, or are absent."""
    path, months = new_folder(spark, "spoiled"), supplier_month(spark, sf_dir)
    cells = months.select(
        "supplier",
        F.when(F.col("lines") == 3, "sin fecha").otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("lines") == 2, "n/d").when(F.col("lines") == 1, "").otherwise(F.col("quantity").cast("string")).alias("quantity"),
    )
    cells.write.option("header", True).csv(path)
    return scan_with_rejects(spark, path, {"supplier": "number", "date": "month", "quantity": "number"})


def scan_rows(spark, sf_dir):
    return _spoiled(spark, sf_dir)[0]


def scan_rejects(spark, sf_dir):
    return _spoiled(spark, sf_dir)[1].groupBy("column", "text", "reason").agg(F.count("*").alias("cells"))


def forecast_contest_query(spark, sf_dir):
    """Baselines and a ridge of its own for every nation, from the panel to the improvement."""
    months = nation_month(spark, sf_dir).select("nation", "date", "revenue")
    made = forecast_contest(months, "revenue", 12, ["nation"], models=["ridge_lagged"], per_key=True, features=["revenue_lag_1", "revenue_lag_12"])
    chosen = made["improvement"].select("nation", "baseline_model", "baseline_rmse", "best_model", "best_rmse", "rmse_improvement_pct", "beats_baseline")
    return rounded(chosen, baseline_rmse=2, best_rmse=2, rmse_improvement_pct=4)


SQL = {
    "sink_versions": f"""WITH {SUPPLIER_MONTH},
models AS (SELECT supplier, date, CASE WHEN lines > 4 THEN 'many' WHEN lines > 1 THEN 'few' ELSE 'one' END AS model, quantity FROM supplier_month)
SELECT supplier, date, model, CASE WHEN model = 'few' THEN -quantity ELSE quantity END AS quantity FROM models
UNION ALL SELECT supplier, date, 'new', quantity FROM models WHERE model = 'one'""",
    "bucketed_merge": f"""WITH {SUPPLIER_MONTH},
merged AS (SELECT supplier, date, quantity, CASE WHEN lines > 1 THEN lines END AS lines FROM supplier_month)
SELECT *, {', '.join(f'lag({c}, {k}) OVER w AS {c}_lag_{k}' for c in ('quantity', 'lines') for k in (1, 12))}
FROM merged WINDOW w AS (PARTITION BY supplier ORDER BY date)""",
    "scan_rows": f"""WITH {SUPPLIER_MONTH}
SELECT CAST(supplier AS DOUBLE) AS supplier, CASE WHEN lines <> 3 THEN date END AS date, CASE WHEN lines > 2 THEN quantity END AS quantity FROM supplier_month""",
    "scan_rejects": f"""WITH {SUPPLIER_MONTH}
SELECT 'date' AS "column", 'sin fecha' AS text, 'not a month' AS reason, count(*) AS cells FROM supplier_month WHERE lines = 3 HAVING count(*) > 0
UNION ALL SELECT 'quantity', 'n/d', 'not a number', count(*) FROM supplier_month WHERE lines = 2 HAVING count(*) > 0""",
    "forecast_contest": f"""WITH {KEYED},
solved AS (
  SELECT nation, ((d + {RIDGE_ALPHA}) * p - b * q) / ((a + {RIDGE_ALPHA}) * (d + {RIDGE_ALPHA}) - b * b) AS w1,
         ((a + {RIDGE_ALPHA}) * q - b * p) / ((a + {RIDGE_ALPHA}) * (d + {RIDGE_ALPHA}) - b * b) AS w2 FROM sums),
placed AS (SELECT nation, date, revenue AS y, row_number() OVER w - (count(*) OVER (PARTITION BY nation) - 12) AS step, lag(revenue, 12) OVER w AS before
  FROM nation_month WINDOW w AS (PARTITION BY nation ORDER BY date)),
guesses AS (
  SELECT nation, max(y) FILTER (step = 0) AS naive, avg(y) FILTER (step BETWEEN -2 AND 0) AS moving_average_3, avg(y) FILTER (step BETWEEN -5 AND 0) AS moving_average_6
  FROM placed GROUP BY nation),
forecasts AS (
  SELECT nation, y, 'naive' AS model, naive AS f FROM placed JOIN guesses USING (nation) WHERE step > 0
  UNION ALL SELECT nation, y, 'moving_average_3', moving_average_3 FROM placed JOIN guesses USING (nation) WHERE step > 0
  UNION ALL SELECT nation, y, 'moving_average_6', moving_average_6 FROM placed JOIN guesses USING (nation) WHERE step > 0
  UNION ALL SELECT nation, y, 'seasonal_naive_12', before FROM placed WHERE step > 0),
scores AS (SELECT nation, model, sqrt(avg((y - f) * (y - f))) AS rmse FROM forecasts GROUP BY nation, model),
baseline AS (SELECT nation, model AS baseline_model, rmse AS baseline_rmse FROM scores QUALIFY row_number() OVER (PARTITION BY nation ORDER BY rmse, model) = 1),
ridge AS (SELECT nation, sqrt(avg(power(y - my - w1 * z1 - w2 * z2, 2))) AS best_rmse FROM z JOIN solved USING (nation) WHERE NOT train GROUP BY nation)
SELECT nation, baseline_model, round(baseline_rmse, 2) AS baseline_rmse, 'ridge_lagged' AS best_model, round(best_rmse, 2) AS best_rmse,
       round((baseline_rmse - best_rmse) / baseline_rmse * 100, 4) AS rmse_improvement_pct, best_rmse < baseline_rmse AS beats_baseline
FROM baseline JOIN ridge USING (nation)""",
}

QUERIES = {name: (query, SQL[name]) for name, query in {
    "sink_versions": sink_versions, "bucketed_merge": bucketed_merge, "scan_rows": scan_rows, "scan_rejects": scan_rejects, "forecast_contest": forecast_contest_query,
}.items()}
