"""Registered queries: which columns and months count, whole datasets built from workbooks, sinks read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthpanel.operators.clean import exogenous_columns, numeric_series_columns, proxy_candidates
from monthpanel.operators.panel import missing_months
from monthpanel.operators.targets import default_target, validate_target
from monthpanel.plans.lifecycle import build_dataset
from monthpanel.plans.sheets import cell, published, word, workbooks, year_matrix_book
from monthpanel.plans.views import SUPPLIER_MONTH, rounded, supplier_month, table
from monthpanel.sources.tables import new_folder, read_monthly, write_dataset, write_predictions


def column_choice(spark, sf_dir):
    """Columns of the supplier panel by role, a row for each: decided by names, types and counts of values."""
    panel = supplier_month(spark, sf_dir).select(
        "supplier", "date", "quantity", F.col("revenue").alias("construction_cost_gtq"),
        F.when(F.col("lines") > 100_000, F.col("lines")).alias("trade_lines"), F.col("discount").cast("string").alias("discount"),
    )
    target = default_target(panel, ["supplier"])
    validate_target(panel, target, keys=["supplier"])
    chosen = {
        "series": numeric_series_columns(panel.drop("supplier")), "proxy": proxy_candidates(panel.columns, ["supplier"]),
        "exogenous": exogenous_columns(panel.drop("date"), target, ["supplier"]), "target": [target],
    }
    months = panel.groupBy().agg(F.count("*").alias("rows"))
    roles = F.array(*[F.struct(F.lit(role).alias("role"), F.lit(name).alias("column")) for role, names in chosen.items() for name in names])
    return months.select("rows", F.explode(roles).alias("r")).select("rows", "r.*")


def required_coverage(spark, sf_dir):
    """Months from 1996 to 1999 in which a supplier has no value of a required column."""
    return missing_months(supplier_month(spark, sf_dir), "steady", "1996-01-01", "1999-12-01", ["supplier"])


def _trade_book(months):
    at = "(year(date) - 1995) * 12 + month(date) + 7"
    return workbooks(
        months, "supplier",
        fixed=[word(0, 0, "Comercio"), word(7, 0, "Fecha"), word(7, 1, "Valor"), word(7, 2, "Valor"), word(7, 3, "Notas")],
        own=[cell(at, 0, "date_format(date, 'yyyy-MM')"), cell(at, 1, num="revenue"), cell(at, 2, "format_number(lines, 0)"), cell(at, 3, "'n/d'")],
    )


def dataset_build(spark, sf_dir):
    """Two kinds of workbooks per supplier in one dataset: a year matrix, and a trade table that repeats a header."""
    months = supplier_month(spark, sf_dir)
    sources = [("remittances", published(year_matrix_book(months))), ("trade_by_product", published(_trade_book(months)))]
    return rounded(build_dataset(sources, keys=["path"], target=None), trade_valor=2)


def sink_round_trip(spark, sf_dir):
    """The supplier panel as CSV and as one folder for each model, read back and put together."""
    folder, months = new_folder(spark, "sinks"), supplier_month(spark, sf_dir)
    write_dataset(months.select("supplier", "date", "quantity", "steady"), f"{folder}/dataset", "csv")
    write_predictions(months.select("supplier", "date", F.when(F.col("lines") > 4, "many").otherwise("few").alias("model"), "lines"), f"{folder}/models")
    dataset = read_monthly(spark, f"{folder}/dataset", "supplier long, date date, quantity double, steady double")
    models = read_monthly(spark, f"{folder}/models", fmt="parquet")
    return rounded(dataset.join(models, ["supplier", "date"]), steady=2)


QUERIES = {
    "column_choice": (column_choice, f"""
WITH {SUPPLIER_MONTH}, size AS (SELECT count(*) AS rows FROM supplier_month)
SELECT rows, role, "column" FROM size, (VALUES
  ('series', 'quantity'), ('series', 'construction_cost_gtq'), ('series', 'discount'), ('proxy', 'construction_cost_gtq'), ('proxy', 'trade_lines'),
  ('exogenous', 'quantity'), ('exogenous', 'trade_lines'), ('target', 'construction_cost_gtq')) AS t(role, "column")"""),
    "required_coverage": (required_coverage, f"""
WITH {SUPPLIER_MONTH},
grid AS (
  SELECT supplier, CAST(unnest(generate_series(DATE '1996-01-01', DATE '1999-12-01', INTERVAL 1 MONTH)) AS DATE) AS date
  FROM (SELECT DISTINCT supplier FROM supplier_month))
SELECT supplier, date FROM grid LEFT JOIN supplier_month USING (supplier, date) WHERE steady IS NULL"""),
    "dataset_build": (dataset_build, f"""
WITH {SUPPLIER_MONTH},
grid AS (
  SELECT supplier, make_date(y, m, 1) AS date FROM (SELECT DISTINCT supplier, month(date) AS m FROM supplier_month)
  JOIN (SELECT DISTINCT supplier, year(date) AS y FROM supplier_month) USING (supplier))
SELECT CAST(supplier AS VARCHAR) AS path, date, quantity AS remittances_usd_millions, round(revenue, 2) AS trade_valor,
       CAST(lines AS DOUBLE) AS trade_valor_1
FROM grid LEFT JOIN supplier_month USING (supplier, date)"""),
    "sink_round_trip": (sink_round_trip, f"""
WITH {SUPPLIER_MONTH}
SELECT supplier, date, quantity, round(steady, 2) AS steady, CASE WHEN lines > 4 THEN 'many' ELSE 'few' END AS model, lines FROM supplier_month"""),
}
