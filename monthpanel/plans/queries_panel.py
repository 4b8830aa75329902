"""Registered queries: aggregation and the panel contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthpanel.functions.months import month_start
from monthpanel.functions.stats import row_count, row_mean
from monthpanel.operators.clean import sum_by_month, truncate_to_month
from monthpanel.operators.panel import (
    first_per_month, merge_monthly, missing_and_extra_months, month_mean, month_spine, panel_report,
    panel_violations, strict_panel, strict_series, to_long,
)
from monthpanel.operators.quality import dataset_shape, value_counts
from monthpanel.plans.views import (
    NATION_MONTH, SUPPLIER_MONTH, nation_month, nation_orders, rounded, supplier_month, supplier_spine_sql, table,
)

START, END = "1996-01-01", "2000-12-01"


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumns(
        {"supplier": F.col("l_suppkey"), "date": month_start(F.col("l_shipdate"))}
    )


def sum_min_count(spark, sf_dir):
    flagged = _lines(spark, sf_dir).select(
        "supplier", "date", "l_quantity",
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).alias("returned"),
    )
    sums = sum_by_month(flagged, ["l_quantity", "returned"], ["supplier"])
    return rounded(sums.withColumnRenamed("l_quantity", "quantity"), returned=2)


def dup_month_mean(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.col("l_shipdate").alias("date"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
    )
    return rounded(month_mean(rows, ["supplier"]), quantity=8, price=8)


def first_non_null(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"), month_start(F.col("o_orderdate")).alias("date"), "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("finished"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).alias("open"),
    )
    return first_per_month(orders, ["finished", "open"], "o_orderkey", ["priority"])


def row_mean_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    parts = [
        F.col("l_quantity"), F.when(F.col("l_returnflag") == "R", F.col("l_tax") * 100),
        F.when(F.col("l_linestatus") == "O", F.col("l_discount") * 100),
    ]
    return lines.select(
        "l_orderkey", "l_linenumber", F.round(row_mean(parts), 6).alias("mean"), row_count(parts).alias("observed")
    )


def value_counts_query(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "orders"), "o_orderpriority", ["o_orderstatus"])


def dataset_shape_query(spark, sf_dir):
    return dataset_shape(nation_month(spark, sf_dir))


def month_start_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("date"))
    return truncate_to_month(orders)


def month_spine_query(spark, sf_dir):
    months = supplier_month(spark, sf_dir).select("supplier", "date", "quantity")
    return month_spine(months, keys=["supplier"])


def missing_months_query(spark, sf_dir):
    months = supplier_month(spark, sf_dir).select("supplier", "date")
    return missing_and_extra_months(months, START, END, ["supplier"])


def merge_outer(spark, sf_dir):
    orders = nation_orders(spark, sf_dir)
    placed = sum_by_month(orders.withColumnRenamed("o_totalprice", "ordered"), ["ordered"], ["nation"])
    urgent = sum_by_month(
        orders.where(F.col("o_orderpriority") == "1-URGENT").withColumnRenamed("o_totalprice", "urgent"),
        ["urgent"], ["nation"],
    )
    suppliers = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", F.col("n_name").alias("nation"))
    lines = _lines(spark, sf_dir).select("supplier", "date", F.col("l_quantity").alias("shipped"))
    shipped = sum_by_month(
        sum_by_month(lines, ["shipped"], ["supplier"]).join(suppliers, F.col("supplier") == F.col("s_suppkey")),
        ["shipped"], ["nation"],
    )
    return rounded(merge_monthly([placed, urgent, shipped], ["nation"]), ordered=2, urgent=2)


def _totals(spark, sf_dir):
    """Monthly totals of three tables; events cover one month only, so their column is incomplete."""
    orders = table(spark, sf_dir, "orders").select(
        month_start(F.col("o_orderdate")).alias("date"), F.col("o_totalprice").alias("ordered"))
    lines = _lines(spark, sf_dir).select("date", F.col("l_quantity").alias("shipped"))
    events = table(spark, sf_dir, "events").select(
        month_start(F.col("ts")).alias("date"), F.col("value").alias("activity"))
    return merge_monthly([sum_by_month(orders, ["ordered"]), sum_by_month(lines, ["shipped"]),
                          sum_by_month(events, ["activity"])])


def strict_panel_query(spark, sf_dir):
    panel, _ = strict_panel(_totals(spark, sf_dir), START, END, required=["ordered"])
    return rounded(panel, ordered=2)


def panel_report_query(spark, sf_dir):
    report = panel_report(_totals(spark, sf_dir), START, END)
    return report.select(
        "start", "end", "expected_months", "rows", "is_complete",
        F.explode("missing_by_column").alias("column", "missing"), "selected_columns",
    ).select(
        "start", "end", "expected_months", "rows", "is_complete", "column", "missing",
        F.array_contains("selected_columns", F.col("column")).alias("selected"),
    )


def strict_series_query(spark, sf_dir):
    long = to_long(supplier_month(spark, sf_dir), ["quantity", "steady"], ["supplier"])
    return rounded(strict_series(long, START, END, ["supplier"]), value=4)


def panel_violations_query(spark, sf_dir):
    months = supplier_month(spark, sf_dir).select("supplier", "date", "quantity", "steady")
    return panel_violations(months, START, END, ["supplier"])


_TOTALS = """totals AS (
  SELECT date, max(ordered) AS ordered, max(shipped) AS shipped, max(activity) AS activity FROM (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, sum(o_totalprice) AS ordered,
           NULL::DOUBLE AS shipped, NULL::DOUBLE AS activity FROM orders GROUP BY 1
    UNION ALL
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE), NULL, sum(l_quantity), NULL FROM lineitem GROUP BY 1
    UNION ALL
    SELECT CAST(date_trunc('month', ts) AS DATE), NULL, NULL, sum(value) FROM events GROUP BY 1) GROUP BY date),
months AS (
  SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '2000-12-01', INTERVAL 1 MONTH)) AS DATE) AS date)"""

_GAPS = f"""WITH {SUPPLIER_MONTH},
expected AS (
  SELECT supplier, CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 MONTH)) AS DATE) AS date
  FROM (SELECT DISTINCT supplier FROM supplier_month)),
gaps AS (
  SELECT 'missing' AS kind, supplier, date FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM supplier_month s WHERE s.supplier = e.supplier AND s.date = e.date)
  UNION ALL
  SELECT 'extra', supplier, date FROM supplier_month WHERE date < DATE '{START}' OR date > DATE '{END}')"""

QUERIES = {
    "sum_min_count": (sum_min_count, """
SELECT l_suppkey AS supplier, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, sum(l_quantity) AS quantity,
       round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS returned
FROM lineitem GROUP BY 1, 2"""),
    "dup_month_mean": (dup_month_mean, """
SELECT l_suppkey AS supplier, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
       round(avg(l_quantity), 8) AS quantity, round(avg(l_extendedprice), 8) AS price,
       avg(TRY_CAST(l_returnflag AS DOUBLE)) AS flag
FROM lineitem GROUP BY 1, 2"""),
    "first_non_null": (first_non_null, """
SELECT o_orderpriority AS priority, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
       arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS finished,
       arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS open
FROM orders GROUP BY 1, 2"""),
    "row_mean": (row_mean_query, """
SELECT l_orderkey, l_linenumber,
       round(list_avg([l_quantity, CASE WHEN l_returnflag = 'R' THEN l_tax * 100 END,
                       CASE WHEN l_linestatus = 'O' THEN l_discount * 100 END]), 6) AS mean,
       CAST(1 + (l_returnflag = 'R')::INT + (l_linestatus = 'O')::INT AS INT) AS observed
FROM lineitem"""),
    "value_counts": (value_counts_query, """
SELECT o_orderstatus, o_orderpriority, count(*) AS rows FROM orders GROUP BY 1, 2"""),
    "dataset_shape": (dataset_shape_query, f"""
WITH {NATION_MONTH}
SELECT count(*) AS rows, CAST(4 AS INT) AS columns, min(date) AS first_date, max(date) AS last_date
FROM nation_month"""),
    "month_start": (month_start_query, """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders"""),
    "month_spine": (month_spine_query, f"""
WITH {SUPPLIER_MONTH}, {supplier_spine_sql('quantity')} SELECT * FROM spine"""),
    "missing_months": (missing_months_query, _GAPS + " SELECT * FROM gaps"),
    "merge_outer": (merge_outer, """
WITH o AS (
  SELECT n_name AS nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, o_totalprice, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
placed AS (SELECT nation, date, sum(o_totalprice) AS ordered FROM o GROUP BY 1, 2),
urgent AS (SELECT nation, date, sum(o_totalprice) AS urgent FROM o WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2),
shipped AS (
  SELECT n_name AS nation, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, sum(l_quantity) AS shipped
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
SELECT nation, date, round(ordered, 2) AS ordered, round(urgent, 2) AS urgent, shipped
FROM placed FULL JOIN urgent USING (nation, date) FULL JOIN shipped USING (nation, date)"""),
    "strict_panel": (strict_panel_query, f"""
WITH {_TOTALS}
SELECT date, round(ordered, 2) AS ordered, shipped FROM months JOIN totals USING (date)"""),
    "panel_report": (panel_report_query, f"""
WITH {_TOTALS},
spine AS (SELECT * FROM months LEFT JOIN totals USING (date)),
facts AS (SELECT min(date) AS "start", max(date) AS "end", count(*) AS rows, count(*) - count(ordered) AS ordered,
                 count(*) - count(shipped) AS shipped, count(*) - count(activity) AS activity FROM spine),
long AS (
  SELECT 'ordered' AS "column", ordered AS missing FROM facts UNION ALL
  SELECT 'shipped', shipped FROM facts UNION ALL SELECT 'activity', activity FROM facts)
SELECT "start", "end", rows AS expected_months, rows, true AS is_complete, "column", missing, missing = 0 AS selected
FROM facts, long"""),
    "strict_series": (strict_series_query, f"""
WITH {SUPPLIER_MONTH},
long AS (
  SELECT supplier, date, 'quantity' AS series, quantity AS value FROM supplier_month UNION ALL
  SELECT supplier, date, 'steady', steady FROM supplier_month WHERE steady IS NOT NULL),
inside AS (SELECT * FROM long WHERE date BETWEEN DATE '{START}' AND DATE '{END}')
SELECT supplier, series, date, round(value, 4) AS value FROM inside
QUALIFY count(*) OVER (PARTITION BY supplier, series) = 60"""),
    "panel_violations": (panel_violations_query, _GAPS + """
SELECT kind, supplier, date, NULL::VARCHAR AS "column" FROM gaps
UNION ALL SELECT 'null', supplier, date, 'steady' FROM supplier_month WHERE steady IS NULL"""),
}
