"""Registered queries: layouts read back from cell tables and published tables.

The SQL computes from ``lineitem`` what the layouts must give back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from monthpanel.operators.blocks import activity_series, aggregate_sheet, component_sheets, first_data_rows
from monthpanel.operators.panel import to_wide
from monthpanel.operators.reshape import (
    construction_records, material_index, two_row_header, year_matrix, year_matrix_cells,
)
from monthpanel.plans.queries_clean import named_month
from monthpanel.plans.sheets import (
    FLAGGED_MONTHS, activity_books, aggregate_book, flagged_months, listing_book, published, two_row_book, year_matrix_book,
)
from monthpanel.plans.views import SUPPLIER_MONTH, rounded, supplier_month, table
from monthpanel.sources.cells import table_from_cells

MATERIALS = ["cemento", "agregado"]


def year_matrix_query(spark, sf_dir):
    """Supplier matrices: a row per month name and a total, a column per year."""
    months = supplier_month(spark, sf_dir)
    years = [str(y) for y in range(1995, 2003)]
    labelled = months.select("supplier", "quantity", F.year("date").cast("string").alias("year"), F.explode(
        F.array(named_month(F.col("date")), F.lit("Total"))).alias("Mes"))
    matrix = labelled.groupBy("supplier", "Mes").pivot("year", years).agg(F.sum("quantity"))
    return year_matrix(matrix, "quantity", ["supplier"])


def year_matrix_sheet(spark, sf_dir):
    return year_matrix_cells(published(year_matrix_book(supplier_month(spark, sf_dir))), "quantity")


def pivot_mean(spark, sf_dir):
    long = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.trunc("l_shipdate", "MM").alias("date"),
        F.col("l_returnflag").alias("series"), F.col("l_quantity").alias("value"),
    )
    return rounded(to_wide(long, ["A", "N", "R"], ["supplier"]), A=8, N=8, R=8)


def quarter_to_month(spark, sf_dir):
    day = F.col("l_shipdate")
    records = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.year(day).alias("Año"), F.quarter(day).cast("string").alias("Trimestre"),
        F.format_number("l_quantity", 1).alias("Num construcciones"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).alias("Área m2"),
    )
    made = construction_records(records, ["supplier"])
    return rounded(made, construction_num_constructions=6, construction_area_m2=5)


def header_ffill(spark, sf_dir):
    return two_row_header(two_row_book(flagged_months(spark, sf_dir)), keywords=MATERIALS)


def material_index_query(spark, sf_dir):
    long = two_row_header(two_row_book(flagged_months(spark, sf_dir)), keywords=MATERIALS)
    return rounded(material_index(long, ["agregados", "cemento_gris"]), ipmc_cement_related_index=6)


def header_promote(spark, sf_dir):
    book = published(listing_book(supplier_month(spark, sf_dir)))
    return table_from_cells(book, 2, names=["ano", "mes", "cantidad", "valor_usd", "valor_usd_1"])


def sheet_first_data_row(spark, sf_dir):
    book = published(aggregate_book(supplier_month(spark, sf_dir), "supplier"))
    observed = aggregate_sheet(book).where("value is not null")
    return observed.join(first_data_rows(book).drop("sheet"), "path")


def sheet_detect(spark, sf_dir):
    return component_sheets(activity_books(flagged_months(spark, sf_dir)))


def block_discovery(spark, sf_dir):
    return activity_series(published(activity_books(flagged_months(spark, sf_dir))))


QUERIES = {
    "year_matrix_unpivot": (year_matrix_query, f"""
WITH {SUPPLIER_MONTH},
grid AS (
  SELECT supplier, make_date(y::BIGINT, m, 1) AS date
  FROM (SELECT DISTINCT supplier, month(date) AS m FROM supplier_month), range(1995, 2003) AS t(y))
SELECT supplier, date, quantity FROM grid LEFT JOIN supplier_month USING (supplier, date)"""),
    "year_matrix_sheet": (year_matrix_sheet, f"""
WITH {SUPPLIER_MONTH},
grid AS (
  SELECT supplier, make_date(y, m, 1) AS date
  FROM (SELECT DISTINCT supplier, month(date) AS m FROM supplier_month)
  JOIN (SELECT DISTINCT supplier, year(date) AS y FROM supplier_month) USING (supplier))
SELECT CAST(supplier AS VARCHAR) AS path, date, quantity FROM grid LEFT JOIN supplier_month USING (supplier, date)"""),
    "pivot_mean": (pivot_mean, """
SELECT l_suppkey AS supplier, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
       round(avg(l_quantity) FILTER (WHERE l_returnflag = 'A'), 8) AS "A",
       round(avg(l_quantity) FILTER (WHERE l_returnflag = 'N'), 8) AS "N",
       round(avg(l_quantity) FILTER (WHERE l_returnflag = 'R'), 8) AS "R"
FROM lineitem GROUP BY 1, 2"""),
    "quarter_to_month": (quarter_to_month, """
WITH q AS (
  SELECT l_suppkey AS supplier, date_trunc('quarter', l_shipdate) AS start, sum(l_quantity) AS n,
         round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS area
  FROM lineitem GROUP BY 1, 2)
SELECT supplier, CAST(start + to_months(CAST(s.i AS INT)) AS DATE) AS date, round(n / 3, 6) AS construction_num_constructions,
       round(area / 3, 5) AS construction_area_m2
FROM q, (SELECT unnest(range(3)) AS i) s"""),
    "header_ffill": (header_ffill, f"""
WITH {FLAGGED_MONTHS}
SELECT CAST(supplier AS VARCHAR) AS path, date, CASE flag WHEN 'A' THEN 'cemento_gris' ELSE 'agregados' END AS series,
       quantity AS value
FROM flagged WHERE flag IN ('A', 'N')"""),
    "material_index": (material_index_query, f"""
WITH {FLAGGED_MONTHS}
SELECT CAST(supplier AS VARCHAR) AS path, date, max(quantity) FILTER (WHERE flag = 'N') AS ipmc_agregados_index,
       max(quantity) FILTER (WHERE flag = 'A') AS ipmc_cemento_gris_index, round(avg(quantity), 6) AS ipmc_cement_related_index
FROM flagged WHERE flag IN ('A', 'N') GROUP BY 1, 2"""),
    "header_promote": (header_promote, f"""
WITH {SUPPLIER_MONTH}
SELECT CAST(supplier AS VARCHAR) AS path, 'Hoja1' AS sheet,
       CAST((year(date) - 1995) * 12 + month(date) + 2 AS INT) AS row, CAST(year(date) AS VARCHAR) AS ano,
       ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', 'Octubre', 'Noviembre',
        'Diciembre'][month(date)] AS mes, CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS cantidad,
       format('{{:,.2f}}', revenue) AS valor_usd, CAST(lines AS VARCHAR) AS valor_usd_1
FROM supplier_month"""),
    "sheet_first_data_row": (sheet_first_data_row, f"""
WITH {SUPPLIER_MONTH},
firsts AS (SELECT supplier, min((year(date) - 1995) * 12 + month(date) + 4) AS r FROM supplier_month GROUP BY 1),
long AS (
  SELECT supplier, date, 'imae_general_index' AS series, lines * 10.0 AS value FROM supplier_month UNION ALL
  SELECT supplier, date, 'imae_general_yoy', lines FROM supplier_month UNION ALL
  SELECT supplier, date, 'imae_general_trend_yoy', lines FROM supplier_month WHERE lines > 1)
SELECT CAST(supplier AS VARCHAR) AS path, date, series, CAST(value AS DOUBLE) AS value, CAST(r AS INT) AS first_row
FROM long JOIN firsts USING (supplier)"""),
    "sheet_detect": (sheet_detect, f"""
WITH {FLAGGED_MONTHS}
SELECT DISTINCT supplier || '-' || flag AS path, CASE flag WHEN 'R' THEN 'Componentes nuevos' ELSE 'C.2' END AS sheet
FROM flagged"""),
    "block_discovery": (block_discovery, f"""
WITH {FLAGGED_MONTHS}, books AS (SELECT *, supplier || '-' || flag AS path FROM flagged),
long AS (
  SELECT path, date, 'imae_construction_index' AS series, quantity AS value FROM books WHERE flag <> 'R' UNION ALL
  SELECT path, date, 'imae_construction_yoy', price FROM books WHERE flag <> 'R' UNION ALL
  SELECT path, date, 'imae_general_index', lines FROM books WHERE flag = 'N' UNION ALL
  SELECT path, date, 'imae_general_index_x', lines FROM books WHERE flag = 'A' UNION ALL
  SELECT path, date, 'imae_general_index_y', lines * 10 FROM books WHERE flag = 'A' UNION ALL
  SELECT path, date, CASE flag WHEN 'N' THEN 'imae_general_yoy' ELSE 'imae_general_yoy_x' END, lines * 2
  FROM books WHERE flag <> 'R' AND lines > 1 UNION ALL
  SELECT path, date, 'imae_general_yoy_y', lines FROM books WHERE flag = 'A' UNION ALL
  SELECT path, date, 'imae_general_trend_yoy', lines FROM books WHERE flag = 'A' AND lines > 1 UNION ALL
  SELECT path, date, 'imae_construction_' || s, quantity + i FROM books,
    (VALUES (0, 'index'), (1, 'yoy'), (2, 'trend_index'), (3, 'trend_yoy')) v(i, s) WHERE flag = 'R' UNION ALL
  SELECT path, date, 'imae_general_' || s, price + i FROM books,
    (VALUES (0, 'index'), (1, 'yoy'), (2, 'trend_index'), (3, 'trend_yoy')) v(i, s) WHERE flag = 'R')
SELECT path, date, series, CAST(value AS DOUBLE) AS value FROM long"""),
}
