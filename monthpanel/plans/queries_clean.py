"""Registered queries: text, number and month cleaning.

Texts are written by Spark from the tables, in several notations; the SQL states
what reading them back must give.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from monthpanel.functions.months import month_number, strict_month
from monthpanel.functions.numbers import parse_number, to_number, year_in_text
from monthpanel.functions.text import slug, slug_soft
from monthpanel.operators.clean import drop_empty, generic_monthly, standardize_monthly, with_month
from monthpanel.plans.views import rounded, table

SPANISH = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre",
           "Noviembre", "Diciembre"]
ENGLISH = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sept", "Oct", "Nov", "Dec"]


def named_month(date, names=SPANISH):
    return F.get(F.array(*map(F.lit, names)), F.month(date) - 1)


def slug_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", slug(F.col("text")).alias("name"), slug_soft(F.col("text")).alias("label"))


def written_price():
    """``l_extendedprice`` in a notation per line number."""
    price, line = F.col("l_extendedprice"), F.col("l_linenumber")
    grouped = F.format_number(price, 2)
    return (
        F.when(line == 1, grouped)
        .when(line == 2, F.translate(grouped, ",.", ".,"))
        .when(line == 3, F.concat(F.lit("Q "), grouped))
        .when(line == 4, F.format_number(F.floor(price), 0))
        .when(line == 5, F.concat(F.lit("("), F.translate(grouped, ".,", ","), F.lit(")")))
        .when(line == 6, F.concat(grouped, F.lit("-")))
        .otherwise(F.lit("-"))
    )


def coerce_numeric(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", parse_number(written_price()).alias("price"),
        to_number(F.concat("l_returnflag", F.col("l_linenumber").cast("string"))).alias("flag"),
        to_number(F.col("l_linenumber").cast("string")).alias("line"),
    )


def month_name(spark, sf_dir):
    day, priority = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    label = (
        F.when(priority == "1", named_month(day))
        .when(priority == "2", F.concat(named_month(day, ENGLISH), F.lit("-"), F.date_format(day, "yy")))
        .when(priority == "3", F.date_format(day, "MM"))
        .when(priority == "4", F.concat(F.lit("  "), F.upper(named_month(day)), F.lit(" "), F.year(day)))
        .otherwise(F.lit("Total"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", month_number(label).alias("month"))


def extract_year(spark, sf_dir):
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    text = (
        F.when(status == "O", F.concat(F.lit("Indices "), F.year(day)))
        .when(status == "F", F.concat(F.lit("dic/"), F.year(day), F.lit(" (p)")))
        .otherwise(F.lit("base 21"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", year_in_text(text).alias("year"))


def build_month_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    parts = orders.select(
        "o_orderpriority", "o_orderkey", F.concat(F.year(day), F.lit(" ")).alias("ano"), named_month(day).alias("mes"),
        F.when(F.col("o_orderpriority") >= "3", "s/d").when(F.col("o_orderkey") % 2 == 0, F.date_format(day, "MMM yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss")).alias("fecha"),
    )
    dated = with_month(parts, "ano", "mes", "fecha", keys=["o_orderpriority"])
    return dated.select("o_orderkey", "date")


def strict_month_query(spark, sf_dir):
    day, priority = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    text = (
        F.when(priority == "1", F.date_format(day, "yyyy-MM-dd"))
        .when(priority == "2", F.date_format(day, "d/M/yyyy"))
        .when(priority == "3", F.date_format(day, " yyyy/M "))
        .when(priority == "4", F.date_format(F.add_months(day, -240), "yyyy-MM"))
        .otherwise(F.date_format(day, "yyyyMM"))
    )
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("double")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", strict_month(text).alias("from_text"), strict_month(F.lit("x"), F.col("o_orderdate")).alias("from_ts"),
        strict_month(F.lit("x"), None, serial, excel_serial=True).alias("from_serial"),
    )


def drop_empty_query(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("returned"),
        F.when(F.col("l_linestatus") == "O", F.col("l_tax")).alias("open_tax"),
        F.when(F.col("l_quantity") < 0, F.col("l_quantity")).alias("negative"),
    )
    return drop_empty(rows)


def _published(spark, sf_dir):
    """Lines as a published table: supplier, year, Spanish month, formatted numbers, notes."""
    day = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.year(day).cast("string").alias("Año"), named_month(day).alias("Mes"),
        F.format_number("l_extendedprice", 2).alias("Valor (USD)"),
        F.when(F.col("l_returnflag") == "R", F.format_number("l_quantity", 1)).alias("Peso kg"),
        F.lit("n/d").alias("Volumen"), F.col("l_quantity").alias("Costo"),
    )


def generic_monthly_query(spark, sf_dir):
    made = generic_monthly(_published(spark, sf_dir), "trade", ["valor", "peso", "volumen"], keys=["supplier"])
    return rounded(made, trade_valor_usd=2)


def standardize_monthly_query(spark, sf_dir):
    made = standardize_monthly(
        _published(spark, sf_dir), {"Costo": "Quantity", "Peso kg": "Returned kg", "Nada": "nothing"},
        year_col="Año", month_col="Mes", keys=["supplier"],
    )
    return made


QUERIES = {
    "slug_text": (slug_text, r"""
WITH folded AS (SELECT doc_id, strip_accents(lower(text)) AS t FROM documents),
made AS (
  SELECT doc_id, trim(regexp_replace(regexp_replace(t, '[^\x00-\x7F]', '', 'g'), '[^a-z0-9]+', '_', 'g'), '_') AS name,
         trim(regexp_replace(t, '[^a-z0-9]+', '_', 'g'), '_') AS label FROM folded)
SELECT doc_id, CASE WHEN name = '' THEN 'unnamed' ELSE name END AS name, label FROM made"""),
    "coerce_numeric": (coerce_numeric, """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber IN (1, 2, 3, 5) THEN l_extendedprice WHEN l_linenumber = 4 THEN floor(l_extendedprice) END AS price,
       NULL::DOUBLE AS flag, CAST(l_linenumber AS DOUBLE) AS line
FROM lineitem"""),
    "month_name": (month_name, """
SELECT o_orderkey, CASE WHEN o_orderpriority[1] IN ('1', '2', '3', '4') THEN CAST(month(o_orderdate) AS INT) END AS month
FROM orders"""),
    "extract_year": (extract_year, """
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('O', 'F') THEN CAST(year(o_orderdate) AS INT) END AS year FROM orders"""),
    "build_month_date": (build_month_date, """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders"""),
    "strict_month": (strict_month_query, """
SELECT o_orderkey, CAST(CASE WHEN o_orderpriority[1] IN ('1', '3') THEN date_trunc('month', o_orderdate)
    WHEN o_orderpriority[1] = '2' AND day(o_orderdate) > 12 THEN date_trunc('month', o_orderdate)
    WHEN o_orderpriority[1] = '2' THEN make_date(year(o_orderdate), day(o_orderdate), 1) END AS DATE) AS from_text,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS from_ts, CAST(date_trunc('month', o_orderdate) AS DATE) AS from_serial
FROM orders"""),
    "drop_empty": (drop_empty_query, """
SELECT CASE WHEN l_returnflag = 'R' THEN l_quantity END AS returned, CASE WHEN l_linestatus = 'O' THEN l_tax END AS open_tax
FROM lineitem WHERE l_returnflag = 'R' OR l_linestatus = 'O'"""),
    "generic_monthly": (generic_monthly_query, """
SELECT l_suppkey AS supplier, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
       round(sum(l_extendedprice), 2) AS trade_valor_usd,
       sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS trade_peso_kg
FROM lineitem GROUP BY 1, 2"""),
    "standardize_monthly": (standardize_monthly_query, """
SELECT l_suppkey AS supplier, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, sum(l_quantity) AS quantity,
       sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS returned_kg
FROM lineitem GROUP BY 1, 2"""),
}
