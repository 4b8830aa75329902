"""Monthly base tables over the driver's parquet tables, each with the same thing in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthpanel.functions.months import month_start
from monthpanel.operators.clean import sum_by_month


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round columns so that two engines' summation orders agree."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's nation: ``nation, date, o_totalprice, o_orderpriority``.

    No join is told to broadcast: nations and customers are broadcast only while
    their measured size allows, and a hot customer's orders are split by the skew join.
    """
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", F.col("n_name").alias("nation"))
    orders = table(spark, sf_dir, "orders")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "nation", month_start(F.col("o_orderdate")).alias("date"), "o_totalprice", "o_orderpriority"
    )


def nation_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value and count per nation and month."""
    months = nation_orders(spark, sf_dir).groupBy("nation", "date").agg(
        F.sum("o_totalprice").alias("revenue"), F.count("*").alias("orders")
    )
    return rounded(months, revenue=2)


NATION_MONTH = """nation_month AS (
  SELECT n_name AS nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         round(sum(o_totalprice), 2) AS revenue, count(*) AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""


def supplier_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped quantity, value, mean discount and lines per supplier and month.

    ``steady`` is the value of months with at least five lines, so it has gaps.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), month_start(F.col("l_shipdate")).alias("date"),
        "l_quantity", "l_discount", "l_extendedprice",
    )
    months = lines.groupBy("supplier", "date").agg(
        F.sum("l_quantity").alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
        F.round(F.avg("l_discount"), 10).alias("discount"), F.count("*").alias("lines"),
    )
    return months.withColumn("steady", F.when(F.col("lines") >= 5, F.col("revenue")))


SUPPLIER_MONTH = """supplier_month AS (
  SELECT *, CASE WHEN lines >= 5 THEN revenue END AS steady FROM (
    SELECT l_suppkey AS supplier, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
           sum(l_quantity) AS quantity, round(sum(l_extendedprice), 2) AS revenue,
           round(avg(l_discount), 10) AS discount, count(*) AS lines
    FROM lineitem GROUP BY 1, 2))"""


def supplier_spine_sql(value: str) -> str:
    """CTE ``spine``: every supplier and month between the first and last, with one value."""
    return f"""spine AS (
  SELECT k.supplier, CAST(m.d AS DATE) AS date, s.{value}
  FROM (SELECT DISTINCT supplier FROM supplier_month) k
  CROSS JOIN (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS d FROM supplier_month) m
  LEFT JOIN supplier_month s ON s.supplier = k.supplier AND s.date = CAST(m.d AS DATE))"""


def customer_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per customer and month: many short series."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"), month_start(F.col("o_orderdate")).alias("date"),
        F.col("o_totalprice").alias("revenue"),
    )
    return rounded(sum_by_month(orders, ["revenue"], ["customer"]), revenue=2)


CUSTOMER_MONTH = """customer_month AS (
  SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         round(sum(o_totalprice), 2) AS revenue
  FROM orders GROUP BY 1, 2)"""
