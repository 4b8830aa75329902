"""Registered queries over one series of all line items, by ship date: nothing but the order divides it."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthpanel.operators.long_series import features_long, fill_forward_long, holdout_long, interpolate_long, lag_long, rolling_long
from monthpanel.plans.views import rounded, table

# Rows equal in all of these are equal in all that the queries return.
ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
# Small enough for several buckets in the smallest tables.
ROWS = 2000


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*ORDER)


def _gaps(spark, sf_dir):
    """Prices of large lines only; among the lines of early orders there are none for long stretches."""
    seen = (F.col("l_quantity") >= 30) & (F.year("l_shipdate") > 1995)
    return _lines(spark, sf_dir).withColumn("price", F.when(seen, F.col("l_extendedprice")))


def lag_long_query(spark, sf_dir):
    return lag_long(_lines(spark, sf_dir), ["l_quantity"], [1, 12, 500], ORDER, rows=ROWS)


def rolling_long_query(spark, sf_dir):
    made = rolling_long(_lines(spark, sf_dir), ["l_extendedprice"], [3, 60], ORDER, rows=ROWS)
    return rounded(made, **{f"l_extendedprice_roll_{s}_{n}": 4 for s in ("mean", "std") for n in (3, 60)})


def rolling_long_keys(spark, sf_dir):
    """The same by return flag: three series, none of which fits a bucket."""
    lines = table(spark, sf_dir, "lineitem").select(*ORDER, "l_returnflag")
    made = features_long(lines, {"l_quantity": [4]}, {"l_quantity": [7]}, ORDER, ["l_returnflag"], rows=ROWS)
    return rounded(made, l_quantity_roll_mean_4=6, l_quantity_roll_std_4=6)


def interpolate_long_query(spark, sf_dir):
    return rounded(interpolate_long(_gaps(spark, sf_dir), ["price"], ORDER, rows=ROWS), price=8)


def fill_forward_long_query(spark, sf_dir):
    return fill_forward_long(_gaps(spark, sf_dir), ["price"], ORDER, rows=ROWS)


def holdout_long_query(spark, sf_dir):
    return holdout_long(_lines(spark, sf_dir), 1200, ORDER)


_COLUMNS = ", ".join(ORDER)
_GAPS = f"gaps AS (SELECT {_COLUMNS}, CASE WHEN l_quantity >= 30 AND year(l_shipdate) > 1995 THEN l_extendedprice END AS price FROM lineitem)"
_FULL = "CASE WHEN count({c}) OVER w{n} = {n} THEN round({f}({c}) OVER w{n}, {d}) END AS {c}_roll_{s}_{n}"


def _rolling_sql(column, sizes, digits):
    return ",\n       ".join(
        _FULL.format(c=column, n=n, f=f, s=s, d=digits) for n in sizes for s, f in (("mean", "avg"), ("std", "stddev_samp"))
    )


SQL = {
    "lag_long": f"""SELECT {_COLUMNS}, {', '.join(f'lag(l_quantity, {k}) OVER w AS l_quantity_lag_{k}' for k in (1, 12, 500))}
FROM lineitem WINDOW w AS (ORDER BY {_COLUMNS})""",
    "rolling_long": f"""SELECT {_COLUMNS}, {_rolling_sql('l_extendedprice', (3, 60), 4)}
FROM lineitem WINDOW {', '.join(f'w{n} AS (ORDER BY {_COLUMNS} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)' for n in (3, 60))}""",
    "rolling_long_keys": f"""SELECT {_COLUMNS}, l_returnflag, {_rolling_sql('l_quantity', (4,), 6)},
       lag(l_quantity, 7) OVER (PARTITION BY l_returnflag ORDER BY {_COLUMNS}) AS l_quantity_lag_7
FROM lineitem WINDOW w4 AS (PARTITION BY l_returnflag ORDER BY {_COLUMNS} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""",
    "interpolate_long": f"""WITH {_GAPS},
placed AS (SELECT *, row_number() OVER (ORDER BY {_COLUMNS}) AS rn FROM gaps),
ends AS (
  SELECT *, max(CASE WHEN price IS NOT NULL THEN rn END) OVER (ORDER BY rn) AS a,
         min(CASE WHEN price IS NOT NULL THEN rn END) OVER (ORDER BY rn DESC) AS b FROM placed)
SELECT {', '.join(f'e.{c}' for c in ORDER)}, round(coalesce(e.price, l.price + (e.rn - a) * (r.price - l.price) / (b - a)), 8) AS price
FROM ends e LEFT JOIN placed l ON l.rn = a LEFT JOIN placed r ON r.rn = b""",
    "fill_forward_long": f"""WITH {_GAPS}
SELECT {_COLUMNS}, last_value(price IGNORE NULLS) OVER (ORDER BY {_COLUMNS} ROWS UNBOUNDED PRECEDING) AS price FROM gaps""",
    "holdout_long": f"""WITH placed AS (SELECT {_COLUMNS}, row_number() OVER (ORDER BY {_COLUMNS}) AS rn, count(*) OVER () - 1200 AS train FROM lineitem)
SELECT {_COLUMNS}, CASE WHEN rn > train THEN 'test' ELSE 'train' END AS part, CAST(rn - train AS INT) AS step, CAST(train AS INT) AS train_rows FROM placed""",
}

QUERIES = {name: (query, SQL[name]) for name, query in {
    "lag_long": lag_long_query, "rolling_long": rolling_long_query, "rolling_long_keys": rolling_long_keys,
    "interpolate_long": interpolate_long_query, "fill_forward_long": fill_forward_long_query, "holdout_long": holdout_long_query,
}.items()}
