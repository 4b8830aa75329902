"""Windows over series longer than a bucket, exact quantiles bit by bit, lag correlations batch by batch."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from monthpanel.operators.baselines import mark_holdout
from monthpanel.operators.diagnose import lag_correlations
from monthpanel.operators.features import add_lags, add_rolling, interpolate_inside
from monthpanel.operators.long_series import fill_forward_long, holdout_long, interpolate_long, lag_long, positions, rolling_long
from monthpanel.operators.quantiles import exact_quantiles, image_of, value_of


def same(a, b):
    assert a.columns == b.columns

    def rounded(rows):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)

    assert rounded(a.collect()) == rounded(b.collect())


@pytest.fixture()
def data(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "b", "b", "b"]), i, round(rng.random(), 3) if rng.random() < 0.3 and not 100 < i < 180 else None) for i in range(300)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, date int, x double").repartition(6)


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("rows", [7, 1000])
def test_long_windows_equal_plain_ones(data, keys, rows):
    full = data.withColumn("x", F.coalesce("x", F.lit(0.5)))
    same(lag_long(data, ["x", "date"], [1, 5, 20], ["date"], keys, rows), add_lags(data, ["x", "date"], [1, 5, 20], keys))
    same(rolling_long(full, ["x"], [2, 9], ["date"], keys, rows), add_rolling(full, ["x"], [2, 9], keys))
    same(rolling_long(data, ["x"], [2], ["date"], keys, rows), add_rolling(data, ["x"], [2], keys))
    same(interpolate_long(data, ["x"], ["date"], keys, rows), interpolate_inside(data, ["x"], keys))
    last = F.last("x", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("date"))
    same(fill_forward_long(data, ["x"], ["date"], keys, rows), data.withColumn("x", last))
    same(holdout_long(data, 40, ["date"], keys), mark_holdout(data, 40, keys))


def test_no_long_series_meets_in_one_task(data):
    """Single-partition exchanges are of tables with a row for each file or bucket."""
    for made in (lag_long(data, ["x"], [3], ["date"], rows=20), interpolate_long(data, ["x"], ["date"], rows=20)):
        lines = made._jdf.queryExecution().executedPlan().toString().splitlines()
        for i in (i for i, line in enumerate(lines) if "SinglePartition" in line):
            below = next(line for line in lines[i + 1 :] if re.search("Aggregate|FileScan", line))
            assert "Aggregate" in below


def test_carried_windows_grow_by_a_row(spark, data):
    """No window is counted anew for each row up to its last one, and rows meet the table of files without an exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [made._jdf.queryExecution().executedPlan().toString() for made in (
            interpolate_long(data, ["x"], ["date"], rows=20), fill_forward_long(data, ["x"], ["date"], ["k"], rows=20))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert "unboundedfollowing" not in plan
        assert "BroadcastHashJoin [__run" in plan and "SortMergeJoin [__run" not in plan


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("rows", [70, 1000])
def test_wide_windows_equal_plain_ones(spark, keys, rows):
    """Windows of one, two and three sizes of blocks, with gaps, infinities, NaN, equal and large values, whole numbers and decimals."""
    rng = random.Random(5)
    odd = {150: None, 400: math.inf, 520: -math.inf, 690: math.nan, 860: -0.0}
    values = [odd.get(i, 0.1 if i < 90 or 760 < i < 900 else 1e9 + rng.random() if i < 300 else rng.uniform(-9, 9)) for i in range(1000)]
    rows_made = [("a" if i < 620 else None, i, v, rng.randrange(-50, 50) if i % 311 else None) for i, v in enumerate(values)]
    rng.shuffle(rows_made)
    df = spark.createDataFrame(rows_made, "k string, date int, x double, n long").withColumn("d", F.col("n").cast("decimal(9,2)")).repartition(5)
    sizes, by = [2, 3, 7, 8, 9, 60, 64, 65, 130], ["k", "date"]
    made = rolling_long(df, ["x", "n", "d"], sizes, ["date"], keys, rows)
    plain = add_rolling(df, ["x", "n", "d"], sizes, keys)
    assert made.schema == plain.schema
    if not keys:
        made, plain = made.orderBy("date"), plain.orderBy("date")
    got, want = (sorted(f.collect(), key=lambda r: r["date"]) for f in (made, plain))
    assert len(got) == len(want) == 1000 and [r[c] for r in got for c in by] == [r[c] for r in want for c in by]
    for a, b in zip(got, want):
        for c in made.columns:
            if isinstance(a[c], float) and isinstance(b[c], float):
                assert a[c] == b[c] or math.isnan(a[c]) and math.isnan(b[c]) or math.isclose(a[c], b[c], rel_tol=1e-9, abs_tol=1e-6), (c, a, b)
            else:
                assert a[c] == b[c], (c, a, b)
    flat = [r for r in got if r["date"] in range(70, 91) or r["date"] in range(830, 850)]
    assert len(flat) == 41 and all(r["x_roll_std_60"] == 0 for r in flat if keys or r["date"] < 90 or r["date"] > 820)


def test_no_window_is_added_up_for_each_row(data):
    """A row costs lags for each size of blocks, not the rows of its window."""
    plan = rolling_long(data, ["x"], [3, 500], ["date"], ["k"], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "avg(" not in plan and "stddev_samp(" not in plan
    assert 0 < len(set(re.findall(r"lag\((\w+)#\d+, (-\d+)", plan))) < 100


def test_positions_of_empty_and_one(spark):
    empty = spark.createDataFrame([], "date int, x double")
    assert positions(empty, ["date"]).count() == 0 and lag_long(empty, ["x"], [1], ["date"]).count() == 0
    assert [r["__at"] for r in positions(spark.createDataFrame([(1, 2.0)], "date int, x double"), ["date"]).collect()] == [0]


EXTREMES = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.2250738585072009e-308, 1.7976931348623157e308, -1.7976931348623157e308,
            math.inf, -math.inf, math.nan, 0.1, 1 / 3, 2.0**52, 2.0**53 + 2, 1e-300, 1e300, math.nextafter(1, 2), math.nextafter(1, 0), math.nextafter(8, 0), 8.0]


def test_images_order_as_doubles(spark):
    rng = random.Random(2)
    values = EXTREMES + [rng.uniform(-1, 1) * 2.0 ** rng.randrange(-1070, 1020) for _ in range(3000)] + [2.0**e for e in range(-1074, 1024)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", image_of(F.col("v")).alias("i")).withColumn("back", value_of(F.col("i"))).collect()
    for r in rows:
        assert r.back == r.v or math.isnan(r.v) and math.isnan(r.back), r
    ordered = sorted((r for r in rows if not math.isnan(r.v)), key=lambda r: r.v)
    assert all((a.i < b.i) == (a.v < b.v) and (a.i == b.i) == (a.v == b.v) for a, b in zip(ordered, ordered[1:]))
    assert all(r.i > ordered[-1].i for r in rows if math.isnan(r.v))


def test_quantiles_of_one_large_group(spark):
    """Half of the rows are one value; the others spread over many sizes, in a group with a null key too."""
    values = [3.25] * 2000 + [(-1) ** i * 1.5 ** (i % 90) + i / 7 for i in range(2000)]
    df = spark.createDataFrame([(k, v) for k in ("a", None) for v in values], "k string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for r in exact_quantiles(df, "v", probs, ["k"]).collect():
        assert r["n"] == 4000 and np.allclose(r["quantiles"], np.quantile(values, probs), rtol=1e-12)
    assert exact_quantiles(df.limit(0), "v", probs, ["k"]).collect() == []


def brute_lags(rows, keys, lags, least):
    out = {}
    for k in {r[0] for r in rows} if keys else {None}:
        own = sorted((r for r in rows if not keys or r[0] == k), key=lambda r: r[1])
        for name, j in (("t", 2), ("u", 3)):
            for lag in range(1, lags + 1):
                pairs = [(own[i][2], own[i - lag][j]) for i in range(lag, len(own)) if own[i][2] is not None and own[i - lag][j] is not None]
                if len(pairs) >= least:
                    y, x = np.array(pairs).T
                    if x.std() > 1e-9 and y.std() > 1e-9:
                        out[k if keys else None, name, lag] = (round(float(np.corrcoef(x, y)[0, 1]), 9), len(pairs))
    return out


@pytest.mark.parametrize("keys, size", [(["k"], 7), (["k"], 10_000), ([], 5)])
def test_lag_correlations_over_batches(spark, keys, size):
    """Batches far shorter than a series, series shorter than a lag, constants and gaps."""
    rng = random.Random(4)
    rows = [(k, d, 1e7 + rng.random() if rng.random() > 0.2 else None, {"a": 5.1, "b": rng.random()}.get(k, float(d))) for k, n in (("a", 40), ("b", 90), ("c", 3), (None, 25)) for d in range(n)]
    if not keys:
        rows = [r for r in rows if r[0] == "b"]
    df = spark.createDataFrame(rows, "k string, date int, t double, u double").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
    try:
        made = lag_correlations(df, "t", 30, 5, keys, ["t", "u"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(r["k"] if keys else None, r["feature"], r["lag"]): (round(r["correlation"], 9), r["observations"]) for r in made}
    assert got == brute_lags(rows, keys, 30, 5)


def test_lag_correlations_repeat_no_rows(spark):
    df = spark.range(50).select(F.col("id").cast("int").alias("date"), F.rand(1).alias("t"), F.rand(2).alias("u"))
    plan = lag_correlations(df, "t", 120, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan and "Window" not in plan
