"""Committed sinks, bucketed panels, scans with rejects."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from monthpanel.operators.features import add_lags, add_rolling
from monthpanel.operators.panel import merge_monthly
from monthpanel.sources.store import read_committed, read_panel, scan_with_rejects, write_committed, write_panel

SCHEMA = "model string, x long"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing was committed"):
        read_committed(spark, path, SCHEMA)
    first = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    assert write_committed(first, path) == 1
    broken = first.repartition(2, "x").withColumn("x", F.when(F.col("x") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("x") + 10).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_committed(broken, path)
    assert rows_of(read_committed(spark, path, SCHEMA)) == [("a", 1), ("b", 2)]
    # A writer that died after its data and before the manifest.
    first.withColumn("x", F.lit(99).cast("long")).write.parquet(f"{path}/data-2-dead")
    assert rows_of(read_committed(spark, path, SCHEMA)) == [("a", 1), ("b", 2)]
    assert write_committed(first.where("x = 1"), path) == 2
    assert rows_of(read_committed(spark, path, SCHEMA)) == [("a", 1)]


def test_one_model_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    write_committed(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], SCHEMA), path, "model")
    write_committed(spark.createDataFrame([("b", 20), ("b", 21), ("c", 5)], SCHEMA), path, "model")
    assert rows_of(read_committed(spark, path, SCHEMA, "model")) == [("a", 1), ("b", 20), ("b", 21), ("c", 5), (None, 3)]
    write_committed(spark.createDataFrame([(None, 30)], SCHEMA), path, "model")
    assert rows_of(read_committed(spark, path, SCHEMA, "model")) == [("a", 1), ("b", 20), ("b", 21), ("c", 5), (None, 30)]


def test_two_writers_of_one_version_are_noticed(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1)], SCHEMA)
    write_committed(df, path)
    spark.createDataFrame([(1, "other", None, "data-1-other")], "version long, writer string, part string, folder string").write.mode("append").parquet(f"{path}/manifests")
    with pytest.raises(ValueError, match="two writers"):
        read_committed(spark, path, SCHEMA)


def test_bucketed_panels_need_no_exchange(spark, tmp_path):
    months = [datetime.date(2020 + m // 12, m % 12 + 1, 1) for m in range(30)]
    sources = {}
    for name in ("u", "v"):
        rows = [(k, d, float((k * 31 + i * (7 if name == "u" else 11)) % 100)) for k in range(20) for i, d in enumerate(months) if (i + k) % (7 if name == "u" else 5)]
        sources[name] = spark.createDataFrame(rows, f"k long, date date, {name} double")
    table = f"panel_{uuid.uuid4().hex}"
    write_panel(sources, table, str(tmp_path / "panel"), ["k"], 4)
    made = add_rolling(add_lags(read_panel(spark, table, ["k"]), ["u", "v"], [1, 12], ["k"]), ["u"], [3], ["k"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan
    want = add_rolling(add_lags(merge_monthly(list(sources.values()), ["k"]), ["u", "v"], [1, 12], ["k"]), ["u"], [3], ["k"])
    assert rows_of(made) == rows_of(want) and made.count() > 500
    one = read_panel(spark, table, ["k"], ["v"])
    assert one.count() == sources["v"].count() and "PartitionFilters: [isnotnull(source" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="need keys"):
        write_panel(sources, table, "y", [], 4)
    with pytest.raises(ValueError, match="must not share"):
        write_panel({"a": sources["u"], "b": sources["u"]}, table, "y", ["k"], 4)
    write_panel({"u": sources["u"].union(sources["u"].limit(1))}, table, str(tmp_path / "twice"), ["k"], 4)
    with pytest.raises(Exception, match="repeats a month"):
        read_panel(spark, table, ["k"]).collect()


def test_rejects_have_file_row_column_and_reason(spark, tmp_path):
    bad = {5: ("Enero", "n/d", "x"), 700: ("", "1,5", "ok"), 1200: ("2020-13", "", "ok"), 1500: ("sin", "-", "ok")}
    lines = [",".join(f'"{v}"' for v in bad.get(i, ("2020-01-01", "1.234,5", f"t{i}"))) for i in range(1, 2001)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("d,n,t\n" + "\n".join(lines) + "\n")
    (tmp_path / "in" / "b.csv").write_text('d,n,t\n2021-02-03,7,\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows, rejects = scan_with_rejects(spark, str(tmp_path / "in"), {"d": "date", "n": "number", "t": "text"}, ["d", "t"], folder=str(tmp_path / "scan"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = sorted((r["file"].rsplit("/", 1)[-1], r["row"], r["column"], r["text"], r["reason"]) for r in rejects.withColumn("text", F.coalesce("text", F.lit("-"))).collect())
    assert got == [
        ("a.csv", 5, "d", "Enero", "not a date"), ("a.csv", 5, "n", "n/d", "not a number"), ("a.csv", 700, "d", "-", "missing"),
        ("a.csv", 1200, "d", "2020-13", "not a date"), ("a.csv", 1500, "d", "sin", "not a date"), ("a.csv", 1500, "n", "-", "not a number"), ("b.csv", 1, "t", "-", "missing"),
    ]
    assert rows.count() == 1999 and rows.where("n = 1234.5").count() == 1996
    assert rows.where("d is null").count() == 3
    with pytest.raises(ValueError, match="no kind"):
        scan_with_rejects(spark, str(tmp_path / "in"), {"d": "day"})
