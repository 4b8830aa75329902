"""Targets with keys, dates in many formats, frames stored by the caller."""

import datetime

from pyspark.sql import functions as F

from monthpanel.functions.months import general_date
from monthpanel.operators.targets import available_targets, default_target
from monthpanel.sources.tables import stored_at


def test_default_target_is_no_key(spark):
    df = spark.createDataFrame([(1, datetime.date(2024, 1, 1), 2.0), (2, datetime.date(2024, 2, 1), 3.0)], "k long, date date, z double")
    assert default_target(df, ["k"]) == "z"
    none, some = available_targets(df, ["k"]), available_targets(df.withColumnRenamed("z", "construction_area_m2"), ["k"])
    assert none.count() == 0 and none.dtypes == some.dtypes


def test_general_dates(spark):
    texts = {
        "Jan 2024": (2024, 1, 1), "March 2024": (2024, 3, 1), "2024-02-01 00:00:00": (2024, 2, 1), "202405": (2024, 5, 1), "20240517": (2024, 5, 17),
        "15 Mar 2023": (2023, 3, 15), "Mar 15, 2023": (2023, 3, 15), "2024/6": (2024, 6, 1), "13/2/2024": (2024, 2, 13), "s/d": None, "": None, "Total 2024": None,
        "31/12/23": (2023, 12, 31), "12345": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", general_date(F.col("t")).alias("d"))
    assert {r["t"]: r["d"] for r in df.collect()} == {t: d and datetime.date(*d) for t, d in texts.items()}


def test_frames_are_stored_where_the_caller_says(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x long, y string")
    assert stored_at(df, None) is df
    kept = stored_at(df, str(tmp_path / "frame"))
    assert kept.collect() == df.collect() and kept.inputFiles()
