import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("monthpanel-tests")
        .config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def monthly(spark):
    """Monthly frames from plain lists: ``monthly(start, name=[...], ...)``."""
    import datetime

    def make(start, **columns):
        y, m = (int(p) for p in start.split("-")[:2])
        n = len(next(iter(columns.values())))
        rows = [
            (datetime.date(y + (m - 1 + i) // 12, (m - 1 + i) % 12 + 1, 1), *[v[i] for v in columns.values()])
            for i in range(n)
        ]
        types = ", ".join(
            f"{c} {'string' if any(isinstance(x, str) for x in v) else 'double'}" for c, v in columns.items()
        )
        floats = [
            (d, *[float(x) if isinstance(x, (int, float)) else x for x in values]) for d, *values in rows
        ]
        return spark.createDataFrame(floats, f"date date, {types}")

    return make
