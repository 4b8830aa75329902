"""Work that must not grow faster than the tables: what is read once, written once, spread over tasks."""

import datetime

import pytest

from monthpanel.operators import long_series
from monthpanel.operators.quantiles import exact_quantiles
from monthpanel.plans import queries_choice, queries_long, queries_quality, queries_reshape


def plan_of(made):
    return made._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Line items of 40 suppliers over four months, each with all return flags."""
    folder = tmp_path_factory.mktemp("tables")
    rows = [
        (i, i % 7, s, 1 + i % 3, float(10 + i % 40), 100.5 + i, 0.05, flag, datetime.datetime(1996, month, 1 + s % 20))
        for i, (s, flag, month) in enumerate((s, flag, m) for s in range(40) for flag in "ANR" for m in (1, 2, 3, 4))
    ]
    schema = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
              "l_returnflag string, l_shipdate timestamp_ntz")
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_quantiles_work_values_out_once(spark):
    df = spark.createDataFrame([(k, float(v)) for k in "ab" for v in range(50)], "k string, v double")
    made = exact_quantiles(df, "v", [0.5], ["k"])
    assert "LOG2" not in plan_of(made).upper() and "SortMergeJoin" not in plan_of(made)
    assert sorted((r["k"], r["quantiles"]) for r in made.collect()) == [("a", [24.5]), ("b", [24.5])]


@pytest.mark.parametrize("query", [queries_reshape.block_discovery, queries_choice.dataset_build])
def test_workbooks_are_made_once(spark, tables, query):
    """Parsers read cell tables several times, not the line items behind them."""
    made = query(spark, tables)
    assert "l_suppkey" not in plan_of(made)
    assert made.count() > 0


def test_files_are_written_by_many_tasks(spark, tables, tmp_path, monkeypatch):
    """Small as the files are together, their number is spread over all cores."""
    monkeypatch.setattr(queries_quality, "new_folder", lambda *_: str(tmp_path / "files"))
    assert queries_quality.folder_profile(spark, tables).count() == 40
    files = list((tmp_path / "files").glob("of=*/part-*.txt"))
    assert len(files) == 40 and len({f.name.split("-")[1] for f in files}) > 4


def test_windows_and_lags_share_one_placing(spark, tables, monkeypatch):
    placed = []
    monkeypatch.setattr(long_series, "positions", lambda *a, was=long_series.positions: placed.append(a) or was(*a))
    assert queries_long.rolling_long_keys(spark, tables).count() == 480
    assert len(placed) == 1
