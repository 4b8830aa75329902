import datetime

import pytest
from pyspark.sql import functions as F

from monthpanel.operators.clean import (
    drop_empty, first_existing_column, first_matching_column, generic_monthly, keep_rows_with_target,
    numeric_series_columns, proxy_candidates, slug_columns, standardize_monthly, sum_by_month, trade_by_product,
)
from monthpanel.operators.panel import (
    check_coverage, first_per_month, merge_monthly, missing_and_extra_months, missing_months, month_bounds, month_mean,
    month_spine, panel_report, panel_violations, strict_panel, strict_series, to_long, to_wide, validate_panel,
)


def day(text):
    return datetime.date.fromisoformat(text + "-01")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or ["date"])).collect()]


def test_merge_outer(spark, monthly):
    left, right = monthly("2024-01", a=[1, 2]), monthly("2024-02", b=[3, 4])
    want = [(day("2024-01"), 1.0, None), (day("2024-02"), 2.0, 3.0), (day("2024-03"), None, 4.0)]
    assert rows(merge_monthly([left, None, right])) == want
    assert rows(merge_monthly([left, right], unique_months=False)) == want
    twice = left.unionByName(left)
    assert merge_monthly([twice, right], unique_months=False).count() == 5
    with pytest.raises(Exception, match="repeats a month"):
        merge_monthly([twice, right]).collect()
    empty = monthly("2024-01", c=[1]).where("false")
    assert "c" not in merge_monthly([left, empty], skip_empty=True).columns
    with pytest.raises(ValueError, match="nothing to merge"):
        merge_monthly([None])
    with pytest.raises(ValueError, match="has no column"):
        merge_monthly([left.drop("date")])
    with pytest.raises(ValueError, match="Several frames"):
        merge_monthly([left, left], on_collision="error")
    more = monthly("2024-01", a=[None, 9])
    assert merge_monthly([left, more, left]).columns == ["date", "a_x", "a_y", "a"]
    assert rows(merge_monthly([more, left], on_collision="coalesce")) == [(day("2024-01"), 1.0), (day("2024-02"), 9.0)]
    assert merge_monthly([left, more], unique_months=False).columns == ["date", "a_x", "a_y"]


def test_rows_without_a_date_are_no_months(spark):
    df = spark.createDataFrame([(None, 5.0), (datetime.date(2019, 3, 1), 1.0)], "date date, x double")
    spine = month_spine(df, "2019-01-01", "2019-06-01")
    assert [r["date"] for r in spine.orderBy("date").collect()] == [day(f"2019-0{m}") for m in range(1, 7)]
    report = panel_report(df, "2019-01-01", "2019-06-01").first()
    assert (report["rows"], report["expected_months"], report["missing_by_column"]) == (6, 6, {"x": 5})
    assert month_mean(df).count() == 1


def test_month_mean_and_sums(spark):
    df = spark.createDataFrame(
        [(datetime.date(2024, 1, 3), "1", "x", None), (datetime.date(2024, 1, 9), "2", "3", None),
         (datetime.date(2024, 2, 1), None, "y", None)], "date date, a string, b string, c double")
    assert rows(month_mean(df)) == [(day("2024-01"), 1.5, 3.0, None), (day("2024-02"), None, None, None)]
    sums = sum_by_month(month_mean(df), ["a", "c"])
    assert rows(sums) == [(day("2024-01"), 1.5, None), (day("2024-02"), None, None)]
    with pytest.raises(ValueError):
        month_mean(df.select("a"))


def test_first_per_month_follows_row_order(spark):
    df = spark.createDataFrame([(3, 30.0, None), (1, None, 1.0), (2, 20.0, 2.0)], "row int, a double, b double")
    dated = df.withColumn("date", F.lit("2024-01-01").cast("date"))
    assert rows(first_per_month(dated, ["a", "b"], "row")) == [(day("2024-01"), 20.0, 1.0)]


def test_spine(spark, monthly):
    df = monthly("2019-01", x=[1, 2, 3, 4]).where("x <> 2")
    assert rows(month_spine(df)) == [
        (day("2019-01"), 1.0), (day("2019-02"), None), (day("2019-03"), 3.0), (day("2019-04"), 4.0)]
    assert rows(month_spine(df, "2018-12-01", "2019-03-15")) == [
        (day("2018-12"), None), (day("2019-01"), 1.0), (day("2019-02"), None), (day("2019-03"), 3.0)]
    assert rows(month_spine(df, "2020-01-01", "2020-02-01")) == [(day("2020-01"), None), (day("2020-02"), None)]
    assert rows(month_spine(df, "2018-01-01", "2018-01-01")) == [(day("2018-01"), None)]
    assert rows(month_spine(df, "2019-02-01", "2019-02-01")) == [(day("2019-02"), None)]
    keyed = df.withColumn("k", F.lit("a")).unionByName(monthly("2019-04", x=[9]).withColumn("k", F.lit("b")))
    assert month_spine(keyed, keys=["k"]).groupBy("k").count().where("count <> 4").isEmpty()
    with pytest.raises(ValueError, match="before the start"):
        month_spine(df, "2020-02-01", "2020-01-01")
    with pytest.raises(Exception, match="a month repeats"):
        month_spine(df.unionByName(df)).collect()
    assert month_bounds("2019-01-01", "2019-03-31") == 3


def test_strict_panel_drops_sparse(spark, monthly):
    df = monthly("2019-01", complete=[1, 2, 3, 4], sparse=[1, None, 3, 4], label=["a", "b", "c", "d"])
    panel, report = strict_panel(df, "2019-01-01", "2019-04-01")
    assert panel.columns == ["date", "complete"] and panel.count() == 4
    facts = report.first()
    assert facts["is_complete"] and facts["dropped_columns"] == ["sparse", "label"]
    assert facts["selected_columns"] == ["complete"] and facts["expected_months"] == 4 == facts["rows"]
    assert facts["missing_by_column"] == {"complete": 0, "sparse": 1, "label": 4}
    validate_panel(panel, "2019-01-01", "2019-04-01")


def test_strict_panel_errors(spark, monthly):
    df = monthly("2019-01", target=[1, 2, None, 4], other=[1, 2, 3, 4])
    with pytest.raises(ValueError, match="Required columns are not complete"):
        strict_panel(df, "2019-01-01", required=["target"])
    with pytest.raises(ValueError, match="lacks the required"):
        strict_panel(df, "2019-01-01", required=["absent"])
    with pytest.raises(ValueError, match="lacks the requested"):
        strict_panel(df, "2019-01-01", columns=["absent"])
    with pytest.raises(ValueError, match="have gaps"):
        strict_panel(df, "2019-01-01", drop_incomplete=False)
    with pytest.raises(ValueError, match="every column has gaps"):
        strict_panel(df, "2019-01-01", columns=["target"])
    with pytest.raises(ValueError, match="before the start"):
        strict_panel(df, "2019-05-01")
    panel, _ = strict_panel(df, "2019-01-01", columns=["target"], required=["other"])
    assert panel.columns == ["date", "other"]
    assert not panel_report(df, "2019-01-01", drop_incomplete=False).first()["is_complete"]


def test_violations(spark, monthly):
    gap = monthly("2019-01", x=[1, 2, 3]).where("x <> 2")
    with pytest.raises(ValueError, match="expected"):
        validate_panel(gap, "2019-01-01", "2019-03-01")
    with pytest.raises(ValueError, match="expected"):
        validate_panel(gap.where("false"), "2019-01-01", "2019-03-01")
    messy = gap.unionByName(monthly("2019-03", x=[None, 5]))
    found = set(panel_violations(messy, "2019-01-01", "2019-03-01").collect())
    assert {(r["kind"], r["date"], r["column"]) for r in found} == {
        ("missing", day("2019-02"), None), ("extra", day("2019-04"), None), ("duplicate", day("2019-03"), None),
        ("null", day("2019-03"), "x")}
    middle = spark.createDataFrame([(datetime.date(2019, 1, 5),)], "date date")
    kinds = {(r["kind"], r["date"]) for r in missing_and_extra_months(middle, "2019-01-01", "2019-01-01").collect()}
    assert kinds == {("missing", day("2019-01")), ("extra", datetime.date(2019, 1, 5))}


def test_coverage(spark, monthly):
    df = monthly("2019-01", x=[1, None, 3])
    assert rows(missing_months(df, "x", "2018-12-01")) == [(day("2018-12"),), (day("2019-02"),)]
    check_coverage(df, "x", "2019-03-01")
    with pytest.raises(ValueError, match="2019-02-01"):
        check_coverage(df, "x", "2019-01-01")
    with pytest.raises(ValueError, match="is no column"):
        check_coverage(df, "y", "2019-01-01")


def test_long_forms(spark, monthly):
    df = monthly("2019-01", a=[1, 2], b=[3, None])
    long = to_long(df, ["a", "b"])
    assert long.count() == 3
    assert rows(to_wide(long.unionByName(long), ["a", "b"])) == [(day("2019-01"), 1.0, 3.0), (day("2019-02"), 2.0, None)]
    assert {r["series"] for r in strict_series(long, "2019-01-01", "2019-02-01").collect()} == {"a"}


def test_columns(spark, monthly):
    df = monthly("2019-01", a=[1, 2], b=[3, None], c=[None, None])
    assert drop_empty(df, ["date"]).columns == ["date", "a", "b"]
    assert numeric_series_columns(df) == ["a"] and numeric_series_columns(df, 1) == ["a", "b"]
    assert first_matching_column(["Mes", "Año"], [r"^ano$"]) == "Año"
    assert first_existing_column(["Mes", "MES "], ["month", "mes"]) == "MES "
    assert proxy_candidates(["date", "x", "cement_a", "my_area"]) == ["cement_a", "my_area"]
    with pytest.raises(ValueError, match="share a name"):
        slug_columns(df.toDF("Año", "ano", "x", "y"))
    kept = monthly("2023-01", t=[None, 1, 2])
    assert [r[0] for r in rows(keep_rows_with_target(kept, "t"))] == [day("2023-02"), day("2023-03")]
    with pytest.raises(ValueError, match="is missing"):
        keep_rows_with_target(kept, "u")


def test_generic_and_standard_tables(spark):
    df = spark.createDataFrame(
        [("2024", "enero", "1,5", "a", None), ("2024", "enero", "2", "b", None), ("2024", "feb", None, "c", None),
         (None, None, None, None, None)], "`Año` string, Mes string, `Valor Q` string, Nota string, Vacio string")
    assert rows(generic_monthly(df, "t")) == [(day("2024-01"), 3.5), (day("2024-02"), None)]
    assert generic_monthly(df, "t").columns == ["date", "t_valor_q"]
    assert trade_by_product(df).columns == ["date", "trade_valor_q"]
    with pytest.raises(ValueError, match="No numeric value"):
        generic_monthly(df, "t", exclude=["valor"])
    with pytest.raises(ValueError):
        generic_monthly(df.drop("Mes"), "t")
    made = standardize_monthly(df, {"Valor Q": "Out 1", "nada": "y"}, year_col="Año", month_col="Mes")
    assert made.columns == ["date", "out_1"] and rows(made) == [(day("2024-01"), 3.5), (day("2024-02"), None)]
