import datetime

import pytest
from pyspark.sql import functions as F

from monthpanel.functions.months import month_from_parts, month_number, month_of_number, strict_month
from monthpanel.functions.numbers import parse_number, year_in_text, year_of_number
from monthpanel.functions.text import slug, slug_name, slug_soft
from monthpanel.operators.clean import MonthParseError, with_month


def mapped(spark, values, column, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    made = rows.select("i", column(F.col("v")).alias("out")).orderBy("i")
    return [r["out"] for r in made.collect()]


SLUGS = {
    "Costo aprox. quetzales": "costo_aprox_quetzales", "Año": "ano", " Área Con M2 ": "area_con_m2",
    "": "unnamed", "---": "unnamed", "ÑANDÚ – 3º": "nandu_3o", "Straße": "strae", "x²": "x2", "ﬁn ½": "fin_12",
    "Ⅳ trim…": "iv_trim", "Ａ１": "a1", "日本": "unnamed", "été": "ete", "Total™": "total", "㎏/m": "kg_m",
}
SOFT = {
    "Período": "periodo", "Construcción ": "construccion", "Straße": "stra_e", "IMAE": "imae", "x–y": "x_y",
    "été": "ete", "½": "1_2", "ﬁn": "fin", "日本": "", "": "",
}


def test_slugs(spark):
    assert mapped(spark, list(SLUGS), slug) == list(SLUGS.values())
    assert [slug_name(k) for k in SLUGS] == list(SLUGS.values())
    assert mapped(spark, [None, *SOFT], slug_soft) == ["", *SOFT.values()]


NUMBERS = {
    "1.234,50": 1234.5, "Q 2,000.25": 2000.25, "-": None, "3,500": 3500.0, "1e5": 15.0, "(123)": 123.0, "5-": None,
    "1,234,56": None, "1.234": 1.234, "1.234.567": None, "": None, "nan": None, "None": None, "1,234,567": 1234567.0,
    "12,5": 12.5, "12,50": 12.5, "1,234.56": 1234.56, "1.234.567,8": 1234567.8, "-3,5": -3.5, "abc": None, ".5": 0.5,
    "1.234,567,8": None, "12,": 12.0, " 7 ": 7.0, "USD 1,000": 1000.0, "1.5,25.7": None,
}


def test_number_grammar(spark):
    assert mapped(spark, list(NUMBERS), parse_number) == list(NUMBERS.values())
    assert mapped(spark, [None], parse_number) == [None]


MONTHS = {
    "enero": 1, "Septiembre": 9, "dic": 12, "4": 4, "not a month": None, "13": None, "1.0": None, "Mar-20": 3,
    "enero 2020": 1, " SETIEMBRE ": 9, "012": 12, "0": None, "": None, "Total": None, "mayo/2020": 5, "12": 12,
    "sept": 9, "Février": None,
}


def test_month_labels(spark):
    assert mapped(spark, list(MONTHS), month_number) == list(MONTHS.values())
    assert mapped(spark, [4.0, 4.5, 13.0, None], month_of_number, "double") == [4, None, None, None]


def test_years(spark):
    assert mapped(spark, ["Indices 2019", "x", "2150", "dic 1998 y 1999", None], year_in_text) == [2019, None, None, 1998, None]
    assert mapped(spark, [2019.0, 2019.9, 1899.0, 2101.0, None], year_of_number, "double") == [2019, 2019, None, None, None]


def test_month_from_parts(spark):
    rows = spark.createDataFrame([(2024, 2), (2024, 13), (None, 1), (2024, None)], "y int, m int")
    made = [r[0] for r in rows.select(month_from_parts(F.col("y"), F.col("m"))).collect()]
    assert made == [datetime.date(2024, 2, 1), None, None, None]


def test_strict_month(spark):
    day = datetime.date
    texts = {
        "2024-2": day(2024, 2, 1), "2024/02/29": day(2024, 2, 1), "2023-02-29": None, "13/02/2024": day(2024, 2, 1),
        "01/02/2024": day(2024, 1, 1), "31-12-2024": day(2024, 12, 1), "202402": None, "120.5": None, "1985-01-01": None,
        "2036-01": None, " 2024-03-05 ": day(2024, 3, 1), "": None, "2024-13-01": None, "32/13/2024": None,
    }
    assert mapped(spark, list(texts), strict_month) == list(texts.values())
    rows = spark.createDataFrame(
        [(None, datetime.datetime(2024, 5, 6), 45000.0), (None, None, 45000.0), (None, None, 120.5)],
        "text string, ts timestamp, num double",
    )
    cells = (F.col("text"), F.col("ts"), F.col("num"))
    assert [r[0] for r in rows.select(strict_month(*cells)).collect()] == [day(2024, 5, 1), None, None]
    serial = rows.select(strict_month(*cells, excel_serial=True))
    assert [r[0] for r in serial.collect()] == [day(2024, 5, 1), day(2023, 3, 1), None]


def test_with_month(spark):
    df = spark.createDataFrame([("2024", "enero", "x"), ("2024", "febrero", None)], "ano string, mes string, fecha string")
    want = [datetime.date(2024, 1, 1), datetime.date(2024, 2, 1)]
    assert [r["date"] for r in with_month(df, "ano", "mes").collect()] == want
    assert [r["date"] for r in with_month(df, "ano", "mes", "fecha").collect()] == want
    dated = df.withColumn("fecha", F.when(F.col("mes") == "enero", "2020-05-17"))
    assert [r["date"] for r in with_month(dated, "ano", "mes", "fecha").collect()] == [datetime.date(2020, 5, 1), None]
    with pytest.raises(MonthParseError):
        with_month(df, date_col="absent")
    bad = spark.createDataFrame([("2024", "foo"), ("2024", "marzo")], "ano string, mes string")
    with pytest.raises(Exception, match="no month: "):
        with_month(bad, "ano", "mes").collect()
    assert [r["date"] for r in with_month(bad, "ano", "mes", on_error="null").collect()] == [None, datetime.date(2024, 3, 1)]
    numeric = spark.createDataFrame([(2024, 3)], "ano int, mes int")
    assert with_month(numeric, "ano", "mes").first()["date"] == datetime.date(2024, 3, 1)


def test_with_month_asks_per_key(spark):
    rows = spark.createDataFrame(
        [("a", "2024", "enero", "2020-03-01"), ("a", "2024", "mayo", "s/d"), ("b", "2024", "mayo", "s/d")],
        "k string, ano string, mes string, fecha string",
    )
    made = {(r["k"], r["mes"]): r["date"] for r in with_month(rows, "ano", "mes", "fecha", keys=["k"]).collect()}
    assert made == {("a", "enero"): datetime.date(2020, 3, 1), ("a", "mayo"): None, ("b", "mayo"): datetime.date(2024, 5, 1)}
