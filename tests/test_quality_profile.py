import numpy as np
import pytest
from pyspark.sql import functions as F

from monthpanel.operators.quality import (
    column_coverage, correlations_with_target, dataset_shape, describe_series, latest_values, missing_pct, summary_rows,
    value_counts,
)
from monthpanel.operators.quantiles import exact_quantiles
from monthpanel.operators.targets import (
    available_targets, default_target, label_columns, target_label, validate_target,
)
from monthpanel.sources.profile import (
    candidate_listing, leading_lines, profile_folder, profile_sheets, profile_sources, read_text_files, sniff_delimiters,
)
from monthpanel.sources.tables import read_monthly, write_dataset, write_predictions
from test_reshape import grid


@pytest.mark.parametrize("shape", ["ties", "spread", "one"])
def test_exact_quantiles(spark, shape):
    rng = np.random.default_rng(0)
    made = {
        "ties": np.concatenate([np.full(700, 3.0), rng.integers(0, 9, 300).astype(float)]),
        "spread": rng.lognormal(size=1500), "one": np.array([4.0]),
    }[shape]
    df = spark.createDataFrame([("a", float(v)) for v in made] + [("b", 1.0), ("b", None), ("b", 2.0)], "k string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["k"]: r for r in exact_quantiles(df, "v", probs, ["k"]).collect()}
    assert np.allclose(got["a"]["quantiles"], np.quantile(made, probs)) and got["a"]["n"] == len(made)
    assert np.allclose(got["b"]["quantiles"], np.quantile([1.0, 2.0], probs))
    whole = exact_quantiles(df, "v", [0.5]).first()
    assert np.isclose(whole["quantiles"][0], np.median([*made, 1.0, 2.0]))


def test_describe(spark, monthly):
    y = [3.0, 1.0, None, 7.0, 4.0]
    df = monthly("2024-01", y=y)
    for bounded in (True, False):
        r = describe_series(df, "y", monthly=bounded).first()
        assert [r["count"], r["mean"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]] == [4, 3.75, 1, 2.5, 3.5, 4.75, 7]
        assert np.isclose(r["std"], np.std([3, 1, 7, 4], ddof=1))
    assert summary_rows(describe_series(df, "y", monthly=True)).count() == 8


def test_quality_tables(spark, monthly):
    df = monthly("2024-01", y=[1.0, 2.0, 3.0, None], x=[2.0, 4.0, 6.0, 1.0], flat=[1.0] * 4, gap=[None, 1.0, 5.0, 2.0])
    shape = dataset_shape(df).first()
    assert (shape["rows"], shape["columns"], str(shape["first_date"]), str(shape["last_date"])) == (4, 5, "2024-01-01", "2024-04-01")
    assert [tuple(r) for r in missing_pct(df, 2).collect()] == [("gap", 25.0), ("y", 25.0)]
    corr = {r["feature"]: r["correlation_with_target"] for r in correlations_with_target(df, "y").collect()}
    assert np.isclose(corr["x"], 1.0) and np.isclose(corr["gap"], 1.0) and corr["flat"] is None
    assert len(correlations_with_target(df, "y", top=1).collect()) == 1
    cover = {r["column"]: (r["observations"], str(r["first_date"]), str(r["last_date"])) for r in column_coverage(df, ["y", "gap"]).collect()}
    assert cover == {"y": (3, "2024-01-01", "2024-03-01"), "gap": (3, "2024-02-01", "2024-04-01")}
    assert sorted(r["gap"] for r in latest_values(df, "gap", 2).collect()) == [2.0, 5.0]
    assert {(r["flat"], r["rows"]) for r in value_counts(df, "flat").collect()} == {(1.0, 4)}


def test_targets(spark, monthly):
    df = monthly("2024-01", cement_demand_proxy=[1, 2, 3], construction_area_m2=[1, 2, 3], imae_general_index=[1, None, None])
    assert [r["column"] for r in available_targets(df).orderBy("priority").collect()] == ["construction_area_m2", "cement_demand_proxy"]
    assert default_target(df) == "construction_area_m2"
    assert default_target(monthly("2024-01", z=[1, 2])) == "z"
    assert target_label("cement_import_tons") == "Cement import tons" and target_label("my_series") == "My Series"
    labels = {r["column"]: r["label"] for r in label_columns(column_coverage(df, ["construction_area_m2"])).collect()}
    assert labels == {"construction_area_m2": "Construction area"}
    sparse = monthly("2024-01", x=[1.0, None])
    with pytest.raises(ValueError, match="missing"):
        validate_target(sparse, "y")
    with pytest.raises(ValueError, match="only 1"):
        validate_target(sparse, "x")
    with pytest.raises(ValueError, match="no numeric column"):
        default_target(monthly("2024-01", x=["a", "b"]))
    assert available_targets(monthly("2024-01", z=[1, 2])).isEmpty()


def test_sheet_profile(spark):
    cells = {(0, 0): "Informe", (2, 0): "Mes", (2, 1): "Valor", (2, 3): "Valor", (3, 0): "enero", (3, 1): "1,5", (3, 3): 2, (5, 0): "feb", (5, 1): "x", (5, 3): 3}
    book = grid(spark, "f", ("a", cells), ("b", {(0, 0): "only", (1, 0): 1}))
    got = {r["header_row"]: r for r in candidate_listing(profile_sheets(book)).collect()}
    # Above row 2 too few cells are numbers; below it one column is numeric and no name looks like a date.
    assert sorted(got) == [2]
    assert (got[2]["rows"], got[2]["columns"], got[2]["column_names"]) == (2, 3, "mes, valor, valor_1")
    assert (got[2]["date_like_columns"], got[2]["numeric_like_columns"]) == ("mes", "valor, valor_1")


def test_sniffing(spark, tmp_path):
    texts = {
        "semi": "Mes;Valor\n2020-01;1,5\n2020-02;2\n", "pipe": "a|b|c\r\n1|2|x\r\n3|4|y\r\n", "none": "hola mundo\notra linea\n",
        "quoted": 'fecha,nota\n2020-01,"uno, dos"\n2020-02,"tres\ncuatro, cinco"\n', "ragged": "a,b\n1,2,3\n", "blanks": "mes,b\n1,2\n   \n3,4\n",
        "too_many": "mes,b\n1,2\n1,2,3\n",
        "empty_column": "x,y\n1,\n2,NA\n", "first_wins": "mes,a;b\n1,2;3\n", "one_line": "mes,b\n",
        "inches": 'mes,tubo\n1,2" recto\n2,3" curvo\n', "escaped": 'mes,x\n1,"a ""b, c"", d"\n2,""\n', "odd": 'mes,b\n1,x="2,3"\n',
    }
    files = spark.createDataFrame(list(texts.items()), "path string, text string")
    got = {r["path"]: r for r in candidate_listing(sniff_delimiters(files)).collect()}
    assert set(got) == {"semi", "pipe", "quoted", "first_wins", "inches", "escaped", "ragged", "odd", "blanks"}
    # The first field of lines that have one more than the header is an index.
    assert (got["ragged"]["columns"], got["ragged"]["numeric_like_columns"]) == (2, "a, b")
    assert (got["odd"]["columns"], got["odd"]["numeric_like_columns"]) == (2, "mes, b") and got["blanks"]["rows"] == 2
    assert (got["inches"]["rows"], got["escaped"]["rows"], got["escaped"]["columns"]) == (2, 2, 2)
    assert (got["semi"]["delimiter"], got["pipe"]["delimiter"], got["first_wins"]["delimiter"]) == (";", "|", ",")
    assert (got["quoted"]["rows"], got["quoted"]["columns"], got["quoted"]["date_like_columns"]) == (2, 2, "fecha")
    assert got["pipe"]["numeric_like_columns"] == "a, b" and got["pipe"]["rows"] == 2
    for name in ("semi", "pipe"):
        (tmp_path / f"{name}.csv").write_text(texts[name])
    (tmp_path / ".hidden.csv").write_text(texts["semi"])
    book = grid(spark, "book", ("s", {(0, 0): "mes", (0, 1): "v", (1, 0): "enero", (1, 1): 2}))
    both = profile_sources(book, read_text_files(spark, str(tmp_path / "*.csv")))
    assert {(r["sheet"], r["header_row"]) for r in both.collect()} == {("csv", 0), ("s", 0)} and both.count() == 3


def test_a_folder_of_texts_and_cell_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Mes;Valor\n2020-01;1,5\n2020-02;2\n")
    (tmp_path / "notes.md").write_text("mes,b\n1,2\n")
    assert {r["sheet"] for r in profile_folder(spark, str(tmp_path)).collect()} == {"csv"}
    book = grid(spark, "book", ("s", {(0, 0): "mes", (0, 1): "v", (1, 0): "enero", (1, 1): 2}))
    book.toPandas().astype({"num": "float64"}).to_parquet(tmp_path / "book.cells.parquet", coerce_timestamps="us")
    found = {(r["path"].rsplit("/", 1)[-1], r["sheet"], r["rows"]) for r in profile_folder(spark, str(tmp_path)).collect()}
    assert found == {("a.csv", "csv", 2), ("book", "s", 1)}


def test_leading_lines_of_split_files(spark, tmp_path):
    """A quoted field that goes over many splits, a long file of which only the beginning counts, line ends of all kinds."""
    field = "\n".join(f"nota {i}" for i in range(3000))
    (tmp_path / "quoted.csv").write_text(f'mes;nota\n2020-01;"{field}; fin"\n2020-02;"otra; nota"\n')
    (tmp_path / "long.csv").write_text("mes,v\r\n" + "".join(f"2020-{i % 12 + 1:02d},{i}\r\n" for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        files = read_text_files(spark, str(tmp_path), leading=100_000)
        texts = {r["path"].rsplit("/", 1)[-1]: r["text"] for r in files.collect()}
        found = {r["path"].rsplit("/", 1)[-1]: r for r in profile_folder(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert texts["quoted.csv"] == (tmp_path / "quoted.csv").read_text().rstrip("\n")
    whole = (tmp_path / "long.csv").read_bytes().decode().replace("\r\n", "\n")
    assert whole.startswith(texts["long.csv"]) and 99_900 < len(texts["long.csv"]) <= 100_000
    assert (found["quoted.csv"]["rows"], found["quoted.csv"]["columns"]) == (2, 2) and found["long.csv"]["rows"] == 80


def test_leading_lines_of_texts(spark):
    texts = ["ab\ncd\nef", "abcdefgh\nx", "a\n", None, "", "ab\ncdef"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(leading_lines(F.col("t"), 5)).collect()]
    assert got == ["ab", "abcde", "a\n", None, "", "ab"]


def test_scans_and_sinks(spark, monthly, tmp_path):
    df = monthly("2024-01", y=[1.5, None])
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / "new" / "folder" / fmt)
        write_dataset(df, path, fmt)
        back = read_monthly(spark, path, df.schema if fmt == "csv" else None, fmt)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect())) and dict(back.dtypes)["date"] == "date"
    assert dict(read_monthly(spark, str(tmp_path / "new" / "folder" / "csv")).dtypes)["y"] == "double"
    predictions = df.withColumns({"model": F.lit("a")})
    write_predictions(predictions, str(tmp_path / "p"))
    assert (tmp_path / "p" / "model=a").exists()
    nan = spark.createDataFrame([(float("nan"),)], "y double")
    write_dataset(nan, str(tmp_path / "nan"))
    assert read_monthly(spark, str(tmp_path / "nan"), fmt="parquet").first()["y"] is None
    with pytest.raises(ValueError, match="Unsupported"):
        read_monthly(spark, "x", fmt="xls")
    with pytest.raises(ValueError, match="Unsupported"):
        write_dataset(df, "x", fmt="xls")
