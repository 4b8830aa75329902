import datetime

import pytest

from monthpanel.operators.blocks import activity_series, aggregate_sheet, component_sheets, first_data_rows
from monthpanel.operators.reshape import (
    construction_records, material_index, quarter_to_months, two_row_header, year_matrix, year_matrix_cells,
)
from monthpanel.plans.lifecycle import build_dataset
from monthpanel.sources.cells import CELL_SCHEMA, table_from_cells


def day(text):
    return datetime.date.fromisoformat(text + "-01")


def grid(spark, path, *sheets):
    """Cell table from ``(sheet name, {(row, col): value})`` pairs."""
    made = []
    for place, (sheet, cells) in enumerate(sheets):
        for (row, col), v in cells.items():
            made.append((
                path, sheet, place, row, col, v if isinstance(v, str) else None,
                float(v) if isinstance(v, (int, float)) else None, v if isinstance(v, datetime.datetime) else None,
            ))
    return spark.createDataFrame(made, CELL_SCHEMA)


def table_cells(header_row, names, body):
    cells = {(header_row, c): n for c, n in enumerate(names)}
    cells.update({(header_row + 1 + r, c): v for r, line in enumerate(body) for c, v in enumerate(line) if v is not None})
    return cells


def lookup(long):
    return {(str(r["date"])[:7], r["series"]): r["value"] for r in long.collect()}


def test_year_matrix(spark):
    body = [["Enero", 100, 130], ["Febrero", 110, 140], ["Marzo", 120, 150], ["Total", 330, 420]]
    cells = grid(spark, "f", ("2002-2021", table_cells(9, ["Mes", 2020, 2021], body)))
    made = {r["date"]: r["remittances"] for r in year_matrix_cells(cells, "remittances").collect()}
    assert len(made) == 6 and made[day("2020-01")] == 100.0 and made[day("2021-03")] == 150.0
    wide = table_from_cells(cells, 9).drop("path", "sheet", "row")
    assert wide.columns == ["2020", "2021", "mes"]
    assert {r["date"]: r["v"] for r in year_matrix(wide, "v").collect()} == made
    with pytest.raises(ValueError, match="No year columns"):
        year_matrix(wide.select("mes"), "v")


def test_year_matrix_without_a_month_header(spark):
    body = [["Enero", 1, 2], ["Enero", 3, None], ["Suma", 9, 9], [None, 5, 6]]
    cells = grid(spark, "f", ("s", table_cells(0, ["Periodo mensual", 2020, "Año 2021p"], body)))
    made = {r["date"]: r["v"] for r in year_matrix_cells(cells, "v", 0).collect()}
    assert made == {day("2020-01"): 4.0, day("2021-01"): 2.0}


def test_quarters(spark):
    df = spark.createDataFrame([(2024, 2, 90.0), (2024, 3, None)], "ano int, trimestre int, n double")
    made = {r["date"]: r["n"] for r in quarter_to_months(df, ["n"]).collect()}
    assert made == {day(f"2024-0{m}"): v for m, v in zip(range(4, 10), [30.0] * 3 + [None] * 3)}


def test_construction_records(spark):
    names = ["ano", "trimestre", "departamento", "municipio", "num_construcciones", "area_con_m2", "costo_aprox_quetzales"]
    cells = grid(spark, "f", ("Hoja1", table_cells(0, names, [[2023, 2, 1, 1, 3, 300, 9000], [2023, 2, 1, 2, 6, 600, 18000]])))
    made = construction_records(table_from_cells(cells, 0, "Hoja1"), ["path"]).orderBy("date").collect()
    assert [str(r["date"]) for r in made] == ["2023-04-01", "2023-05-01", "2023-06-01"]
    assert {(r["construction_num_constructions"], r["construction_area_m2"], r["construction_cost_gtq"]) for r in made} == {
        (3.0, 300.0, 9000.0)}
    both = spark.createDataFrame([(2023, 1, 5.0, None), (2023, 1, None, 7.0)], "ano int, trimestre int, area_m2 double, area_con_m2 double")
    assert construction_records(both).first()["construction_area_m2"] == 4.0
    with pytest.raises(ValueError, match="Missing required"):
        construction_records(both.drop("ano"))
    with pytest.raises(ValueError, match="none of the known value"):
        construction_records(both.select("ano", "trimestre"))


def material_cells(spark):
    months = ["Enero", "Febrero", "Enero", "Febrero"]
    cells = {(0, 0): "No", (0, 1): "Material", (0, 2): "Indice base diciembre 2018", (0, 3): "Indices 2019", (0, 5): "Indices 2020"}
    cells.update({(1, 3 + i): m for i, m in enumerate(months)})
    cells.update({(2, 0): "C", (2, 1): "Agregados y aglomerantes"})
    for r, line in enumerate([[7, "Cemento gris tipo portland", 100, 101, 102, 103, 104], [8, "Arena de rio", 100, 99, 100, 101, "102,0"],
                              [9, "Acero estructural", 100, 200, 201, 202, 203]]):
        cells.update({(3 + r, c): v for c, v in enumerate(line)})
    return grid(spark, "f", ("Publicación Histórico 2026", cells))


def test_two_row_header(spark):
    long = two_row_header(material_cells(spark), keywords=["cemento", "arena"])
    wide = {r["date"]: r for r in material_index(long).collect()}
    assert sorted(wide) == [day("2019-01"), day("2019-02"), day("2020-01"), day("2020-02")]
    first = wide[day("2019-01")]
    assert first["ipmc_cement_related_index"] == 100.0 and first["ipmc_arena_de_rio_index"] == 99.0
    assert wide[day("2020-02")]["ipmc_arena_de_rio_index"] == 102.0
    substring = two_row_header(material_cells(spark), keywords=["acer"]).count()
    token = two_row_header(material_cells(spark), keywords=["acer"], match="token").count()
    assert (substring, token) == (4, 0)


HEADERS = [
    "Período", "Agricultura, ganadería, caza, silvicultura y pesca", "Explotación de minas y canteras",
    "Industrias manufactureras", "Suministro de electricidad y captación de agua", "Construcción",
    "Comercio al por mayor y al por menor", "Transporte, almacenamiento y comunicaciones",
    "Intermediación financiera, seguros y actividades auxiliares", "Alquiler de vivienda", "Servicios privados",
    "Administración pública y defensa", "SIFMI", "Impuestos netos de subvenciones a los productos", "IMAE",
]


def test_four_blocks(spark):
    cells = {}
    for start, construction, total in [(0, 100.0, 200.0), (16, 10.0, 20.0), (32, 110.0, 210.0), (48, 11.0, 21.0)]:
        cells.update({(6, start + i): h for i, h in enumerate(HEADERS)})
        for k in (0, 1):
            cells[(7 + k, start)] = datetime.datetime(2024, 1 + k, 1)
            cells[(7 + k, start + 5)], cells[(7 + k, start + 14)] = construction + k, total + k
    book = grid(spark, "f", ("IMAE componentes", cells))
    made = lookup(activity_series(book))
    want = {"index": (100, 200), "yoy": (10, 20), "trend_index": (110, 210), "trend_yoy": (11, 21)}
    for suffix, (construction, total) in want.items():
        for k in (0, 1):
            assert made.pop((f"2024-0{1 + k}", f"imae_construction_{suffix}")) == construction + k
            assert made.pop((f"2024-0{1 + k}", f"imae_general_{suffix}")) == total + k
    assert not made
    frame = build_dataset([("activity_index", book)], target=None).orderBy("date").collect()
    assert frame[0]["imae_construction_index"] == 100.0 and frame[1]["imae_general_trend_yoy"] == 22.0


def test_renamed_sheet(spark):
    cells = {(6, i): h for i, h in enumerate(HEADERS)}
    cells.update({(7, 0): datetime.datetime(2026, 3, 1), (7, 5): 150.0, (7, 14): 200.0})
    book = grid(spark, "f", ("Resumen", {(0, 0): "placeholder", (1, 0): 1}), ("Componentes IMAE 2013", cells))
    assert lookup(activity_series(book)) == {
        ("2026-03", "imae_construction_index"): 150.0, ("2026-03", "imae_general_index"): 200.0}
    assert component_sheets(book).collect()[0]["sheet"] == "Componentes IMAE 2013"
    assert component_sheets(book, "Resumen").collect()[0]["sheet"] == "Resumen"


def current_book(spark, path="f"):
    c2 = {(6, 0): "Período", (6, 3): "IMAE", (7, 2): "Construcción", (2, 5): "Variación interanual", (6, 5): "Período", (7, 6): "Construcción"}
    c2.update({(8, 0): datetime.datetime(2024, 1, 1), (8, 2): 1.0, (8, 3): 2.0, (8, 5): "2024-01", (8, 6): 3.0,
               (9, 0): "2024/1", (9, 2): 9.0, (10, 0): "nota", (10, 2): 8.0, (11, 0): datetime.datetime(2024, 2, 1), (11, 3): 5.0})
    c1 = {(0, 0): "Título", (3, 0): datetime.datetime(2024, 1, 1), (3, 1): 7.0, (3, 2): "x", (4, 0): datetime.datetime(1980, 1, 1), (4, 1): 6.0}
    return grid(spark, path, ("C.1", c1), ("C.2", c2))


def test_current_layout_and_collisions(spark):
    book = current_book(spark)
    assert lookup(activity_series(book)) == {
        ("2024-01", "imae_construction_index"): 1.0, ("2024-01", "imae_general_index_x"): 2.0,
        ("2024-01", "imae_construction_yoy"): 3.0, ("2024-01", "imae_general_index_y"): 7.0}
    assert lookup(activity_series(book, on_collision="coalesce"))[("2024-01", "imae_general_index")] == 2.0
    with pytest.raises(Exception, match="several blocks provide"):
        activity_series(book, on_collision="error").collect()
    with pytest.raises(ValueError):
        activity_series(book, on_collision="what")
    assert first_data_rows(book).where("sheet = 'C.1'").first()["first_row"] == 3
    assert lookup(aggregate_sheet(book.where("sheet = 'C.1'")).where("value is not null")) == {("2024-01", "imae_general_index"): 7.0}


def test_many_workbooks_at_once(spark):
    cells = {(6, i): h for i, h in enumerate(HEADERS)}
    cells.update({(7, 0): datetime.datetime(2026, 3, 1), (7, 5): 150.0, (7, 14): 200.0})
    books = current_book(spark, "new").unionByName(grid(spark, "old", ("IMAE componentes", cells)))
    made = activity_series(books, on_collision="coalesce").groupBy("path").count()
    assert {r["path"]: r["count"] for r in made.collect()} == {"new": 3, "old": 2}


def test_build_dataset(spark):
    body = [["Enero", 100, 130], ["Febrero", 110, 140]]
    remit = grid(spark, "f", ("2002-2021", table_cells(9, ["Mes", 2019, 2020], body)))
    sources = [("remittances", remit, "2002-2021", 9), ("material_index", material_cells(spark), None, 0)]
    made = build_dataset(sources, drop_missing_target=True)
    assert made.count() == 4 and "cement_demand_proxy_source_count" in made.columns
    assert {r["remittances_usd_millions"] for r in made.collect()} == {100.0, 110.0, 130.0, 140.0}
    with pytest.raises(ValueError, match="Unknown parser"):
        build_dataset([("nope", remit)])
    with pytest.raises(ValueError, match="No sources"):
        build_dataset([])
    with pytest.raises(ValueError, match="requires"):
        build_dataset(sources, target=None, drop_missing_target=True)
    trade = grid(spark, "f", ("Informe 1", table_cells(7, ["Año", "Mes", "Valor import"], [[2020, "Enero", "1.000,5"]])))
    assert build_dataset([("trade_by_product", trade, "Informe 1")], target=None).first()["trade_valor_import"] == 1000.5


def test_table_from_cells_keeps_blank_headers(spark):
    cells = grid(spark, "f", ("s", {(0, 0): "Mes", (1, 0): "x", (1, 2): 5.5, (2, 2): 20200101}))
    table = table_from_cells(cells, 0, names=["mes", "unnamed_2"]).orderBy("row").collect()
    assert [(r["mes"], r["unnamed_2"]) for r in table] == [("x", "5.5"), (None, "20200101")]


def test_repeated_headers_are_numbered(spark):
    cells = grid(spark, "f", ("s", table_cells(0, ["Mes", "Valor", "Valor", "valor", None], [["Enero", 10, 20, 30, 40]])))
    table = table_from_cells(cells).drop("path", "sheet", "row")
    assert table.columns == ["mes", "unnamed_4", "valor", "valor_1", "valor_2"] or "unnamed_4" not in table.columns
    row = table.first()
    assert (row["valor"], row["valor_1"], row["valor_2"]) == ("10", "20", "30")


def test_published_months_without_a_value_stay(spark):
    cells = grid(spark, "f", ("s", table_cells(0, ["Mes", 2020, 2021], [["Enero", 1, None], ["Febrero", None, None]])))
    made = {r["date"]: r["v"] for r in year_matrix_cells(cells, "v", 0).collect()}
    assert made == {day("2020-01"): 1.0, day("2021-01"): None, day("2020-02"): None, day("2021-02"): None}


def test_a_narrow_aggregate_sheet_has_no_more_series(spark):
    sheet = {(0, 0): "IMAE", (1, 0): datetime.datetime(2019, 1, 1), (1, 1): 5}
    found = aggregate_sheet(grid(spark, "f", ("C.1", sheet))).collect()
    assert {r["series"] for r in found} == {"imae_general_index"}


def test_sources_without_observations(spark):
    nothing = grid(spark, "f", ("s", {(0, 0): "Mes", (0, 1): "Nota", (1, 0): "Enero", (1, 1): 4}))
    for kind in ("remittances", "material_index", "activity_index"):
        with pytest.raises(ValueError, match="no monthly observation"):
            build_dataset([(kind, nothing, None, 0)], target=None)
