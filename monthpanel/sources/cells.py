"""Untyped sheets as cell tables.

A cell table has one row per non-blank cell::

    path STRING, sheet STRING, sheet_no INT, row INT, col INT,
    text STRING, num DOUBLE, ts TIMESTAMP

``path`` is the workbook, ``sheet_no`` the sheet's place in it; rows and columns
count from 0. Exactly one of ``text``, ``num`` and ``ts`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.functions.numbers import parse_number, to_number, year_in_text, year_of_number
from monthpanel.functions.text import slug

CELL_SCHEMA = (
    "path string, sheet string, sheet_no int, row int, col int, text string, num double, ts timestamp"
)
SHEET = ["path", "sheet"]
# Wide tables beyond so many columns must be asked for by name.
MAX_COLUMNS = 2000


def cell_label() -> Column:
    """Cell content as text; whole numbers without a fraction part, as a header shows them."""
    num, ts = F.col("num"), F.col("ts")
    digits = F.rtrim(num.cast("decimal(38,18)").cast("string"), F.lit("0"))
    whole = F.when(num == F.floor(num), F.floor(num).cast("string")).otherwise(digits)
    return F.coalesce("text", whole, ts.cast("string"))


def cell_number() -> Column:
    """Locale-tolerant number in a cell."""
    return F.coalesce("num", parse_number(F.col("text")))


def cell_strict_number() -> Column:
    """Number in a cell; formatted text does not count."""
    return F.coalesce("num", to_number(F.col("text")))


def cell_year() -> Column:
    """Year in a header cell."""
    return F.coalesce(year_of_number(F.col("num")), year_in_text(F.coalesce("text", F.col("ts").cast("string"))))


def sheet_cells(cells: DataFrame, sheet: str | int | None) -> DataFrame:
    """Cells of one sheet, by name or by place; ``None`` keeps all."""
    if sheet is None:
        return cells
    return cells.where(F.col("sheet_no") == sheet if isinstance(sheet, int) else F.col("sheet") == sheet)


def header_names(cells: DataFrame, header_row: int) -> DataFrame:
    """Column names of a header row: ``path, sheet, col, name``, repeats numbered ``_1``, ``_2`` from left to right."""
    names = cells.where(F.col("row") == header_row).select(*SHEET, "col", slug(cell_label()).alias("name"))
    # A header has one row per sheet and column. The second round numbers names that the first one made again.
    for _ in range(2):
        nth = F.row_number().over(Window.partitionBy(*SHEET, "name").orderBy("col")) - 1
        names = names.withColumn("name", F.when(nth == 0, F.col("name")).otherwise(F.concat("name", F.lit("_"), nth.cast("string"))))
    return names


def promote_header(cells: DataFrame, header_row: int) -> DataFrame:
    """Cells below a header row with their column's name: ``path, sheet, row, col, name, text, num, ts``.

    Cells under a blank header are named ``unnamed_<col>``. The header side has
    one row per sheet and column, so the join key spreads a hot sheet over its
    columns and adaptive execution splits what is left.
    """
    body = cells.where(F.col("row") > header_row)
    named = body.join(header_names(cells, header_row), [*SHEET, "col"], "left")
    blank = F.concat(F.lit("unnamed_"), F.col("col").cast("string"))
    return named.select(
        *SHEET, "row", "col", F.coalesce("name", blank).alias("name"), "text", "num", "ts"
    )


def table_from_cells(cells: DataFrame, header_row: int = 0, sheet: str | int | None = None,
                     names: list[str] | None = None) -> DataFrame:
    """Wide table below a header row: ``path, sheet, row`` and one text column per name.

    Without ``names`` the header row is read once to learn them (one name per
    sheet column); workbooks whose headers differ in more than ``MAX_COLUMNS``
    names need them given. Rows without any cell do not exist; columns that
    repeat a name are numbered.
    """
    chosen = sheet_cells(cells, sheet)
    if names is None:
        found = header_names(chosen, header_row).select("name").distinct().limit(MAX_COLUMNS + 1).collect()
        if len(found) > MAX_COLUMNS:
            raise ValueError(f"The header rows hold over {MAX_COLUMNS} names; choose some by `names`")
        names = sorted(r["name"] for r in found)
    rows = promote_header(chosen, header_row).groupBy(*SHEET, "row")
    return rows.pivot("name", names).agg(F.max_by(cell_label(), F.col("col")))
