"""Workbooks as published, written by Spark from ``lineitem``: one or more per supplier.

Headers come once per workbook, values once per monthly row. Cells are given as
SQL expressions over the monthly row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.functions.months import month_start
from monthpanel.plans.queries_clean import SPANISH
from monthpanel.plans.views import table
from monthpanel.sources.tables import new_folder, stored_at

MONTH_INDEX = "((year(date) - 1995) * 12 + month(date) - 1)"
MONTH_NAME = f"element_at(array({', '.join(repr(m) for m in SPANISH)}), month(date))"
COLUMNS = ["path", "sheet", "sheet_no", "row", "col", "text", "num", "ts"]


def cell(row, col, text=None, num=None, ts=None, amount=None, sheet: str = "Hoja1", sheet_no: int = 0) -> str:
    """One cell; ``amount`` is a number summed over the rows that meet in the cell."""
    typed = {"row": (row, "int"), "col": (col, "int"), "text": (text, "string"), "num": (num, "double"),
             "ts": (ts, "timestamp"), "amount": (amount, "double")}
    parts = [f"'{n}', cast({'null' if v is None else v} AS {kind})" for n, (v, kind) in typed.items()]
    return f"named_struct('sheet', '{sheet}', 'sheet_no', {sheet_no}, {', '.join(parts)})"


def word(row: int, col: int, text: str, **sheet) -> str:
    """A cell with a constant text."""
    return cell(row, col, f"'{text}'", **sheet)


def workbooks(rows: DataFrame, path: str, fixed: list[str], own: list[str], shared: list[str] = ()) -> DataFrame:
    """Cell table: ``fixed`` cells once per workbook, ``own`` cells once per row, ``shared`` cells
    folded where several rows meet in them. Cells without content are blank."""
    named = rows.withColumn("path", F.expr(f"cast({path} AS string)"))

    # The first row of a workbook also gives the cells that come once.
    first = F.row_number().over(Window.partitionBy("path").orderBy("date")) == 1
    cells = f"if(first, array({', '.join([*fixed, *own])}), array({', '.join(own)}))"
    book = named.withColumn("first", first).select("path", F.expr(f"inline({cells})")).select(*COLUMNS)
    if shared:
        folded = named.select("path", F.expr(f"inline(array({', '.join(shared)}))")).groupBy(*COLUMNS[:5]).agg(
            F.max("text").alias("text"), F.coalesce(F.sum("amount"), F.max("num")).alias("num"), F.max("ts").alias("ts")
        )
        book = book.unionByName(folded)
    return book.where("text is not null or num is not null or ts is not null")


def published(book: DataFrame) -> DataFrame:
    """The cell table as files: made once, however often a parser reads it."""
    return stored_at(book, new_folder(book.sparkSession, "book"))


def flagged_months(spark, sf_dir) -> DataFrame:
    """Quantity, price and lines per supplier, return flag and month."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.col("l_returnflag").alias("flag"),
        month_start(F.col("l_shipdate")).alias("date"), "l_quantity", "l_extendedprice",
    )
    return lines.groupBy("supplier", "flag", "date").agg(
        F.sum("l_quantity").alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.count("*").alias("lines"),
    )


FLAGGED_MONTHS = """flagged AS (
  SELECT l_suppkey AS supplier, l_returnflag AS flag, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         sum(l_quantity) AS quantity, round(sum(l_extendedprice), 2) AS price, count(*) AS lines
  FROM lineitem GROUP BY 1, 2, 3)"""


def year_matrix_book(months: DataFrame) -> DataFrame:
    """Months down, years across below header row 9, with a total row."""
    month, at = "9 + month(date)", "year(date) - 1994"
    return workbooks(
        months, "supplier",
        fixed=[word(0, 0, "Remesas"), word(9, 0, "Mes"), word(22, 0, "Total")],
        own=[cell(month, at, num="quantity")],
        shared=[cell(9, at, num="year(date)"), cell(month, 0, MONTH_NAME), cell(22, at, amount="quantity")],
    )


def two_row_book(months: DataFrame) -> DataFrame:
    """Years over months across, one row per return flag; years stand over January only."""
    at, place = f"{MONTH_INDEX} + 3", "case flag when 'A' then 3 when 'N' then 4 else 5 end"
    name = "case flag when 'A' then 'Cemento gris' when 'N' then 'Agregados' else 'Acero' end"
    return workbooks(
        months, "supplier",
        fixed=[word(0, 0, "No"), word(0, 1, "Material"), word(0, 2, "Indice base diciembre 2018")],
        own=[cell(place, at, "case when flag = 'N' then format_number(quantity, 2) end",
                  num="case when flag <> 'N' then quantity end")],
        shared=[cell(0, f"{at} - month(date) + 1", "concat('Indices ', year(date))"), cell(1, at, MONTH_NAME),
                cell(place, 1, name), cell(place, 2, num="100.0")],
    )


def listing_book(months: DataFrame) -> DataFrame:
    """A plain table below header row 2."""
    at = f"{MONTH_INDEX} + 3"
    return workbooks(
        months, "supplier",
        fixed=[word(0, 0, "Informe"), word(2, 0, "Año"), word(2, 1, "Mes"), word(2, 2, "Cantidad"), word(2, 3, "Valor (USD)"),
               word(2, 4, "Valor USD")],
        own=[cell(at, 0, num="year(date)"), cell(at, 1, MONTH_NAME), cell(at, 2, num="quantity"),
             cell(at, 3, "format_number(revenue, 2)"), cell(at, 4, num="lines")],
    )


def aggregate_book(months: DataFrame, path: str) -> DataFrame:
    """An aggregate sheet: titles, then dated rows with up to four values."""
    at, sheet = f"{MONTH_INDEX} + 5", {"sheet": "C.1", "sheet_no": 0}
    return workbooks(
        months, path,
        fixed=[word(0, 0, "IMAE", **sheet), cell(1, 0, num="2013.0", **sheet), word(3, 0, "Período", **sheet)],
        own=[
            cell(at, 0, ts="date", **sheet), cell(at, 1, num="lines * 10", **sheet), cell(at, 2, "lines", **sheet),
            cell(at, 3, "'n/d'", **sheet), cell(at, 4, num="case when lines > 1 then lines end", **sheet),
        ],
    )


def activity_books(months: DataFrame) -> DataFrame:
    """A workbook per supplier and flag: current layout for A and N (A also with an
    aggregate sheet), older layout with four blocks for R."""
    path = "concat(supplier, '-', flag)"
    at, c2 = f"{MONTH_INDEX} + 8", {"sheet": "C.2", "sheet_no": 1}
    current = workbooks(
        months.where("flag in ('A', 'N')"), path,
        fixed=[
            word(0, 0, "Índice", **c2), word(6, 0, "Período", **c2), word(6, 1, "A", **c2), word(6, 5, "F", **c2),
            word(6, 6, "IMAE", **c2), word(7, 1, "Agricultura", **c2), word(7, 5, "Construcción", **c2),
            word(2, 10, "Variación interanual", **c2), word(6, 9, "Período", **c2), word(6, 15, "IMAE", **c2),
            word(7, 12, "Construcción", **c2),
        ],
        own=[
            cell(at, 0, ts="date", **c2), cell(at, 1, num="-1", **c2), cell(at, 5, num="quantity", **c2),
            cell(at, 6, num="lines", **c2), cell(at, 9, "date_format(date, 'yyyy/M')", **c2),
            cell(at, 12, num="price", **c2), cell(at, 15, num="case when lines > 1 then lines * 2 end", **c2),
        ],
    )
    at, old = f"{MONTH_INDEX} + 7", {"sheet": "Componentes nuevos", "sheet_no": 1}
    headers, values = [word(0, 0, "Resumen de construcción", sheet="Resumen", sheet_no=0)], []
    for block in range(4):
        start = 16 * block
        headers += [
            word(6, start, "Período", **old), word(6, start + 3, "Comercio", **old),
            word(6, start + 5, "Construcción", **old), word(6, start + 14, "IMAE", **old),
        ]
        values += [
            cell(at, start, ts="date", **old), cell(at, start + 5, num=f"quantity + {block}", **old),
            cell(at, start + 14, num=f"price + {block}", **old),
        ]
    older = workbooks(months.where("flag = 'R'"), path, headers, values)
    return current.unionByName(aggregate_book(months.where("flag = 'A'"), path)).unionByName(older)


def numbered_book(months: DataFrame) -> DataFrame:
    """A table from row 0 without blank rows: months in order from row 1."""
    at = F.row_number().over(Window.partitionBy("supplier").orderBy("date"))
    placed = months.select("supplier", "date", "quantity", "lines", at.alias("at"))
    return workbooks(
        placed, "supplier",
        fixed=[word(0, 0, "Mes"), word(0, 1, "Cantidad"), word(0, 2, "Líneas")],
        own=[cell("at", 0, MONTH_NAME), cell("at", 1, num="quantity"), cell("at", 2, num="lines")],
    )


def csv_files(months: DataFrame) -> DataFrame:
    """A delimited text per supplier, delimiters taking turns: ``path, text``."""
    mark = F.get(F.array(F.lit(";"), F.lit("\t"), F.lit("|")), (F.col("supplier") % 3).cast("int"))
    fields = F.struct("date", "quantity", "lines")
    rows = F.transform(F.sort_array(F.collect_list(fields)), lambda m: F.concat_ws(
        "~", F.date_format(m["date"], "yyyy-MM"), m["quantity"].cast("bigint").cast("string"),
        F.concat(F.lit('"'), m["lines"].cast("string"), F.lit(' ~ lotes"')),
    ))
    text = F.concat(F.lit("Mes~Cantidad~Líneas\n"), F.array_join(rows, "\n"))
    # A supplier's rows here are its months.
    files = months.groupBy("supplier").agg(text.alias("text"))
    return files.select(
        F.concat(F.lit("sup-"), F.col("supplier").cast("string")).alias("path"),
        F.replace("text", F.lit("~"), mark).alias("text"),
    )
