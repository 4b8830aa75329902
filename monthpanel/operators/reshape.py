"""Turning published table layouts into monthly series."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.fixed import CONSTRUCTION_COLUMNS, MATERIAL_KEYWORDS, YEAR_PATTERN
from monthpanel.functions.months import month_from_parts, month_number
from monthpanel.functions.numbers import year_in_text
from monthpanel.functions.text import contains_any, slug, slug_name
from monthpanel.operators.clean import first_existing_column, number_column, slug_columns, sum_by_month
from monthpanel.operators.panel import to_wide
from monthpanel.sources.cells import MAX_COLUMNS, SHEET, cell_label, cell_number, cell_year, header_names, promote_header


def year_matrix(df: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """Month rows by year columns into ``keys, date, <value>``.

    Rows whose label is no month (totals) drop out; repeated months are summed.
    Year columns are those whose name holds a year; the month column is ``mes``
    or ``month``, else the first.
    """
    table = slug_columns(df)
    own = [c for c in table.columns if c not in keys]
    label = first_existing_column(own, ["mes", "month"]) or own[0]
    years = [c for c in own if c != label and re.search(YEAR_PATTERN, c)]
    if not years:
        raise ValueError("No year columns were found")
    numbers = table.select(*keys, F.col(label).cast("string").alias("__label"),
                           *[number_column(table, c).alias(c) for c in years])
    long = numbers.unpivot([*keys, "__label"], years, "__year", value)
    dated = long.select(
        *keys, month_from_parts(year_in_text(F.col("__year")), month_number(F.col("__label"))).alias("date"), value
    ).where("date is not null")
    return sum_by_month(dated, [value], keys)


def year_matrix_cells(cells: DataFrame, value: str, header_row: int = 9) -> DataFrame:
    """The year matrix read straight from cells, per workbook: ``path, date, <value>``.

    The column of month labels is the one headed ``mes`` or ``month``, else the
    first of the sheet. A month that has its label and its year but a blank cell
    is there without a value. A sheet without year columns gives no rows; see
    ``require_rows``.
    """
    named = promote_header(cells, header_row)
    # One row per sheet: broadcast by adaptive execution while small, else joined with skew splitting.
    labels = named.groupBy(*SHEET).agg(F.coalesce(
        F.max(F.when(F.col("name") == "mes", F.col("col"))), F.max(F.when(F.col("name") == "month", F.col("col"))),
        F.min("col"),
    ).alias("label_at"))
    placed = named.join(labels, SHEET)
    is_label = F.col("col") == F.col("label_at")
    months = placed.where(is_label).select(*SHEET, "row", month_number(cell_label()).alias("month"))
    values = placed.where(~is_label).select(*SHEET, "row", "col", cell_number().alias(value))
    headed = header_names(cells, header_row).join(labels, SHEET).where("col <> label_at")
    years = headed.select(*SHEET, "col", year_in_text(F.col("name")).alias("year")).where("year is not null")
    # Labelled rows by year columns: a sheet has a dozen of the one and some dozens of the other.
    grid = months.where("month is not null").join(years, SHEET)
    dated = grid.join(values, [*SHEET, "row", "col"], "left").select(
        "path", month_from_parts(F.col("year"), F.col("month")).alias("date"), value
    )
    return sum_by_month(dated, [value], ["path"])


def quarter_to_months(df: DataFrame, values: list[str], year: str = "ano", quarter: str = "trimestre",
                      keys: list[str] = ()) -> DataFrame:
    """Spread quarterly values evenly over the three months of the quarter."""
    months = df.select(*keys, year, quarter, *values, F.explode(F.sequence(F.lit(0), F.lit(2))).alias("__step"))
    month = 3 * (F.col(quarter).cast("int") - 1) + 1 + F.col("__step")
    return months.select(
        *keys, month_from_parts(F.col(year).cast("int"), month).alias("date"),
        *[(F.col(v) / 3).alias(v) for v in values],
    )


def construction_records(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Quarterly records by place: summed per quarter, spread over months.

    Columns that mean the same are coalesced into one output column.
    """
    table = slug_columns(df)
    absent = [c for c in ("ano", "trimestre") if c not in table.columns]
    if absent:
        raise ValueError(f"Missing required construction columns: {absent}")
    found = {
        out: [s for s in sources if s in table.columns] for out, sources in CONSTRUCTION_COLUMNS.items()
    }
    values = [out for out, sources in found.items() if sources]
    if not values:
        raise ValueError("none of the known value columns of construction records is there")
    records = table.select(
        *keys, number_column(table, "ano").cast("int").alias("ano"),
        number_column(table, "trimestre").cast("int").alias("trimestre"),
        *[F.coalesce(*[number_column(table, s) for s in found[out]]).alias(out) for out in values],
    ).na.drop(subset=["ano", "trimestre"])
    quarters = records.groupBy(*keys, "ano", "trimestre").agg(*[F.sum(v).alias(v) for v in values])
    return quarter_to_months(quarters, values, keys=list(keys))


def two_row_header(cells: DataFrame, header_row: int = 0, keywords: list[str] | None = None,
                   match: str = "substring") -> DataFrame:
    """Series rows under a year row and a month row: ``path, date, series, value``.

    Years fill blank header cells to the right. Column 1 names the series; rows
    are kept by keyword inside the name's slug (``match='token'``: as a whole
    word of it). Columns before the third hold no months.
    """
    words = [slug_name(w) for w in keywords or MATERIAL_KEYWORDS]
    tops = cells.where(F.col("row").isin(header_row, header_row + 1)).groupBy(*SHEET, "col").agg(
        F.max(F.when(F.col("row") == header_row, F.struct("text", "num", "ts"))).alias("top"),
        F.max(F.when(F.col("row") == header_row + 1, cell_label())).alias("below"),
    )
    # One header row per sheet: the window sees at most as many rows as a sheet has columns.
    along = Window.partitionBy(*SHEET).orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    filled = tops.select(*SHEET, "col", "below", F.last("top", ignorenulls=True).over(along).alias("top"))
    months = filled.where(F.col("col") >= 3).select(
        *SHEET, "col", F.col("top.text").alias("text"), F.col("top.num").alias("num"),
        F.col("top.ts").alias("ts"), "below",
    ).select(
        *SHEET, "col", month_from_parts(cell_year(), month_number(F.col("below"))).alias("date")
    ).where("date is not null")

    if match == "token":
        fits = F.arrays_overlap(F.split("series", "_"), F.array(*map(F.lit, words)))
    else:
        fits = contains_any(F.col("series"), words)
    # A sheet row is gathered with its name: as many cells as the sheet has columns, and only of rows that count.
    number = F.when(F.col("col") >= 3, cell_number())
    rows = cells.where((F.col("row") >= header_row + 2) & ((F.col("col") == 1) | (F.col("col") >= 3))).groupBy(*SHEET, "row").agg(
        F.max(F.when(F.col("col") == 1, slug(cell_label()))).alias("series"),
        F.collect_list(F.when(number.isNotNull(), F.struct("col", number.alias("value")))).alias("values"),
    )
    values = rows.where(fits).select(*SHEET, "series", F.inline("values"))
    return values.join(months, [*SHEET, "col"]).select("path", "date", "series", "value")


def material_index(long: DataFrame, series: list[str] | None = None, prefix: str = "ipmc",
                   total: str = "ipmc_cement_related_index") -> DataFrame:
    """Wide material indices, ``<prefix>_<series>_index``, with the mean of the series as ``total``.

    The mean weighs each series once, also where a series repeats in a month.
    Over ``MAX_COLUMNS`` series must be given.
    """
    if series is None:
        found = long.select("series").distinct().limit(MAX_COLUMNS + 1).collect()
        if len(found) > MAX_COLUMNS:
            raise ValueError(f"There are over {MAX_COLUMNS} series; choose some by `series`")
        series = sorted(r["series"] for r in found)
    wide = to_wide(long.where(F.col("series").isin(series)), series, ["path"])
    means = long.groupBy("path", "date", "series").agg(F.avg("value").alias("value"))
    totals = means.groupBy("path", "date").agg(F.avg("value").alias(total))
    named = wide.select("path", "date", *[F.col(f"`{s}`").alias(f"{prefix}_{s}_index") for s in series])
    return named.join(totals, ["path", "date"])
