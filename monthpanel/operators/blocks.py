"""Side-by-side blocks of one sheet: discovery, reading and layout dispatch.

Block positions are facts about a sheet's header and never exceed its width.
They are worked out from header cells alone and turned into a list of wanted
columns, which the data cells then meet in a plain equi-join: no range join, and
nothing depends on how many rows a sheet has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.functions.months import strict_month
from monthpanel.functions.text import slug_soft
from monthpanel.operators.clean import year_range
from monthpanel.operators.panel import first_in_order
from monthpanel.sources.cells import SHEET, cell_label, cell_strict_number

# Sheet names, words and output suffixes of the activity-index workbooks.
AGGREGATE_SHEET = "C.1"
COMPONENT_SHEET = "C.2"
OLD_SHEET = "IMAE componentes"
PERIOD, CONSTRUCTION, TOTAL = "periodo", "construccion", "imae"
CHANGE_WORDS = ["variacion", "interanual"]
SUFFIXES = ["index", "yoy", "trend_index", "trend_yoy"]
AGGREGATE_COLUMNS = {
    1: "imae_general_index", 2: "imae_general_yoy",
    3: "imae_general_trend_index", 4: "imae_general_trend_yoy",
}

# Block numbers: components from 1, then the aggregate sheet, then the older layout.
AGGREGATE_BLOCK, OLD_BLOCKS = 100_000, 200_000


def _along_sheet():
    return Window.partitionBy(*SHEET).orderBy("col")


def _is_total(name: Column) -> Column:
    return (name == TOTAL) | name.endswith("_" + TOTAL)


def component_blocks(cells: DataFrame) -> DataFrame:
    """Blocks of the current component sheet: ``path, sheet, block, start, suffix, construction, total``.

    Row 6 starts blocks and holds codes, row 7 names, rows 0..5 titles. A block
    is 25 columns wide at most and needs a construction column.
    """
    header = cells.where(F.col("row") <= 7).select(*SHEET, "row", "col", slug_soft(cell_label()).alias("name"))
    is_start = (F.col("row") == 6) & F.col("name").contains(PERIOD)
    # Header cells only: a window partition holds at most eight rows times the sheet's width.
    placed = header.withColumn(
        "start", F.max(F.when(is_start, F.col("col"))).over(_along_sheet().rangeBetween(Window.unboundedPreceding, 0))
    ).where(F.col("col") < F.col("start") + 25)
    title = F.col("row") <= 5
    changes = reduce(lambda a, b: a | b, [F.col("name").contains(w) for w in CHANGE_WORDS])
    blocks = placed.groupBy(*SHEET, "start").agg(
        F.coalesce(F.bool_or(title & changes), F.lit(False)).alias("is_change"),
        F.min(F.when((F.col("row") == 7) & F.col("name").contains(CONSTRUCTION), F.col("col"))).alias("construction"),
        F.max(F.when((F.col("row") == 6) & _is_total(F.col("name")), F.col("col"))).alias("total"),
    )
    order = F.row_number().over(Window.partitionBy(*SHEET).orderBy("start"))
    suffix = F.when(F.col("is_change"), "yoy").otherwise("index")
    return blocks.select(
        *SHEET, order.alias("block"), "start", suffix.alias("suffix"), "construction", "total"
    ).where("construction is not null")


def old_blocks(cells: DataFrame, header_row: int = 6) -> DataFrame:
    """Blocks of the older layout, in the same shape.

    A start needs a construction and a total column within 20 columns. Blocks
    are index, yoy, trend index, trend yoy in order; further ones index again.
    """
    header = cells.where(F.col("row") == header_row).select(*SHEET, "col", slug_soft(cell_label()).alias("name"))
    ahead = _along_sheet().rangeBetween(0, 19)
    has_construction = F.col("name").contains(CONSTRUCTION)
    flagged = header.select(
        *SHEET, "col", "name",
        (F.col("name").contains(PERIOD) & F.bool_or(has_construction).over(ahead)
         & F.bool_or(_is_total(F.col("name"))).over(ahead)).alias("is_start"),
    )
    placed = flagged.select(
        *SHEET, "col", "name",
        F.max(F.when(F.col("is_start"), F.col("col"))).over(_along_sheet().rangeBetween(Window.unboundedPreceding, 0)).alias("start"),
        F.max(F.when(F.col("is_start"), F.col("col"))).over(Window.partitionBy(*SHEET)).alias("last_start"),
    ).where((F.col("start") < F.col("last_start")) | (F.col("col") < F.col("start") + 20))
    blocks = placed.groupBy(*SHEET, "start").agg(
        F.min(F.when(F.col("name").contains(CONSTRUCTION), F.col("col"))).alias("construction"),
        F.max(F.when(_is_total(F.col("name")), F.col("col"))).alias("total"),
    )
    order = F.row_number().over(Window.partitionBy(*SHEET).orderBy("start"))
    suffix = F.coalesce(F.get(F.array(*map(F.lit, SUFFIXES)), order - 1), F.lit(SUFFIXES[0]))
    return blocks.select(
        *SHEET, order.alias("block"), "start", suffix.alias("suffix"), "construction", "total"
    ).where("construction is not null")


def wanted_columns(blocks: DataFrame, first_row: int) -> DataFrame:
    """The columns that blocks read, one row per block and role."""
    roles = F.array(
        F.struct(F.lit("date").alias("role"), F.col("start").alias("col")),
        F.struct(F.lit("construction").alias("role"), F.col("construction").alias("col")),
        F.struct(F.lit("general").alias("role"), F.col("total").alias("col")),
    )
    return blocks.select(
        *SHEET, "block", "suffix", F.lit(first_row).alias("first_row"), F.col("total").isNotNull().alias("has_total"),
        F.explode(roles).alias("r"),
    ).select(*SHEET, "block", "suffix", "first_row", "has_total", "r.role", "r.col").where("col is not null")


def read_columns(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """Observations of wanted columns: ``path, date, series, value, block``, the first non-null
    value of a month in row order.

    Rows count when their date cell is a month and the construction value is
    present. A series whose values are all missing keeps its rows, without a value.
    """
    ids = ["path", "sheet", "block", "suffix", "has_total"]
    met = cells.join(wanted, [*SHEET, "col"]).where(F.col("row") >= F.col("first_row"))
    role = F.col("role")
    rows = met.groupBy(*ids, "row").agg(
        F.max(F.when(role == "date", strict_month(F.col("text"), F.col("ts")))).alias("date"),
        F.max(F.when(role == "construction", cell_strict_number())).alias("construction"),
        F.max(F.when(role == "general", cell_strict_number())).alias("general"),
    ).where("date is not null and construction is not null")
    months = rows.groupBy(*ids, "date").agg(
        first_in_order(F.col("construction"), F.col("row")).alias("construction"),
        first_in_order(F.col("general"), F.col("row")).alias("general"),
    )
    long = months.unpivot([*ids, "date"], ["construction", "general"], "part", "value")
    return long.where("part = 'construction' or has_total").select(
        "path", "date", F.concat(F.lit("imae_"), "part", F.lit("_"), "suffix").alias("series"), "value", "block"
    )


def aggregate_sheet(cells: DataFrame, columns: dict[int, str] = AGGREGATE_COLUMNS) -> DataFrame:
    """Dates in column 0 and named value columns: ``path, date, series, value``.

    Data starts at the first row with a valid date, so every dated row is data
    and one aggregation by row replaces a search for that first row. Columns
    beyond the width of a workbook's sheet are no series of it.
    """
    widths = cells.groupBy("path").agg(F.max("col").alias("width"))
    rows = cells.where(F.col("col").isin(0, *columns)).groupBy(*SHEET, "row").agg(
        F.max(F.when(F.col("col") == 0, strict_month(F.col("text"), F.col("ts")))).alias("date"),
        *[F.max(F.when(F.col("col") == i, cell_strict_number())).alias(name) for i, name in columns.items()],
    ).where("date is not null")
    names = list(columns.values())
    months = rows.groupBy("path", "date").agg(*[first_in_order(F.col(n), F.col("row")).alias(n) for n in names])
    places = F.create_map(*[F.lit(x) for i, name in columns.items() for x in (name, i)])
    long = months.unpivot(["path", "date"], names, "series", "value")
    return long.join(widths, "path").where(F.element_at(places, F.col("series")) <= F.col("width")).drop("width")


def first_data_rows(cells: DataFrame) -> DataFrame:
    """First row of each sheet whose leading cell is a month: ``path, sheet, first_row``."""
    dated = cells.where((F.col("col") == 0) & strict_month(F.col("text"), F.col("ts")).isNotNull())
    return dated.groupBy(*SHEET).agg(F.min("row").alias("first_row"))


def component_sheets(cells: DataFrame, preferred: str = OLD_SHEET, sample_rows: int = 80) -> DataFrame:
    """Per workbook the sheet with the component table: ``path, sheet``.

    The preferred name when it exists, else the first sheet whose leading rows
    hold the words for period, construction and total.
    """
    name = F.when((F.col("row") < sample_rows) & F.col("text").isNotNull(), slug_soft(F.col("text")))
    words = [PERIOD, CONSTRUCTION, TOTAL]
    sheets = cells.select(*SHEET, "sheet_no", name.alias("name")).groupBy(*SHEET, "sheet_no").agg(*[
        F.coalesce(F.bool_or(F.col("name").contains(w)), F.lit(False)).alias(w) for w in words
    ])
    fits = (F.col("sheet") == preferred) | (F.col(PERIOD) & F.col(CONSTRUCTION) & F.col(TOTAL))
    place = F.when(F.col("sheet") == preferred, F.lit(-1)).otherwise(F.col("sheet_no"))
    return sheets.where(fits).groupBy("path").agg(F.min_by("sheet", place).alias("sheet"))


def activity_series(cells: DataFrame, preferred: str = OLD_SHEET, header_row: int = 6,
                    on_collision: str = "suffix") -> DataFrame:
    """Activity indices of workbooks in either layout: ``path, date, series, value``.

    The component and aggregate sheets of the current layout are merged; the
    older layout counts only for workbooks that yield nothing there.
    ``on_collision`` says what happens to a series that two blocks or sheets
    provide: ``suffix`` (``_x`` and ``_y``), ``coalesce`` (first in order) or ``error``.

    Apart from the data itself, only header rows and the leading rows of text
    cells are read; all blocks of all layouts meet the data in one join.
    """
    component = cells.where(F.col("sheet") == COMPONENT_SHEET)
    current = wanted_columns(component_blocks(component), first_row=8)
    named = old_blocks(cells, header_row).join(component_sheets(cells, preferred), SHEET)
    old = wanted_columns(named, header_row + 1).withColumn("block", F.col("block") + OLD_BLOCKS)
    blocks = read_columns(cells, current.unionByName(old))
    summary = aggregate_sheet(cells.where(F.col("sheet") == AGGREGATE_SHEET))
    found = blocks.unionByName(summary.withColumn("block", F.lit(AGGREGATE_BLOCK)))
    # From here on a workbook has at most its months times its blocks.
    is_current = F.col("block") < OLD_BLOCKS
    any_current = F.bool_or(is_current).over(Window.partitionBy("path"))
    kept = found.withColumn("__any", any_current).where(is_current | ~F.col("__any")).drop("__any")
    return year_range(_resolve(kept, on_collision))


def _resolve(observations: DataFrame, on_collision: str) -> DataFrame:
    """Settle series that several blocks of a workbook provide."""
    if on_collision == "coalesce":
        merged = observations.groupBy("path", "date", "series").agg(
            first_in_order(F.col("value"), F.col("block")).alias("value")
        )
        return merged.where("value is not null")
    blocks = F.sort_array(F.collect_set("block").over(Window.partitionBy("path", "series")))
    placed = observations.withColumn("__blocks", blocks)
    shared = F.size("__blocks") > 1
    if on_collision == "error":
        problem = F.raise_error(F.concat(F.lit("several blocks provide "), "series")).cast("string")
        name = F.when(shared, problem).otherwise(F.col("series"))
    elif on_collision == "suffix":
        place = F.array_position("__blocks", F.col("block"))
        tail = F.when(place == 1, "_x").when(place == 2, "_y").when(place == 3, "").otherwise(
            F.concat(F.lit("_"), place.cast("string"))
        )
        name = F.concat("series", F.when(shared, tail).otherwise(F.lit("")))
    else:
        raise ValueError(f"Unknown collision rule: {on_collision!r}")
    return placed.select("path", "date", name.alias("series"), "value").where("value is not null")
