"""Finding tables in raw files: candidate header rows of sheets, delimiters of text files."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthpanel.fixed import CSV_MISSING, DATE_LIKE, DELIMITERS
from monthpanel.functions.numbers import parse_number
from monthpanel.functions.text import contains_any, slug
from monthpanel.sources.cells import CELL_SCHEMA, SHEET, cell_label, cell_number

SAMPLE_ROWS = 80
# Characters of a text file that are looked at: its leading lines of that many at most, the first line whole.
LEADING = 1 << 20
# Stand-ins for delimiters and line ends inside quoted fields.
COVERED = "".join(DELIMITERS) + "\n"
COVERS = "".join(chr(1 + i) for i in range(len(COVERED)))


def profile_sheets(cells: DataFrame, max_header_rows: int = 12, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Table candidates: every sheet and header row with at least two filled columns
    and a date-like name or two numeric-like columns.

    Only the rows a candidate samples are read. They are gathered once per sheet
    column, at most ``max_header_rows + sample_rows`` cells each, and every
    header row is judged on that list: cells are not multiplied by header rows.
    """
    top = cells.where(F.col("row") <= max_header_rows - 1 + sample_rows)
    label = F.when(F.col("row") < max_header_rows, cell_label())
    gathered = top.groupBy(*SHEET, "col").agg(
        F.collect_list(F.struct("row", label.alias("label"), cell_number().isNotNull().alias("is_number"))).alias("cells")
    )
    tried = gathered.select(*SHEET, "col", "cells", F.explode(F.sequence(F.lit(0), F.lit(max_header_rows - 1))).alias("header_row"))
    header = F.col("header_row")
    body = F.filter("cells", lambda c: (c["row"] > header) & (c["row"] <= header + sample_rows))
    columns = tried.select(
        *SHEET, "header_row", "col", F.get(F.filter("cells", lambda c: c["row"] == header), F.lit(0))["label"].alias("label"),
        body.alias("body"),
    ).select(
        *SHEET, "header_row", "col", "label", F.col("body.row").alias("filled_rows"),
        F.size(F.filter("body", lambda c: c["is_number"])).alias("numbers"), F.lit(True).alias("in_header"),
    )
    return _accepted(columns, [*SHEET, "header_row"])


def _accepted(columns: DataFrame, ids: list[str]) -> DataFrame:
    """Tables from their columns, where the acceptance rule holds.

    Takes ``col, label, filled_rows, numbers, in_header`` per column. A column
    without values is dropped; a table with a column outside its header is none.
    Repeated labels are numbered. One exchange by table serves the numbering and
    the aggregation, over at most as many rows as a table has columns.
    """
    unnamed = F.concat(F.lit("unnamed_"), F.col("col").cast("string"))
    name = F.when(F.coalesce(F.trim("label"), F.lit("")) == "", unnamed).otherwise(slug(F.col("label")))
    numbered = columns.repartition(*ids).select(
        *ids, "col", "filled_rows", "numbers", "in_header", name.alias("name"),
        F.row_number().over(Window.partitionBy(*ids, "label").orderBy("col")).alias("place"),
    )
    full_name = F.when(F.col("place") > 1, F.concat_ws("_", "name", F.col("place") - 1)).otherwise(F.col("name"))
    filled = F.size("filled_rows") > 0
    tables = numbered.select(*ids, "col", "filled_rows", "numbers", "in_header", full_name.alias("name")).groupBy(*ids).agg(
        F.bool_and("in_header").alias("regular"),
        F.size(F.array_distinct(F.flatten(F.collect_list("filled_rows")))).cast("long").alias("rows"),
        F.sort_array(F.collect_list(F.when(filled, F.struct("col", "name", "numbers")))).alias("found"),
    ).where(F.col("regular") & (F.size("found") >= 2))
    dates = F.filter("found", lambda c: contains_any(c["name"], DATE_LIKE))
    numeric = F.filter("found", lambda c: c["numbers"] * 2 >= F.col("rows"))
    accepted = tables.where((F.size(dates) > 0) | (F.size(numeric) >= 2))
    return accepted.select(
        *ids, "rows", F.size("found").cast("long").alias("columns"), F.col("found.name").alias("column_names"),
        F.transform(dates, lambda c: c["name"]).alias("date_like_columns"),
        F.transform(numeric, lambda c: c["name"]).alias("numeric_like_columns"),
    )


def _by_delimiter(make) -> Column:
    """The expression of the row's delimiter, each with a constant pattern."""
    first, *others = [(F.col("delimiter") == mark, make(mark)) for mark in DELIMITERS]
    return reduce(lambda chain, branch: chain.when(*branch), others, F.when(*first))


def _shielded(mark: str) -> Column:
    """The text with delimiters and line ends inside quoted fields covered.

    A quoted piece follows a delimiter or line end, or another quoted piece
    directly (a doubled quote).
    """
    quoted = f'[{mark}\n]"[^"]*+"|\\G"[^"]*+"'
    pieces = F.regexp_extract_all("text", F.lit(quoted), F.lit(0))

    def covered(piece: Column) -> Column:
        return F.concat(F.substring(piece, 1, 1), F.translate(F.substring(piece, 2, 2_000_000_000), COVERED, COVERS))

    plain = F.split("text", quoted)
    joined = F.zip_with(plain, pieces, lambda p, q: F.concat(p, F.coalesce(covered(q), F.lit(""))))
    return F.when(F.contains("text", F.lit('"')), F.array_join(joined, "")).otherwise(F.col("text"))


def sniff_delimiters(files: DataFrame, path: str = "path", text: str = "text",
                     sample_rows: int | None = SAMPLE_ROWS) -> DataFrame:
    """First delimiter under which a whole-file text reads as a table, with the table's profile.

    A field that starts with a double quote keeps delimiters and line ends up to
    its closing quote; other quotes are plain text. Lines of blanks are skipped.
    Where the first data line has more fields than the header, its leading fields
    are an index and the header names the rest; a line with still more fields
    rules the delimiter out. Of a text its first ``LEADING`` characters are looked at; ``sample_rows=None`` reads all lines. Fields are
    counted per file and column map-side, so a shuffle carries one row per column
    of each attempt.
    """
    marks = [F.struct(F.lit(i).alias("attempt"), F.lit(m).alias("mark")) for i, m in enumerate(DELIMITERS)]
    whole = F.concat(F.lit("\n"), F.regexp_replace(leading_lines(F.col(text)) if sample_rows is not None else F.col(text), "\r\n?", "\n"))
    head = F.substring_index(F.ltrim("text", F.lit("\n")), "\n", 1)
    # The header must hold the delimiter; a quoted field may carry it past the first line end.
    tried = (
        files.select(F.col(path).alias("path"), whole.alias("text"))
        .select("path", "text", head.alias("head"))
        .select("path", "text", F.explode(F.filter(F.array(*marks), lambda d: F.contains("head", d["mark"]) | (
            F.contains("head", F.lit('"')) & F.contains("text", d["mark"])))).alias("d"))
        .select("path", F.col("d.attempt").alias("attempt"), F.col("d.mark").alias("delimiter"), "text")
    )
    blanks = F.when(F.col("delimiter") == "\t", F.lit(" ")).otherwise(F.lit(" \t"))
    lines = F.filter(F.split(_by_delimiter(_shielded), "\n"), lambda line: F.btrim(line, blanks) != "")
    sampled = tried.select("path", "attempt", "delimiter", lines.alias("lines"))
    if sample_rows is not None:
        sampled = sampled.withColumn("lines", F.slice("lines", 1, sample_rows + 1))

    def width(row: int) -> Column:
        return _by_delimiter(lambda mark: F.size(F.split(F.get("lines", F.lit(row)), re.escape(mark))))

    index = F.greatest(F.lit(0), F.coalesce(F.when(F.size("lines") > 1, width(1) - width(0)), F.lit(0)))
    fields = (
        sampled.select("path", "attempt", "delimiter", index.alias("index"), F.posexplode("lines").alias("row", "line"))
        .select("path", "attempt", "delimiter", "row", "index",
                F.posexplode(_by_delimiter(lambda mark: F.split("line", re.escape(mark)))).alias("at", "field"))
        .withColumn("col", F.when(F.col("row") > 0, F.col("at") - F.col("index")).otherwise(F.col("at"))).where("col >= 0")
        .withColumn("field", F.translate("field", COVERS, COVERED))
        .withColumn("field", F.when(F.startswith("field", F.lit('"')), F.btrim("field", F.lit('"'))).otherwise(F.col("field")))
    )
    in_body = F.col("row") > 0
    # Text without a digit is no number; asking first spares prose the failing casts.
    number = F.when(F.col("field").rlike("[0-9]"), parse_number(F.col("field")))
    present = in_body & ~F.col("field").isin(CSV_MISSING)
    columns = fields.groupBy("path", "attempt", "delimiter", "col").agg(
        F.max(F.when(~in_body, F.col("field"))).alias("label"), F.bool_or(~in_body).alias("in_header"),
        F.collect_set(F.when(present, F.col("row"))).alias("filled_rows"),
        F.count(F.when(present & number.isNotNull(), 1)).alias("numbers"),
    )
    accepted = _accepted(columns, ["path", "attempt", "delimiter"])
    best = F.min_by(F.struct(*[c for c in accepted.columns if c not in ("path", "attempt")]), F.col("attempt"))
    return accepted.groupBy("path").agg(best.alias("best")).select("path", "best.*")


def read_text_files(spark: SparkSession, glob: str, leading: int = LEADING, **options) -> DataFrame:
    """The leading lines of text files, hidden ones left out: ``path, text``.

    Files are read by line, split as any scan is; only the splits that may hold the first ``leading`` characters take part, and of each at most as many lines.
    So no task holds more of a file than that, and a line end inside a quoted field is a line end like others here, wherever the file is split.
    """
    own = spark.read.options(**options).text(glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value"
    )
    # A character has four bytes at most, and a line one character at least with its end; ids count from the first line of the task's first split.
    first = own.where(F.col("block") < 4 * leading)
    in_order = Window.partitionBy("path").orderBy("block", "id")
    early = first.withColumn("nth", F.row_number().over(in_order)).where(F.col("nth") <= leading)
    so_far = F.sum(F.length("value") + 1).over(in_order)
    lines = early.withColumn("upto", so_far).where((F.col("upto") <= leading) | (F.col("nth") == 1))
    texts = lines.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("nth", "value"))).alias("lines"))
    return texts.select("path", F.array_join("lines.value", "\n").alias("text"))


def leading_lines(text: Column, leading: int = LEADING) -> Column:
    """The lines of a text that its first characters hold whole, or that many characters of its first line."""
    piece = F.substring(text, 1, leading)
    rest = F.substring_index(piece, "\n", -1)
    cut = F.when(F.length(rest) < F.length(piece), F.left(piece, F.length(piece) - F.length(rest) - 1)).otherwise(piece)
    return F.when(F.length(text) > leading, cut).otherwise(text)


def profile_sources(cells: DataFrame | None, files: DataFrame | None) -> DataFrame:
    """Candidates of many workbooks and text files as one table, in path order at the sink."""
    parts = []
    if cells is not None:
        parts.append(profile_sheets(cells))
    if files is not None:
        parts.append(sniff_delimiters(files).select(
            "path", F.lit("csv").alias("sheet"), F.lit(0).alias("header_row"), "rows", "columns",
            "column_names", "date_like_columns", "numeric_like_columns",
        ))
    return reduce(DataFrame.unionByName, parts)


def profile_folder(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Candidates of everything in a folder as one job: text files (``.csv``, ``.tsv``, ``.txt``) by their delimiter,
    cell tables (``.cells.parquet``) by their sheets. Other and hidden files are left out; ``recursive`` goes into its folders."""
    options = {"recursiveFileLookup": recursive}
    files = read_text_files(spark, folder, pathGlobFilter="*.{csv,tsv,txt}", **options)
    cells = spark.read.options(pathGlobFilter="*.cells.parquet", **options).schema(CELL_SCHEMA).parquet(folder)
    return profile_sources(cells, files)


def candidate_listing(candidates: DataFrame) -> DataFrame:
    """Candidates with their name lists as text: first 20 names, all date-like, first 20 numeric-like."""
    def joined(name: str, first: int | None) -> Column:
        names = F.slice(name, 1, first) if first else F.col(name)
        return F.array_join(names, ", ").alias(name)

    lists = {"column_names": 20, "date_like_columns": None, "numeric_like_columns": 20}
    return candidates.select(*[joined(c, lists[c]) if c in lists else c for c in candidates.columns])
