"""Column names, row and column filters, month dates and whole-table parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from monthpanel.fixed import (
    DATE_COLUMN_PATTERNS, MONTH_COLUMN_PATTERNS, PROXY_KEYWORDS, TRADE_KEYWORDS, YEAR_COLUMN_PATTERNS,
)
from monthpanel.functions.months import (
    general_date, month_from_parts, month_number, month_number_strict, month_of_number, month_start,
)
from monthpanel.functions.numbers import parse_number, to_number
from monthpanel.functions.text import slug_name
from monthpanel.sources.tables import new_folder, stored_at


class MonthParseError(ValueError):
    """A table has no usable month columns."""


def numeric_columns(df: DataFrame, but: list[str] = ()) -> list[str]:
    """Columns of a numeric type, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in but]


def slug_columns(df: DataFrame) -> DataFrame:
    """Rename all columns by slug; two columns with one slug are an error."""
    names = [slug_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"Columns share a name after normalisation: {twice}")
    return df.toDF(*names)


def truncate_to_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Cut a date column to month starts. Order is left to the sink."""
    return df.withColumn(date_col, month_start(F.col(date_col)))


def first_matching_column(columns: list[str], patterns: list[str]) -> str | None:
    """First column whose slug matches any pattern."""
    return next((c for c in columns if any(re.search(p, slug_name(c)) for p in patterns)), None)


def first_existing_column(columns: list[str], wanted: list[str]) -> str | None:
    """First of the wanted names that exists by slug; of columns with one slug the last counts."""
    by_slug = {slug_name(c): c for c in columns}
    return next((by_slug[slug_name(w)] for w in wanted if slug_name(w) in by_slug), None)


def drop_empty_rows(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Drop rows without any value outside the keys."""
    return df.na.drop("all", subset=[c for c in df.columns if c not in keys])


def present_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Non-null count per column: one aggregation, one row to the driver."""
    if not columns:
        return {}
    return df.agg(*[F.count(F.col(c)).alias(c) for c in columns]).first().asDict()


def drop_empty(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Drop rows, then columns, without any value."""
    rows = drop_empty_rows(df, keys)
    counts = present_counts(rows, [c for c in rows.columns if c not in keys])
    return rows.select(*[c for c in rows.columns if c in keys or counts[c] > 0])


def numeric_series_columns(df: DataFrame, min_observations: int = 2, but: list[str] = ("date",)) -> list[str]:
    """Columns with enough numeric values."""
    columns = [c for c in df.columns if c not in but]
    numbers = df.select(*[to_number(F.col(c)).alias(c) for c in columns])
    counts = present_counts(numbers, columns)
    return [c for c in columns if counts[c] >= min_observations]


def proxy_candidates(columns: list[str], keys: list[str] = ()) -> list[str]:
    """Columns whose name contains a composite-target keyword."""
    return [c for c in columns if c != "date" and c not in keys and any(k in c for k in PROXY_KEYWORDS)]


def exogenous_columns(df: DataFrame, target: str, keys: list[str] = ()) -> list[str]:
    """All numeric columns but the target."""
    return numeric_columns(df, but=[target, *keys])


def keep_rows_with_target(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target is present."""
    if target not in df.columns:
        raise ValueError(f"Target column {target!r} is missing")
    return df.na.drop(subset=[target])


def _is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NumericType)


def number_column(df: DataFrame, column: str) -> Column:
    """Numeric columns as double, text columns through the number grammar."""
    return F.col(column).cast("double") if _is_numeric(df, column) else parse_number(F.col(column))


def _date_column(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (DateType, TimestampType, TimestampNTZType)):
        return F.col(column).cast("date")
    return general_date(F.col(column).cast("string"))


def with_month(df: DataFrame, year_col: str | None = None, month_col: str | None = None,
               date_col: str | None = None, on_error: str = "raise", keys: list[str] = (),
               out: str = "date") -> DataFrame:
    """Add the month start: from the date column when any of its values parses, else from year and month.

    "Any" is asked per table: per ``keys`` when given, else for the whole frame,
    as one aggregated flag inside the same query. ``on_error='raise'`` fails the
    query on an unknown month label, ``'null'`` leaves the month empty.
    """
    has_date = bool(date_col) and date_col in df.columns
    has_parts = bool(year_col) and bool(month_col) and {year_col, month_col} <= set(df.columns)
    if not has_date and not has_parts:
        raise MonthParseError("a month needs a date column, or a year and a month column")

    parts = None
    if has_parts:
        label = F.col(month_col)
        if _is_numeric(df, month_col):
            month = month_of_number(label.cast("double"))
            if on_error == "raise":
                text = label.cast("string")
                month = F.coalesce(month, month_number_strict(text))
        else:
            month = (month_number_strict if on_error == "raise" else month_number)(label)
        year = number_column(df, year_col)
        parts = F.when(year.isNotNull(), month_from_parts(year.cast("int"), month))
    if not has_date:
        return df.withColumn(out, parts)

    dates = month_start(_date_column(df, date_col))
    any_date = F.coalesce(F.bool_or(dates.isNotNull()), F.lit(False))
    missing = F.raise_error(F.lit("a month needs a date column, or a year and a month column")).cast("date")
    fallback = parts if has_parts else missing
    if not keys:
        flag = df.select(any_date).scalar()
        return df.withColumn(out, F.when(flag, dates).otherwise(fallback))
    flags = df.groupBy(*keys).agg(any_date.alias("__any_date"))
    return (
        df.join(flags, list(keys), "left")
        .withColumn(out, F.when(F.col("__any_date"), dates).otherwise(fallback))
        .drop("__any_date")
    )


def sum_by_month(df: DataFrame, values: list[str], keys: list[str] = (), date_col: str = "date") -> DataFrame:
    """Sum per key and month; a group without any value stays null."""
    return df.groupBy(*keys, date_col).agg(*[F.sum(v).alias(v) for v in values])


def generic_monthly(df: DataFrame, prefix: str, include: list[str] = (), exclude: list[str] = (),
                    keys: list[str] = (), folder: str | None = None) -> DataFrame:
    """Monthly sums of the numeric columns of a table with a date or year and month columns.

    Columns are kept by substring of their slug and renamed ``<prefix>_<slug>``;
    columns without any number are dropped.

    The table is read once: sums and counts per key and per month as each column that may date a row says it are written to
    ``folder`` (or a new one), and which columns date the rows, which hold numbers and whether a key has any date is decided on those few rows.
    """
    table = slug_columns(drop_empty_rows(df, keys))
    include, exclude = [slug_name(w) for w in include], [slug_name(w) for w in exclude]
    columns = [c for c in table.columns if c not in keys]
    patterns = [DATE_COLUMN_PATTERNS, YEAR_COLUMN_PATTERNS, MONTH_COLUMN_PATTERNS]
    may_date, may_year, may_month = ([c for c in columns if first_matching_column([c], p)] for p in patterns)
    dating = list(dict.fromkeys([*may_date, *may_year, *may_month]))
    wanted = [
        c for c in columns
        if (not include or any(w in c for w in include)) and not any(w in c for w in exclude)
    ]
    # An unknown label of a month is kept, for the tables that turn out to need it.
    said = {f"__date_{i}": month_start(_date_column(table, c)) for i, c in enumerate(may_date)}
    said |= {f"__year_{i}": number_column(table, c).cast("int") for i, c in enumerate(may_year)}
    unknown = {}
    for i, c in enumerate(may_month):
        label = F.col(c).cast("string")
        number = month_of_number(F.col(c).cast("double")) if _is_numeric(table, c) else F.lit(None).cast("int")
        number = F.coalesce(number, month_number(label))
        said |= {f"__month_{i}": number}
        unknown |= {f"__unknown_{i}": F.max(F.when(number.isNull(), label))}
    facts = {f"__any_{i}": F.count(F.col(c)) for i, c in enumerate(dating)}
    facts |= {f"__number_{i}": F.count(number_column(table, c)) for i, c in enumerate(wanted)}
    facts |= {f"__sum_{i}": F.sum(number_column(table, c)) for i, c in enumerate(wanted)}
    monthly = table.groupBy(*keys, *[c.alias(n) for n, c in said.items()]).agg(*[c.alias(n) for n, c in (facts | unknown).items()])
    monthly = stored_at(monthly, folder or new_folder(df.sparkSession, "monthly"))

    counts = monthly.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in facts if not n.startswith("__sum")]).first()
    present = [c for i, c in enumerate(dating) if counts[f"__any_{i}"] > 0]
    date_col, year_col, month_col = (first_matching_column(present, p) for p in patterns)
    values = {i: c for i, c in enumerate(wanted) if counts[f"__number_{i}"] > 0 and c not in (date_col, year_col, month_col)}
    missing = F.raise_error(F.lit("a month needs a date column, or a year and a month column")).cast("date")
    by_parts = missing
    if year_col and month_col:
        year, at = F.col(f"__year_{may_year.index(year_col)}"), may_month.index(month_col)
        label = F.col(f"__unknown_{at}")
        month = F.when(label.isNotNull(), F.raise_error(F.concat(F.lit("no month: "), label)).cast("int")).otherwise(F.col(f"__month_{at}"))
        by_parts = F.when(year.isNotNull(), month_from_parts(year, month))
    if date_col is None and not (year_col and month_col):
        raise MonthParseError("a month needs a date column, or a year and a month column")
    if not values:
        raise ValueError("No numeric value columns found")
    dated = monthly
    month = by_parts
    if date_col is not None:
        date = F.col(f"__date_{may_date.index(date_col)}")
        any_date = F.coalesce(F.max(date.isNotNull()).over(Window.partitionBy(*keys)), F.lit(False))
        dated = monthly.withColumn("__dated", any_date)
        month = F.when(F.col("__dated"), date).otherwise(by_parts)
    sums = dated.withColumn("__at", month).where("__at is not null")
    return sums.groupBy(*keys, F.col("__at").alias("date")).agg(*[F.sum(f"__sum_{i}").alias(f"{prefix}_{c}") for i, c in values.items()])


def trade_by_product(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Trade-by-product table: the generic reader with fixed keywords (provisional)."""
    return generic_monthly(df, "trade", include=TRADE_KEYWORDS, keys=keys)


def standardize_monthly(df: DataFrame, value_columns: dict[str, str], date_col: str | None = None,
                        year_col: str | None = None, month_col: str | None = None,
                        keys: list[str] = ()) -> DataFrame:
    """Canonical monthly frame: chosen columns renamed, coerced and summed per month."""
    table = slug_columns(df)
    names = [slug_name(c) if c else None for c in (year_col, month_col, date_col)]
    dated = with_month(table, *names, keys=keys, out="__month")
    wanted = {slug_name(s): slug_name(d) for s, d in value_columns.items()}
    found = {s: d for s, d in wanted.items() if s in table.columns}
    numbers = dated.select(
        *keys, F.col("__month").alias("date"),
        *[number_column(table, s).alias(d) for s, d in found.items()],
    ).where("date is not null")
    return sum_by_month(numbers, list(found.values()), keys) if found else numbers


def year_range(df: DataFrame, first: int = 1990, last: int = 2035, date_col: str = "date") -> DataFrame:
    """Rows whose year lies in a window."""
    return df.where(F.year(date_col).between(first, last))
