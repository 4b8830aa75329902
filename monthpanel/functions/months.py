"""Months: labels, dates written as text, month starts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthpanel.fixed import DATE_FORMATS, DATE_LOOK, ISO_DATE, MONTH_SPELLINGS, YEAR_FIRST_DATE, YEAR_LAST_DATE
from monthpanel.functions.text import fold_text


def month_start(value: Column) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(value.cast("date"), "MM")


def month_number(label: Column) -> Column:
    """Month 1..12 from a label such as ``Enero``, ``Mar-20``, ``dic`` or ``4``; else null."""
    words = F.trim(F.regexp_replace(fold_text(label), "[^a-z0-9]+", " "))
    # A lone number without its zeros, or the first word of several.
    key = F.regexp_replace(words, "^0*([0-9]+)$|^([a-z]+) .*$", "$1$2")
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in MONTH_SPELLINGS.items() for x in pair]), key)


def month_of_number(value: Column) -> Column:
    """Month 1..12 from a number without a fraction."""
    return F.when((value == F.floor(value)) & value.between(1, 12), value.cast("int"))


def month_number_strict(label: Column) -> Column:
    """As :func:`month_number`, but a label that is present and unknown fails the query."""
    problem = F.raise_error(F.concat(F.lit("no month: "), label)).cast("int")
    return F.coalesce(month_number(label), F.when(label.isNotNull(), problem))


def month_from_parts(year: Column, month: Column) -> Column:
    """Month start from year and month numbers; null when they make no date."""
    text = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), month.cast("string"), F.lit("-1"))
    return text.try_cast("date")


def date_in_text(text: Column) -> Column:
    """Date from ``Y-M``, ``Y-M-D`` or ``M-D-Y`` text with ``-`` or ``/``; day first when it must be."""
    trimmed = F.trim(text)
    part = [F.try_element_at(F.split(trimmed, "[-/]"), F.lit(i)) for i in (1, 2, 3)]
    first, second = part[0].try_cast("int"), part[1].try_cast("int")
    year_first = F.concat_ws("-", part[0], part[1], F.coalesce(part[2], F.lit("1")))
    year_last = F.concat_ws(
        "-", part[2], F.when(first > 12, second).otherwise(first),
        F.when(first > 12, first).otherwise(second),
    )
    return (
        F.when(trimmed.rlike(YEAR_FIRST_DATE), year_first)
        .when(trimmed.rlike(YEAR_LAST_DATE), year_last)
        .try_cast("date")
    )


def general_date(text: Column) -> Column:
    """Date from any text that a date column may hold: ISO with or without a time, the forms of
    :func:`date_in_text`, and the listed formats with month names or without separators."""
    trimmed = F.trim(text)
    listed = F.coalesce(*[F.try_to_timestamp(trimmed, F.lit(f)).cast("date") for f in DATE_FORMATS])
    # A bare cast would take six digits for a year.
    iso = F.when(trimmed.rlike(ISO_DATE), trimmed.try_cast("date"))
    return F.coalesce(iso, date_in_text(text), F.when(trimmed.rlike(DATE_LOOK), listed))


def strict_month(text: Column, ts: Column | None = None, num: Column | None = None,
                 excel_serial: bool = False) -> Column:
    """Month start of a date cell, years 1990..2035 only.

    Real dates and date-like text count; numbers never do, unless
    ``excel_serial`` admits workbook day numbers 30000..60000.
    """
    found = date_in_text(text)
    if ts is not None:
        found = F.coalesce(ts.cast("date"), found)
    if excel_serial and num is not None:
        serial = F.when(
            num.between(30000, 60000),
            F.date_add(F.lit("1899-12-30").cast("date"), F.floor(num).cast("int")),
        )
        found = F.coalesce(found, serial)
    return F.when(F.year(found).between(1990, 2035), month_start(found))
