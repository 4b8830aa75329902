"""Numbers and years written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthpanel.fixed import YEAR_PATTERN


def null_if_nan(value: Column) -> Column:
    """NaN means missing; from here on only NULL does."""
    return F.nanvl(value, F.lit(None).cast("double"))


def parse_number(text: Column) -> Column:
    """Number from Spanish or English formatted text, else null.

    With both separators the last one is the decimal mark. A lone kind of comma
    is decimal when one or two characters follow the last one. Dots alone are
    always decimal marks.
    """
    digits = F.regexp_replace(text, r"[^0-9,.\-]", "")
    decimal_comma = digits.rlike(r"\..*,[^.]*$") | digits.rlike(r"^[^.]*,[^.,]{1,2}$")
    plain = F.when(decimal_comma, F.translate(digits, ",.", ".")).otherwise(
        F.translate(digits, ",", "")
    )
    # A failed cast costs an exception, so what is no number is told apart before.
    return F.when(plain.rlike(r"^-?(\d+\.?\d*|\.\d+)$"), plain.try_cast("double"))


def to_number(value: Column) -> Column:
    """Strict numeric coercion: what is not a plain number is missing."""
    return null_if_nan(value.try_cast("double"))


def year_in_text(text: Column) -> Column:
    """First year 1900..2099 inside a text."""
    return F.nullif(F.regexp_extract(text, YEAR_PATTERN, 0), F.lit("")).cast("int")


def year_of_number(value: Column) -> Column:
    """Whole part of a number when it is a year 1900..2100."""
    whole = F.floor(value)
    return F.when(whole.between(1900, 2100), whole.cast("int"))
