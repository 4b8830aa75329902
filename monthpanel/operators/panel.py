"""Merging monthly frames and the strict panel contract.

Monthly frames hold one row per key and month, so a key never has more rows than
there are months. The windows below rely on that bound: raw rows are aggregated
to months (with map-side combine, which also folds hot keys) before any of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.fixed import PANEL_START
from monthpanel.functions.months import month_start
from monthpanel.functions.numbers import to_number
from monthpanel.operators.clean import truncate_to_month

def month_mean(df: DataFrame, keys: list[str] = (), date_col: str = "date") -> DataFrame:
    """One row per key and month: the mean of each column's numeric values. Rows without a date drop out.

    Text columns end up without values, as nothing in them is a number.
    """
    if date_col not in df.columns:
        raise ValueError(f"the frame has no column {date_col!r}")
    values = [c for c in df.columns if c != date_col and c not in keys]
    if not values:
        raise ValueError("the frame has only keys and a date")
    return df.where(F.col(date_col).isNotNull()).groupBy(*keys, month_start(F.col(date_col)).alias(date_col)).agg(
        *[F.avg(to_number(F.col(c))).alias(c) for c in values]
    )


def first_in_order(value: Column, order: Column) -> Column:
    """First non-null value of a group in row order, as one aggregate."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def first_per_month(df: DataFrame, values: list[str], order: str, keys: list[str] = ()) -> DataFrame:
    """First non-null value of every column per key and month."""
    return df.groupBy(*keys, "date").agg(
        *[first_in_order(F.col(v), F.col(order)).alias(v) for v in values]
    )


def merge_monthly(frames: list[DataFrame | None], keys: list[str] = (), unique_months: bool = True,
                  skip_empty: bool = False, on_collision: str = "suffix") -> DataFrame:
    """Full outer merge of monthly frames on keys and month.

    Frames that hold one row per key and month are stacked and folded by one
    aggregation: one shuffle however many frames there are, and a repeated month
    fails the query. With ``unique_months=False`` repeated months multiply, as an
    outer join does.
    ``skip_empty`` leaves out the columns of frames without rows (one small job each).
    ``on_collision`` says what happens to a value column that several frames have: ``suffix`` (``_x`` for the
    first, ``_y`` for the second, none for the third, then ``_4``), ``coalesce`` (first non-null in order) or ``error``.
    """
    if on_collision not in ("suffix", "coalesce", "error"):
        raise ValueError(f"Unknown collision rule: {on_collision!r}")
    used = [f for f in frames if f is not None and not (skip_empty and f.isEmpty())]
    if any("date" not in f.columns for f in used):
        raise ValueError("a frame to merge has no column 'date'")
    if not used:
        raise ValueError("nothing to merge: every frame is empty")
    on = [*keys, "date"]
    used, merged = _apart(used, on, on_collision)
    columns = [c for f in used for c in f.columns if c not in on]
    months = [truncate_to_month(f) for f in used]
    if not unique_months:
        joined = reduce(lambda left, right: left.join(right, on, "full_outer"), months)
        return joined.select(*on, *[F.coalesce(*parts).alias(c) for c, parts in merged.items()])
    marked = [f.withColumn("__frame", F.lit(i)) for i, f in enumerate(months)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    folded = stacked.groupBy(*on).agg(
        *[F.max(c).alias(c) for c in columns],
        (F.count("*") == F.size(F.collect_set("__frame"))).alias("__unique"),
    )
    repeated = F.raise_error(F.lit("a frame repeats a month; pass unique_months=False to multiply its rows"))
    checked = folded.select(*on, *[
        F.when(F.col("__unique"), F.col(c)).otherwise(repeated.cast(folded.schema[c].dataType)).alias(c) for c in columns
    ])
    return checked.select(*on, *[F.coalesce(*parts).alias(c) for c, parts in merged.items()])


def _apart(frames: list[DataFrame], on: list[str], on_collision: str) -> tuple[list[DataFrame], dict[str, list[str]]]:
    """Frames with value columns of their own names, and from which of them each merged column comes."""
    owners: dict[str, list[int]] = {}
    for i, f in enumerate(frames):
        for c in f.columns:
            if c not in on:
                owners.setdefault(c, []).append(i)
    shared = [c for c, at in owners.items() if len(at) > 1]
    if shared and on_collision == "error":
        raise ValueError(f"Several frames have the value columns {shared}")
    names = {}
    for c, at in owners.items():
        for place, i in enumerate(at, 1):
            tail = {1: "_x", 2: "_y", 3: ""}.get(place, f"_{place}") if on_collision == "suffix" else f"__{place}"
            names[i, c] = c + tail if len(at) > 1 else c
    if len(set(names.values())) < len(names):
        raise ValueError("Merged columns would share a name; rename them before merging")
    renamed = [f.withColumnsRenamed({c: names[i, c] for c in f.columns if c not in on}) for i, f in enumerate(frames)]
    if on_collision == "coalesce":
        return renamed, {c: [names[i, c] for i in at] for c, at in owners.items()}
    return renamed, {n: [n] for n in names.values()}


def to_long(df: DataFrame, values: list[str], keys: list[str] = ()) -> DataFrame:
    """Wide monthly frame as ``keys, date, series, value``, missing values left out."""
    wide = df.select(*keys, "date", *[F.col(v).cast("double").alias(v) for v in values])
    return wide.unpivot([*keys, "date"], values, "series", "value").where("value is not null")


def to_wide(long: DataFrame, series: list[str], keys: list[str] = ()) -> DataFrame:
    """Long observations as one column per series, the mean where a month repeats."""
    return long.groupBy(*keys, "date").pivot("series", series).agg(F.avg("value"))


def month_bounds(start: str, end: str) -> int:
    """Number of months from start to end, both included."""
    (y0, m0), (y1, m1) = ([int(p) for p in str(d)[:7].split("-")] for d in (start, end))
    months = (y1 - y0) * 12 + m1 - m0 + 1
    if months < 1:
        raise ValueError("the end lies before the start")
    return months


def _bound(df: DataFrame, value: str | None, pick) -> Column:
    """A literal month, or the first/last month of the frame as a scalar subquery."""
    if value is not None:
        return month_start(F.lit(str(value)).cast("date"))
    return df.select(pick(F.col("date"))).scalar()


def month_spine(df: DataFrame, start: str | None = None, end: str | None = None,
                keys: list[str] = ()) -> DataFrame:
    """Every month from start to end for every key, missing months with empty values.

    Rows outside the bounds vanish; a key with only such rows still gets its
    empty months; rows without a date don't exist. Each row covers the months up
    to the next one, so the spine needs one window by key and no join. Open
    bounds are those of the whole frame, which is read once more for them. A
    repeated month fails the query.
    """
    if start is not None and end is not None:
        month_bounds(start, end)
    values = [c for c in df.columns if c != "date" and c not in keys]
    monthly = truncate_to_month(df.where("date is not null"))
    first, last = _bound(monthly, start, F.min), _bound(monthly, end, F.max)
    by_key = Window.partitionBy(*keys).orderBy("date")
    repeated = F.raise_error(F.lit("a month repeats; aggregate to months first")).cast("date")
    covered = monthly.select(
        *keys, *values, F.col("date").alias("__at"), first.alias("__first"), last.alias("__last"),
        (F.row_number().over(by_key) == 1).alias("__head"),
        F.lead("date").over(by_key).alias("__next"),
    ).select(
        *keys, *values, "__at",
        F.when(F.col("__head"), F.col("__first")).otherwise(F.greatest("__first", "__at")).alias("__from"),
        F.when(F.col("__next") == F.col("__at"), repeated).otherwise(
            F.least("__last", F.coalesce(F.add_months("__next", -1), "__last"))).alias("__to"),
    ).where("__from <= __to")
    months = covered.select(*keys, "__at", *values, 
                            F.explode(F.sequence("__from", "__to", F.expr("interval 1 month"))).alias("date"))
    here = F.col("date") == F.col("__at")
    return months.select(*keys, "date", *[F.when(here, F.col(v)).alias(v) for v in values])


def missing_and_extra_months(df: DataFrame, start: str, end: str, keys: list[str] = ()) -> DataFrame:
    """Months that lack a row and rows outside the month sequence: ``kind, keys, date``."""
    days = df.select(*keys, F.col("date").cast("date").alias("date")).distinct()
    on_start = F.col("date") == month_start(F.col("date"))
    seen = days.groupBy(*keys, month_start(F.col("date")).alias("date")).agg(F.bool_or(on_start).alias("__seen"))
    gaps = month_spine(seen, start, end, keys).where("not coalesce(__seen, false)")
    inside = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    extra = days.where(~inside | ~on_start)
    return gaps.select(F.lit("missing").alias("kind"), *keys, "date").unionByName(
        extra.select(F.lit("extra").alias("kind"), *keys, "date")
    )


def missing_months(df: DataFrame, column: str, start: str, end: str | None = None,
                   keys: list[str] = ()) -> DataFrame:
    """Months of a window in which one required column has no value."""
    if column not in df.columns:
        raise ValueError(f"{column!r} is no column of the panel")
    spine = month_spine(df.select(*keys, "date", column), start, end, keys)
    return spine.where(F.col(column).isNull()).select(*keys, "date")


def check_coverage(df: DataFrame, column: str, start: str, end: str | None = None,
                   keys: list[str] = (), shown: int = 20) -> None:
    """Raise with the first missing months when a required column has gaps."""
    gaps = missing_months(df, column, start, end, keys).orderBy("date").limit(shown).collect()
    if gaps:
        listed = [str(r["date"]) for r in gaps]
        raise ValueError(f"{column!r} lacks months of the window, the first of them {listed}")


def missing_counts(spine: DataFrame, columns: list[str]) -> Column:
    """Missing months per column as a map, one aggregate over a spine."""
    pairs = [x for c in columns for x in (F.lit(c), F.count(F.when(F.col(c).isNull(), 1)))]
    return F.create_map(*pairs)


def panel_report(df: DataFrame, start: str = PANEL_START, end: str | None = None,
                 columns: list[str] | None = None, required: list[str] = (),
                 drop_incomplete: bool = True, keys: list[str] = ()) -> DataFrame:
    """What the strict panel keeps and why, as one row.

    ``expected_rows`` counts the months of every key. A column is complete when
    no key misses a month of it.
    """
    prepared = month_mean(df, keys)
    candidates = _candidates(prepared, columns, required, keys)
    spine = month_spine(prepared.select(*keys, "date", *candidates), start, end, keys)
    facts = spine.agg(
        F.min("date").alias("start"), F.max("date").alias("end"), F.count("*").alias("rows"),
        missing_counts(spine, candidates).alias("missing_by_column"),
    )
    missing = F.col("missing_by_column")
    order = F.array(*map(F.lit, candidates))
    dropped = F.filter(order, lambda c: F.element_at(missing, c) > 0)
    none = F.slice(order, 1, 0)
    kept = F.array_except(order, dropped) if drop_incomplete else order
    months = F.floor(F.months_between("end", "start")).cast("long") + 1
    return facts.select(
        "start", "end", months.alias("expected_months"), "rows", kept.alias("selected_columns"),
        (dropped if drop_incomplete else none).alias("dropped_columns"), "missing_by_column",
        F.forall(kept, lambda c: F.element_at(missing, c) == 0).alias("is_complete"),
    )


def _candidates(prepared: DataFrame, columns: list[str] | None, required: list[str],
                keys: list[str]) -> list[str]:
    present = [c for c in prepared.columns if c != "date" and c not in keys]
    absent = [c for c in required if c not in present]
    if absent:
        raise ValueError(f"the input lacks the required columns {absent}")
    unknown = [c for c in columns or [] if c not in present]
    if unknown:
        raise ValueError(f"the input lacks the requested columns {unknown}")
    return list(dict.fromkeys([*(present if columns is None else columns), *required]))


def strict_panel(df: DataFrame, start: str = PANEL_START, end: str | None = None,
                 columns: list[str] | None = None, required: list[str] = (),
                 drop_incomplete: bool = True, keys: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Complete monthly panel and its one-row report.

    The column decision reads one row of counts; the panel itself stays lazy.
    """
    prepared = month_mean(df, keys)
    candidates = _candidates(prepared, columns, required, keys)
    report = panel_report(df, start, end, columns, required, drop_incomplete, keys)
    facts = report.first()
    if not facts["rows"]:
        raise ValueError("the end lies before the start")
    missing = facts["missing_by_column"]
    if any(missing[c] for c in required):
        holes = {c: missing[c] for c in required if missing[c]}
        # Fixed value: the first four words.
        raise ValueError(f"Required columns are not complete over the panel period: {holes}")
    holes = {c: missing[c] for c in candidates if missing[c]}
    if holes and not drop_incomplete:
        raise ValueError(f"columns have gaps within the panel: {holes}")
    selected = [c for c in candidates if c not in holes]
    if not selected:
        raise ValueError("every column has gaps within the panel")
    spine = month_spine(prepared.select(*keys, "date", *selected), str(facts["start"]), str(facts["end"]), keys)
    return spine, report


def strict_series(long: DataFrame, start: str, end: str, keys: list[str] = ()) -> DataFrame:
    """Long-form panel: of every key, the series that have a value in each month.

    The decision is per key and series and needs no driver round trip.
    """
    expected = month_bounds(start, end)
    by_series = [*keys, "series"]
    months = (
        long.where(month_start(F.col("date")).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .groupBy(*by_series, month_start(F.col("date")).alias("date"))
        .agg(F.avg(to_number(F.col("value"))).alias("value"))
        .where("value is not null")
    )
    counted = months.withColumn("__months", F.count("*").over(Window.partitionBy(*by_series)))
    return counted.where(F.col("__months") == expected).drop("__months")


def panel_violations(df: DataFrame, start: str, end: str, keys: list[str] = ()) -> DataFrame:
    """Breaches of the complete-panel contract: ``kind, keys, date, column``; none for a valid panel.

    Kinds are ``missing`` and ``extra`` months, ``duplicate`` dates and ``null`` values. All are read off one
    aggregation by key and date: a month is missing between two that are there, before the first or after the last.
    """
    month_bounds(start, end)
    values = [c for c in df.columns if c != "date" and c not in keys]
    days = df.withColumn("date", F.col("date").cast("date")).groupBy(*keys, "date").agg(
        F.count("*").alias("__rows"),
        F.array(*[
            F.struct(F.lit(c).alias("column"), F.count(F.when(F.col(c).isNull(), 1)).cast("int").alias("n")) for c in values
        ]).alias("__nulls"),
    )
    first, last = (month_start(F.lit(str(d)).cast("date")) for d in (start, end))
    in_window = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    good = F.when((F.col("date") == month_start(F.col("date"))) & F.col("date").between(first, last), F.col("date"))
    by_key = Window.partitionBy(*keys)
    before = F.last("__good", ignorenulls=True).over(by_key.orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    placed = days.withColumn("__good", good).select(
        "*", before.alias("__before"), F.max("__good").over(by_key).alias("__latest"),
        (F.row_number().over(by_key.orderBy("date")) == 1).alias("__once"),
    )
    ahead = F.add_months(first, -1)

    def gap(after: Column, until: Column, where: Column) -> Column:
        """Months strictly between two, told by a row for which ``where`` holds."""
        begin, stop = F.add_months(after, 1), F.add_months(until, -1)
        months = F.when(where & (begin <= stop), F.sequence(begin, stop, F.expr("interval 1 month")))
        return F.transform(F.coalesce(months, F.array().cast("array<date>")), lambda d: breach("missing", d))

    def breach(kind: str, date: Column, column: Column | None = None) -> Column:
        name = F.lit(None).cast("string") if column is None else column
        return F.struct(F.lit(kind).alias("kind"), date.alias("date"), name.alias("column"))

    def when(kind: str, condition: Column) -> Column:
        return F.filter(F.array(breach(kind, F.col("date"))), lambda _: F.coalesce(condition, F.lit(False)))

    here = F.col("__good").isNotNull()
    breaches = F.concat(
        gap(F.coalesce("__before", ahead), F.col("__good"), here),
        gap(F.coalesce("__latest", ahead), F.add_months(last, 1), F.col("__once")),
        when("extra", ~in_window | (F.col("date") != month_start(F.col("date")))),
        when("duplicate", F.col("__rows") > 1),
        *([F.flatten(F.transform("__nulls", lambda x: F.array_repeat(breach("null", F.col("date"), x["column"]), x["n"])))] if values else []),
    )
    return placed.select(*keys, F.explode(breaches).alias("b")).select("b.kind", *keys, "b.date", "b.column")


def validate_panel(df: DataFrame, start: str, end: str, keys: list[str] = ()) -> None:
    """Raise with the first breaches of the complete-panel contract."""
    if "date" not in df.columns:
        raise ValueError("a panel needs the column 'date'")
    expected = month_bounds(start, end)
    if not keys and df.isEmpty():
        raise ValueError(f"an empty panel, where {expected} months were expected")
    found = panel_violations(df, start, end, keys).orderBy("kind", "date").limit(10).collect()
    if found:
        shown = [(r["kind"], str(r["date"]), r["column"]) for r in found]
        raise ValueError(f"months differ from the {expected} expected ones: {shown}")
