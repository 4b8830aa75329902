"""Data quality tables: coverage, missing shares, summaries, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.functions.numbers import to_number
from monthpanel.functions.stats import pair_corr
from monthpanel.operators.clean import numeric_columns
from monthpanel.operators.quantiles import exact_quantiles

SUMMARY = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


def dataset_shape(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows, columns and date range, as one row."""
    return df.agg(
        F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"),
        F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
    )


def missing_pct(df: DataFrame, top: int | None = 25, columns: list[str] | None = None) -> DataFrame:
    """Percentage of missing values per column, highest first; ``top`` is the report's length."""
    columns = columns or df.columns
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns])
    long = shares.unpivot([], columns, "column", "missing_pct")
    return long.orderBy(F.desc("missing_pct"), "column").limit(top) if top else long


def value_counts(df: DataFrame, column: str, keys: list[str] = ()) -> DataFrame:
    """Rows per value, without missing ones; order by value at the sink."""
    return df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("rows"))


def describe_series(df: DataFrame, value: str, keys: list[str] = (), monthly: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per key.

    ``monthly`` says that a key's rows are its months; then one aggregation does
    it all. Otherwise quartiles come from :func:`exact_quantiles`, which never
    gathers a group in one task.
    """
    v = F.col(value).cast("double")
    parts = [
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    ]
    if monthly:
        stats = df.groupBy(*keys).agg(*parts, F.percentile(v, [0.25, 0.5, 0.75]).alias("q"))
    else:
        on = list(keys) or ["__all"]
        one = {} if keys else {"__all": F.lit(1)}
        quartiles = exact_quantiles(df, value, [0.25, 0.5, 0.75], keys).withColumns(one)
        stats = df.groupBy(*keys).agg(*parts).withColumns(one).join(
            quartiles.select(*on, F.col("quantiles").alias("q")), on, "left"
        )
    return stats.select(
        *keys, "count", "mean", "std", "min",
        *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(["q25", "q50", "q75"])], "max",
    )


def summary_rows(described: DataFrame, keys: list[str] = ()) -> DataFrame:
    """A summary as ``keys, statistic, value`` rows."""
    doubles = described.select(*keys, *[F.col(s).cast("double").alias(s) for s in SUMMARY])
    return doubles.unpivot(list(keys), SUMMARY, "statistic", "value")


def correlations_with_target(df: DataFrame, target: str, keys: list[str] = (), top: int | None = 15) -> DataFrame:
    """Pearson correlation of each other numeric column with the target, strongest first per key."""
    columns = numeric_columns(df, but=["date", target, *keys])
    wide = df.groupBy(*keys).agg(*[
        pair_corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns
    ])
    long = wide.unpivot(list(keys), columns, "feature", "correlation_with_target")
    if top is None:
        return long
    strongest = Window.partitionBy(*keys).orderBy(
        F.abs("correlation_with_target").desc_nulls_last(), "feature"
    )
    return long.withColumn("__rank", F.row_number().over(strongest)).where(F.col("__rank") <= top).drop("__rank")


def column_coverage(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """Observed months per column with the first and last one: one pass, any number of columns."""
    dates = {c: F.when(to_number(F.col(c)).isNotNull(), F.col("date")) for c in columns}
    facts = df.groupBy(*keys).agg(*[
        F.struct(F.count(d).alias("observations"), F.min(d).alias("first_date"), F.max(d).alias("last_date")).alias(c)
        for c, d in dates.items()
    ])
    return facts.unpivot(list(keys), columns, "column", "__facts").select(*keys, "column", "__facts.*")


def latest_values(df: DataFrame, value: str, n: int = 12, keys: list[str] = ()) -> DataFrame:
    """The last n months with a value, per key."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("date"))
    present = df.where(F.col(value).isNotNull()).select(*keys, "date", value)
    return present.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= n).drop("__rank")
