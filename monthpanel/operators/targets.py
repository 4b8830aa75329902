"""The catalog of forecast targets and the choice among observed ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthpanel.fixed import TARGET_CATALOG
from monthpanel.functions.numbers import to_number
from monthpanel.operators.clean import numeric_series_columns, present_counts
from monthpanel.operators.quality import column_coverage


def target_catalog(spark: SparkSession) -> DataFrame:
    """All known targets: ``column, label, description, unit, priority``."""
    schema = "column string, label string, description string, unit string, priority int"
    return spark.createDataFrame(TARGET_CATALOG, schema)


def title_label(name: Column) -> Column:
    """Title-cased words of a column name."""
    return F.initcap(F.translate(name, "_", " "))


def target_label(name: str) -> str:
    """Catalog label of a column, else its title-cased name."""
    labels = {entry[0]: entry[1] for entry in TARGET_CATALOG}
    return labels.get(name, name.replace("_", " ").title())


def available_targets(df: DataFrame, keys: list[str] = (), min_observations: int = 2) -> DataFrame:
    """Catalog targets with enough observations, per key; order by priority at the sink."""
    columns = [entry[0] for entry in TARGET_CATALOG if entry[0] in df.columns]
    catalog = target_catalog(df.sparkSession)
    if not columns:
        # The schema of a frame with targets, without rows.
        ids = [F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys]
        return catalog.limit(0).select(
            *ids, "column", "label", "description", "unit", "priority", F.lit(None).cast("long").alias("observations")
        )
    coverage = column_coverage(df, columns, keys).where(F.col("observations") >= min_observations)
    return coverage.join(F.broadcast(catalog), "column").select(
        *keys, "column", "label", "description", "unit", "priority", "observations"
    )


def label_columns(coverage: DataFrame) -> DataFrame:
    """Add a display label to a table with a ``column`` column. The catalog has 15 rows."""
    catalog = target_catalog(coverage.sparkSession).select("column", F.col("label").alias("__label"))
    return coverage.join(F.broadcast(catalog), "column", "left").withColumn(
        "label", F.coalesce("__label", title_label(F.col("column")))
    ).drop("__label")


def default_target(df: DataFrame, keys: list[str] = ()) -> str:
    """The available target of highest priority, else the first numeric column that is no key (one row of counts read)."""
    df = df.drop(*keys)
    known = {entry[0]: entry[4] for entry in TARGET_CATALOG if entry[0] in df.columns}
    numbers = df.select(*[to_number(F.col(c)).alias(c) for c in known])
    counts = present_counts(numbers, list(known))
    good = [c for c in known if counts[c] >= 2]
    if good:
        return min(good, key=known.get)
    numeric = numeric_series_columns(df)
    if not numeric:
        raise ValueError("The frame has no numeric column to forecast")
    return numeric[0]


def validate_target(df: DataFrame, target: str, min_observations: int = 2, keys: list[str] = ()) -> None:
    """Raise when a target is absent or too sparse."""
    if target not in df.columns:
        available = ", ".join(numeric_series_columns(df.drop(*keys), min_observations))
        raise ValueError(f"Target {target!r} is missing from the frame, which has the numeric columns: {available}")
    observed = present_counts(df.select(to_number(F.col(target)).alias(target)), [target])[target]
    if observed < min_observations:
        raise ValueError(
            f"Target {target!r} has only {observed} observations and needs {min_observations}"
        )
