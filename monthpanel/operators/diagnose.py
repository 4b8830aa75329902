"""Reading contests: best model, residuals, improvements, lag correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from monthpanel.functions.stats import improvement_pct
from monthpanel.operators.clean import numeric_columns
from monthpanel.operators.lag_moments import correlations


def trained_rows(comparison: DataFrame) -> DataFrame:
    """Models that trained and have an RMSE."""
    rows = comparison
    if "status" in comparison.columns:
        rows = rows.where(F.lower(F.col("status").cast("string")) == "trained")
    return rows.where(F.col("rmse").try_cast("double").isNotNull())


def best_model(comparison: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Row of the lowest RMSE per key, ties by model name; keys without a trained model have none."""
    rows = trained_rows(comparison)
    row = F.struct(*comparison.columns)
    order = F.struct(F.col("rmse").try_cast("double"), F.col("model"))
    return rows.groupBy(*keys).agg(F.min_by(row, order).alias("best")).where("best is not null").select("best.*")


def check_best(comparison: DataFrame, keys: list[str] = ()) -> DataFrame:
    """As :func:`best_model`, failing when nothing trained at all."""
    best = best_model(comparison, keys)
    if best.isEmpty():
        raise ValueError("no model was trained and scored")
    return best


def model_predictions(predictions: DataFrame, model: str, check: bool = False) -> DataFrame:
    """Predictions of one model; order by date at the sink."""
    rows = predictions.where(F.col("model") == model).withColumn("date", F.col("date").cast("date"))
    if check and rows.isEmpty():
        raise ValueError(f"model {model!r} has no predictions")
    return rows


def add_residuals(predictions: DataFrame) -> DataFrame:
    """Add actual minus prediction."""
    return predictions.withColumn("residual", F.col("actual") - F.col("prediction"))


def improvements(models: DataFrame, baselines: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Best model against best baseline per key: deltas, percentages and which one wins by RMSE."""
    names = ["model", "rmse", "mae"]
    left = best_model(models, keys).select(*keys, *[F.col(n).alias(f"best_{n}") for n in names])
    right = best_model(baselines, keys).select(*keys, *[F.col(n).alias(f"baseline_{n}") for n in names])
    # Without keys both sides are one row; a constant key keeps this an equi-join.
    on = list(keys) or ["__all"]
    if not keys:
        left, right = left.withColumn("__all", F.lit(1)), right.withColumn("__all", F.lit(1))
    delta = F.col("best_rmse") - F.col("baseline_rmse")
    return left.join(right, on).select(
        *keys, "baseline_model", "baseline_rmse", "baseline_mae", "best_model", "best_rmse", "best_mae",
        delta.alias("rmse_delta"), (F.col("best_mae") - F.col("baseline_mae")).alias("mae_delta"),
        improvement_pct(F.col("baseline_rmse"), F.col("best_rmse")).alias("rmse_improvement_pct"),
        improvement_pct(F.col("baseline_mae"), F.col("best_mae")).alias("mae_improvement_pct"),
        (delta < 0).alias("beats_baseline"),
    )


def lag_correlations(df: DataFrame, target: str, max_lag: int = 12, min_observations: int = 24,
                     keys: list[str] = (), features: list[str] | None = None) -> DataFrame:
    """Correlation of each numeric column, lagged 1..max_lag rows, with the target.

    ``keys, feature, lag, correlation, abs_correlation, observations``. The target
    is a feature too. Pairs need both values; features without variance have no
    row. One exchange by key serves all features and lags; no row is repeated for a lag
    (:mod:`monthpanel.operators.lag_moments`).
    """
    if target not in df.columns:
        raise ValueError(f"no column {target!r} to forecast")
    columns = features or numeric_columns(df, but=["date", *keys])
    values = df.select(
        *keys, "date", F.col(target).cast("double").alias("__target"),
        *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)],
    )
    series = (values.repartition(*keys) if keys else values.coalesce(1)).sortWithinPartitions(*keys, "date")
    own = [f for f in df.select(*keys).schema.fields]
    made = [StructField("feature", StringType()), StructField("lag", IntegerType()), StructField("correlation", DoubleType()),
            StructField("abs_correlation", DoubleType()), StructField("observations", LongType())]
    return series.drop("date").mapInArrow(correlations(list(keys), columns, max_lag, max(1, min_observations)), StructType([*own, *made]))


def top_lag_correlations(correlations: DataFrame, n: int = 10, keys: list[str] = ()) -> DataFrame:
    """The n strongest lag correlations per key, with their rank; ties by feature and lag."""
    strongest = Window.partitionBy(*keys).orderBy(F.desc("abs_correlation"), "feature", "lag")
    return correlations.withColumn("rank", F.row_number().over(strongest)).where(F.col("rank") <= n)
