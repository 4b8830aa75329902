"""Models per key: one fit for each series, all keys in one job.

The co-moments of features and target (:mod:`monthpanel.operators.moments`) are all that ridge and elastic net need: standardised by themselves,
they give the penalised normal equations, solved for many keys at once in the pass that adds them. Ridge by leave-one-out also
sees the train rows of a key once more, for their leverages; these are at most as many as there are months, as a panel has one row per key and month.

Missing features are filled with the key's train median; a feature without variance has weight 0. A key too short for the holdout has no
predictions and a status that says so.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from monthpanel.operators.baselines import TRAINED, mark_holdout, score_forecasts, union_predictions
from monthpanel.operators.learn import ELASTIC_ALPHA, ELASTIC_L1_RATIO, RIDGE_ALPHA, RIDGE_ALPHAS
from monthpanel.operators.moments import Held, comoments, join_by_key
from monthpanel.operators.quantiles import exact_quantiles
from monthpanel.operators.trees import boosted, forest
from monthpanel.sources.tables import new_folder, stored_at

# Rounds of coordinate descent at most, and the largest step, in deviations of the target, at which it ends.
ROUNDS, STILL = 20_000, 1e-12


def _standard(n: np.ndarray, mean: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram matrix of z-scores, their products with the centred target, one over the features' deviations (0 without variance), the target's deviation."""
    spread = np.sqrt(np.maximum(np.diagonal(product, axis1=1, axis2=2), 0.0) / n[:, None])
    varies = spread > 1e-12 * np.abs(mean)
    inverse = np.divide(1.0, spread, out=np.zeros_like(spread), where=varies)[:, :-1]
    gram = product[:, :-1, :-1] * inverse[:, :, None] * inverse[:, None, :]
    return gram, product[:, :-1, -1] * inverse, inverse, spread[:, -1]


def ridge(n: np.ndarray, gram: np.ndarray, moment: np.ndarray, spread: np.ndarray, alpha: float = RIDGE_ALPHA) -> np.ndarray:
    """Weights of z-scores that minimise ``|y - Zw|^2 + alpha |w|^2``, one row per key."""
    return np.linalg.solve(gram + alpha * np.eye(gram.shape[1]), moment[:, :, None])[:, :, 0]


def elastic_net(n: np.ndarray, gram: np.ndarray, moment: np.ndarray, spread: np.ndarray, alpha: float = ELASTIC_ALPHA,
                ratio: float = ELASTIC_L1_RATIO) -> np.ndarray:
    """Weights that minimise ``|y - Zw|^2 / 2n + alpha (ratio |w|_1 + (1 - ratio) / 2 |w|^2)`` by coordinate descent on the Gram matrices.

    Keys that stand still leave the loop.
    """
    keys, p = moment.shape
    weights = np.zeros((keys, p))
    left = np.arange(keys)
    gram, moment = gram / n[:, None, None], moment / n[:, None]
    for _ in range(ROUNDS):
        g, w = gram[left], weights[left]
        before = w.copy()
        for j in range(p):
            rest = moment[left, j] - np.einsum("kj,kj->k", g[:, j], w) + g[:, j, j] * w[:, j]
            w[:, j] = np.sign(rest) * np.maximum(np.abs(rest) - alpha * ratio, 0.0) / (g[:, j, j] + alpha * (1 - ratio))
        weights[left] = w
        left = left[np.abs(w - before).max(axis=1, initial=0.0) > STILL * np.maximum(spread[left], 1e-300)]
        if not len(left):
            break
    return weights


SOLVERS = {"ridge_lagged": ridge, "elasticnet_lagged": elastic_net}


def _model_schema(train: DataFrame, keys: list[str], *more: StructField) -> StructType:
    own = [f for f in train.schema.fields if f.name in keys]
    return StructType([*own, *more, StructField("rows", LongType()), StructField("intercept", DoubleType()), StructField("weights", ArrayType(DoubleType()))])


def _solved(models: list[str]) -> Callable:
    """The models of many keys: a row for each key and model, with weights of the raw features."""

    def finish(schema: pa.Schema, held: Held) -> pa.RecordBatch:
        n = np.array([m.n for m in held.values()], float)
        mean, product = np.stack([m.mean for m in held.values()]), np.stack([m.product for m in held.values()])
        gram, moment, inverse, spread = _standard(n, mean, product)
        columns: list[list] = [[] for _ in range(len(schema) + 4)]
        for model in models:
            weights = SOLVERS[model](n, gram, moment, spread) * inverse
            intercept = mean[:, -1] - np.einsum("kj,kj->k", weights, mean[:, :-1])
            for column, values in zip(columns, [*zip(*held), [model] * len(n), n.astype(int).tolist(), intercept.tolist(), weights.tolist()]):
                column.extend(values)
        kinds = [*(f.type for f in schema), pa.string(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*schema.names, "model", "rows", "intercept", "weights"])

    return finish


def fit_linear(train: DataFrame, target: str, features: list[str], keys: list[str], models: list[str]) -> DataFrame:
    """``keys, model, rows, intercept, weights``: each model fitted to each key's rows."""
    schema = _model_schema(train, keys, StructField("model", StringType()))
    return comoments(train, [*features, target], keys, _solved(models), schema)


def _left_out(keys: list[str], p: int, alphas: list[float]) -> Callable:
    """Of a key's train rows and its moments: the ridge with the alpha of least squared left-out error."""

    def choose(rows: pa.Table, moments: pa.Table) -> pa.Table:
        names = [*keys, "alpha", "rows", "intercept", "weights"]
        if not moments.num_rows:
            kinds = [*(rows.schema.field(k).type for k in keys), pa.float64(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
            return pa.table([pa.array([], k) for k in kinds], names=names)
        values = np.column_stack([rows.column(f"v{i}").to_numpy() for i in range(p + 1)])
        n, mean = moments.column("n")[0].as_py(), np.array(moments.column("mean")[0].as_py())
        gram, moment, inverse, _ = (x[0] for x in _standard(np.array([n], float), mean[None], np.array(moments.column("product")[0].as_py()).reshape(1, p + 1, p + 1)))
        z, y = (values[:, :-1] - mean[:-1]) * inverse, values[:, -1] - mean[-1]
        sizes, vectors = np.linalg.eigh(gram)
        shrink = 1.0 / (np.clip(sizes, 0.0, None)[:, None] + np.array(alphas)[None, :])
        u, m = z @ vectors, vectors.T @ moment
        rest = 1.0 - 1.0 / n - (u * u) @ shrink
        errors = np.where(rest > 1e-12, (y[:, None] - u @ (m[:, None] * shrink)) / np.maximum(rest, 1e-12), np.inf)
        best = int(np.argmin((errors**2).mean(axis=0)))
        weights = vectors @ (m * shrink[:, best]) * inverse
        kinds = [*(moments.schema.field(k).type for k in keys), pa.float64(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
        found = [*(moments.column(k)[0].as_py() for k in keys), alphas[best], n, float(mean[-1] - weights @ mean[:-1]), weights.tolist()]
        return pa.table([pa.array([x], k) for x, k in zip(found, kinds)], names=names)

    return choose


def fit_left_out_ridge(train: DataFrame, target: str, features: list[str], keys: list[str], alphas: list[float] = RIDGE_ALPHAS) -> DataFrame:
    """``keys, alpha, rows, intercept, weights``: ridge per key with the alpha chosen by leave-one-out over the key's rows."""
    columns = [*features, target]
    moments = comoments(train, columns, keys)
    rows = train.select(*keys, *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]).na.drop(subset=[f"v{i}" for i in range(len(columns))])
    both = rows.groupBy(*keys).cogroup(moments.groupBy(*keys))
    return both.applyInArrow(_left_out(list(keys), len(features), list(alphas)), _model_schema(train, keys, StructField("alpha", DoubleType())))


def apply_linear(rows: DataFrame, models: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """Rows with the models of their key and ``prediction``."""
    values = F.array(*[F.col(c).cast("double") for c in features])
    terms = F.aggregate(F.zip_with(values, F.col("weights"), lambda x, w: x * w), F.lit(0.0), lambda a, b: a + b)
    return join_by_key(rows, models, list(keys)).withColumn("prediction", F.col("intercept") + terms).drop("weights", "intercept", "rows")


def fill_medians(marked: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """Marked rows with missing features filled by the median of the key's train rows, or 0 where the key has no value."""
    train = marked.where("part = 'train'")
    long = train.select(*keys, *[F.col(c).cast("double").alias(c) for c in features]).unpivot(list(keys), features, "feature", "v")
    found = exact_quantiles(long, "v", [0.5], [*keys, "feature"])
    medians = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("feature", F.get("quantiles", F.lit(0))))).alias("__medians"))
    filled = {c: F.coalesce(F.col(c).cast("double"), F.try_element_at("__medians", F.lit(c)), F.lit(0.0)) for c in features}
    return join_by_key(marked, medians, list(keys), "left").withColumns(filled).drop("__medians")


def keyed_contest(frame: DataFrame, target_name: str, features: list[str], test_size: int, keys: list[str], models: list[str],
                  target: str = "__target__", panel: DataFrame | None = None, impute: bool = False, options: dict[str, dict] | None = None,
                  folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Comparison (with status) and long predictions of a model per key on a supervised frame.

    ``models`` are ``ridge_lagged``, ``elasticnet_lagged``, ``ridge`` (leave-one-out), ``random_forest`` and ``gradient_boosting``; ``options``
    has parameters of the last two (:mod:`monthpanel.operators.trees`). Keys of ``panel``, or of the frame, that are too short for a train row are in the
    comparison with the reason and without metrics. The marked frame, which every model reads, is stored in ``folder`` or a new one.
    """
    if not keys:
        raise ValueError("a model per key needs keys")
    folder = folder or new_folder(frame.sparkSession, "contest")
    marked = mark_holdout(frame.select(*keys, "date", F.col(target).cast("double").alias("__y"), *features), test_size, keys)
    marked = stored_at(marked, f"{folder}/marked")
    lengths = marked.groupBy(*keys).agg((F.max("train_rows") > 0).alias("__fits"))
    rows = marked.where("train_rows > 0").drop("step", "train_rows")
    rows = stored_at(fill_medians(rows, features, keys), f"{folder}/filled") if impute else rows
    train, test = (rows.where(F.col("part") == part).drop("part") for part in ("train", "test"))
    made = []
    if linear := [m for m in models if m in SOLVERS]:
        made.append(apply_linear(test, fit_linear(train, "__y", features, keys, linear), features, keys))
    if "ridge" in models:
        fitted = fit_left_out_ridge(train, "__y", features, keys).drop("alpha")
        made.append(apply_linear(test, fitted, features, keys).withColumn("model", F.lit("ridge")))
    for model, grown in (("random_forest", forest), ("gradient_boosting", boosted)):
        if model in models:
            tests = grown(rows, features, "__y", keys, **(options or {}).get(model, {}))
            made.append(tests.withColumnRenamed("y", "__y").withColumn("model", F.lit(model)))
    predictions = union_predictions([
        m.select(*keys, "date", F.lit(target_name).alias("target"), "model", F.col("__y").alias("actual"), "prediction") for m in made
    ])
    known = (panel if panel is not None else frame).select(*keys).distinct()
    short = F.lit(f"skipped: Not enough supervised rows for test_size={test_size}.")
    status = join_by_key(known, lengths, list(keys), "left").select(
        *keys, F.explode(F.array(*[F.lit(m) for m in models])).alias("model"), F.when(F.col("__fits"), TRAINED).otherwise(short).alias("status")
    )
    return join_by_key(status, score_forecasts(predictions, keys), [*keys, "model"], "left"), predictions
