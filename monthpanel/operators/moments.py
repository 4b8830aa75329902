"""Counts, means and co-moments of many columns per key, as arrays that add up.

Every task turns its rows into one array of p x p centred products per key (a matrix product of each Arrow batch, combined with what the key has so
far), so the plan has the same size for 2 and for 500 columns. The arrays are added in two rounds, first among a part of
the tasks, then all, so that one key with most of the rows costs a few arrays a task. Centred products lose nothing to large means.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

# In how many parts arrays are added first, and how many numbers a task holds of keys that are not written yet.
PARTS, HELD = 64, 4_000_000
ONE = "__one"


@dataclass
class Moments:
    """Rows, means and centred products of one key."""

    n: int
    mean: np.ndarray
    product: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return cls(len(rows), mean, centred.T @ centred)

    def add(self, other: Moments) -> None:
        n, step = self.n + other.n, other.mean - self.mean
        self.product = self.product + other.product + np.outer(step, step) * (self.n * other.n / n)
        self.mean = self.mean + step * (other.n / n)
        self.n = n


Held = dict[tuple, Moments]
Finish = Callable[[pa.Schema, Held], pa.RecordBatch]


def _grouped(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Key values and row numbers of each key in a batch; null is a value."""
    codes = [batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy() for k in keys]
    _, first, where = np.unique(np.column_stack(codes), axis=0, return_index=True, return_inverse=True)
    names = [batch.column(k).take(pa.array(first)).to_pylist() for k in keys]
    order = np.argsort(where.ravel(), kind="stable")
    bounds = np.searchsorted(where.ravel()[order], np.arange(len(first) + 1))
    for g, key in enumerate(zip(*names)):
        yield key, order[bounds[g] : bounds[g + 1]]


def as_rows(schema: pa.Schema, held: Held) -> pa.RecordBatch:
    """Keys with their moments."""
    keys = [f for f in schema if f.name not in ("n", "mean", "product")]
    columns = [pa.array([k[i] for k in held], f.type) for i, f in enumerate(keys)]
    lists = [pa.array([m.mean.tolist() for m in held.values()], pa.list_(pa.float64())), pa.array([m.product.ravel().tolist() for m in held.values()], pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays([*columns, pa.array([m.n for m in held.values()], pa.int64()), *lists], names=[*(f.name for f in keys), "n", "mean", "product"])


def _partials(keys: list[str], columns: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Held = {}
        most = max(1, HELD // (len(columns) + 1) ** 2)
        schema = None
        for batch in batches:
            schema = pa.schema([batch.schema.field(k) for k in keys])
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
            for key, places in _grouped(batch, keys):
                own = Moments.of(rows[places])
                if key in held:
                    held[key].add(own)
                else:
                    held[key] = own
                if len(held) > most:
                    yield as_rows(schema, held)
                    held = {}
        if held:
            yield as_rows(schema, held)

    return run


def _added(keys: list[str], finish: Finish) -> Callable:
    """Adds the moments of each key; rows come sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Held = {}
        schema, last = None, None
        for batch in batches:
            schema = pa.schema([batch.schema.field(k) for k in keys])
            n = batch.column("n").to_pylist()
            mean = batch.column("mean").flatten().to_numpy().reshape(len(n), -1)
            product = batch.column("product").flatten().to_numpy().reshape(len(n), mean.shape[1], mean.shape[1])
            for i, key in enumerate(zip(*[batch.column(k).to_pylist() for k in keys])):
                own = Moments(n[i], mean[i], product[i])
                if key == last:
                    held[key].add(own)
                    continue
                if len(held) >= max(1, HELD // (mean.shape[1] + 1) ** 2):
                    yield finish(schema, held)
                    held = {}
                held[key], last = own, key
        if held:
            yield finish(schema, held)

    return run


def with_key(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The frame with a constant key where there is none."""
    return (df, list(keys)) if keys else (df.withColumn(ONE, F.lit(1)), [ONE])


def join_by_key(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null is a key like others; the keys are those of ``left``."""
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(right.withColumnsRenamed(names), on, how).drop(*names.values())


def comoments(df: DataFrame, columns: list[str], keys: list[str] = (), finish: Finish = as_rows, schema: str | None = None) -> DataFrame:
    """``keys, n, mean, product`` of the rows that have all ``columns``: means, and the p x p sums of centred products row by row.

    ``finish`` turns the moments of many keys into rows of ``schema`` instead, in the same pass; without keys ``__one`` is the key.
    """
    source, ids = with_key(df, keys)
    numbers = source.select(*ids, *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]).na.drop(subset=[f"v{i}" for i in range(len(columns))])
    own = [f for f in numbers.schema.fields if f.name in ids]
    lists = [StructField("mean", ArrayType(DoubleType())), StructField("product", ArrayType(DoubleType()))]
    moments = StructType([*own, StructField("n", LongType()), *lists])
    partial = numbers.mapInArrow(_partials(ids, [f"v{i}" for i in range(len(columns))]), moments)
    partial = partial.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    first = ["__part", *ids]
    in_parts = StructType([StructField("__part", IntegerType()), *moments.fields])
    added = partial.repartition(*first).sortWithinPartitions(*first).select(*first, "n", "mean", "product").mapInArrow(_added(first, as_rows), in_parts)
    result = added.drop("__part").repartition(*ids).sortWithinPartitions(*ids).mapInArrow(_added(ids, finish), schema or moments)
    return result
