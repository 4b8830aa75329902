"""Monthly table scans and sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from monthpanel.functions.numbers import null_if_nan

# Not in the CSV reader's own type inference: a schema keeps the scan to one pass.
_FORMATS = {"csv": {"header": True}, "parquet": {}}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make missing floats NULL, once, at the scan."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(
        *[null_if_nan(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


def read_monthly(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 fmt: str = "csv") -> DataFrame:
    """Scan a monthly table; give a schema for CSV so that ``date`` is typed without inference."""
    if fmt not in _FORMATS:
        raise ValueError(f"Unsupported file type: {fmt}")
    reader = spark.read.format(fmt).options(**_FORMATS[fmt])
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", True)
    return nan_to_null(reader.load(path))


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", by: list[str] | None = None) -> None:
    """Dataset sink. ``by`` names low-cardinality columns to lay the files out by."""
    if fmt not in _FORMATS:
        raise ValueError(f"Unsupported file type: {fmt}")
    writer = df.write.mode("overwrite").options(**_FORMATS[fmt])
    if by:
        writer = writer.partitionBy(*by)
    writer.format(fmt).save(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``, which executors share; a local session without one gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return f"{(base or tempfile.mkdtemp()).rstrip('/')}/panel-{name}-{uuid.uuid4().hex}"


def stored_at(df: DataFrame, folder: str | None) -> DataFrame:
    """The frame, written to a folder of the caller and read from there if one is given."""
    if folder is None:
        return df
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Prediction sink, one folder per model."""
    write_dataset(df, path, fmt, by=["model"])
