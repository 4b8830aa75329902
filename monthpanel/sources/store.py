"""Panels kept between runs: sinks that are safe to rerun, tables bucketed by key, scans that keep what they could not read.

A committed table is a folder of data folders and a manifest, a small table with a row for each part and version. A write adds a new data
folder and, when that is complete, the manifest of the next version as one file; readers take the parts that the last version names. So a
write that dies leaves the table as it was, a part (a model, say) is replaced alone, and a reader never sees half of a write.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthpanel.functions.months import general_date, month_number, month_start
from monthpanel.functions.numbers import parse_number
from monthpanel.sources.tables import new_folder, stored_at

_MANIFEST = "version long, writer string, part string, folder string"


def _parts(spark: SparkSession, path: str) -> list:
    """The parts of the last committed version, and its number; none where nothing was committed."""
    from pyspark.errors import AnalysisException

    try:
        manifests = spark.read.schema(_MANIFEST).parquet(f"{path}/manifests")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    last = manifests.agg(F.max("version")).first()[0]
    rows = manifests.where(F.col("version") == last).collect() if last is not None else []
    if len({r["writer"] for r in rows}) > 1:
        raise ValueError(f"two writers committed version {last} of {path}; write one of them again")
    return rows


def write_committed(df: DataFrame, path: str, by: str | None = None) -> int:
    """Write a frame as the next version and return its number. With ``by`` only the parts (values of that column) in the
    frame are replaced, else the whole table."""
    spark = df.sparkSession
    before = _parts(spark, path)
    version = 1 + max((r["version"] for r in before), default=0)
    writer = uuid.uuid4().hex
    folder = f"data-{version}-{writer}"
    df.write.parquet(f"{path}/{folder}")
    parts = [None]
    if by is not None:
        # As many values as there are parts: the column that lays out the sink.
        parts = [r[0] for r in spark.read.schema(df.schema).parquet(f"{path}/{folder}").select(F.col(by).cast("string")).distinct().collect()]
    kept = [(version, writer, r["part"], r["folder"]) for r in before if by is not None and r["part"] not in parts]
    rows = kept + [(version, writer, part, folder) for part in parts]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifests")
    return version


def read_committed(spark: SparkSession, path: str, schema: StructType | str, by: str | None = None) -> DataFrame:
    """The last committed version; one scan of the folders that it names."""
    rows = _parts(spark, path)
    if not rows:
        raise ValueError(f"nothing was committed in {path}")
    folders: dict[str, list] = {}
    for r in rows:
        folders.setdefault(r["folder"], []).append(r["part"])
    data = spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in sorted(folders)])
    if by is None:
        return data
    # A folder that was partly replaced still holds the old rows of other parts.
    own = F.col("_metadata.file_path")
    text = F.col(by).cast("string")
    wanted = [own.contains(f"/{f}/") & reduce(lambda a, b: a | b, [text.eqNullSafe(F.lit(p)) for p in parts]) for f, parts in folders.items()]
    return data.where(reduce(lambda a, b: a | b, wanted))


def write_panel(sources: dict[str, DataFrame], table: str, path: str, keys: list[str], buckets: int) -> None:
    """Save monthly sources as one table, dealt to files by key, sorted, and laid out by source, so that merging them and windows by key need
    no exchange, and reading some sources reads no other. ``buckets`` should follow the size of the largest source. Tables by source would not
    do: a union or an outer join of them forgets how they lie."""
    if not keys:
        raise ValueError("buckets need keys")
    names = [c for df in sources.values() for c in df.columns if c not in (*keys, "date")]
    if len(set(names)) < len(names) or "source" in (*keys, *names):
        raise ValueError("sources of a panel must not share value columns, nor have one named source")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("source", F.lit(n)) for n, df in sources.items()])
    dealt = stacked.repartition(buckets, *keys)
    dealt.write.partitionBy("source").bucketBy(buckets, *keys).sortBy(*keys, "date").mode("overwrite").option("path", path).format("parquet").saveAsTable(table)


def read_panel(spark: SparkSession, table: str, keys: list[str], sources: list[str] | None = None) -> DataFrame:
    """The sources of a stored panel merged by key and month, without an exchange; a source that repeats a month fails the query."""
    rows = spark.table(table)
    if sources is not None:
        rows = rows.where(F.col("source").isin(sources))
    values = [c for c in rows.columns if c not in (*keys, "date", "source")]
    unique = F.count("*") == F.size(F.collect_set("source"))
    folded = rows.groupBy(*keys, "date").agg(*[F.max(c).alias(c) for c in values], unique.alias("__unique"))
    repeated = F.raise_error(F.lit("a source repeats a month"))
    return folded.select(*keys, "date", *[F.when(F.col("__unique"), F.col(c)).otherwise(repeated.cast(folded.schema[c].dataType)).alias(c) for c in values])


def _typed(kind: str, text: Column) -> Column:
    if kind == "number":
        return parse_number(text)
    if kind == "date":
        return general_date(text)
    if kind == "month":
        return month_start(general_date(text))
    if kind == "month_label":
        return month_number(text)
    if kind == "text":
        return text
    raise ValueError(f"no kind of column: {kind!r}")


def scan_with_rejects(spark: SparkSession, path: str, columns: dict[str, str], required: list[str] = (), sep: str = ",",
                      folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Delimited files as typed rows, and a table of what was rejected: ``file, row, column, text, reason``.

    ``columns`` gives the kind of each (``number``, ``date``, ``month``, ``month_label``, ``text``), in the files' order. A text that is none of its kind
    becomes null in its row and a reject (``not a number``); a required value that is absent takes its row out (``missing``). Files
    are read and typed once, into ``folder`` or a new one. ``row`` is the row of the file, from 1 after the header, counted over its
    splits from a small table of their rows.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.schema(schema).options(header=True, sep=sep, mode="PERMISSIVE").csv(path)
    absent = {c: F.coalesce(F.trim(F.col(c)), F.lit("")) == "" for c in columns}
    made = {c: _typed(kind, F.col(c)) for c, kind in columns.items()}
    problems = [
        F.when(~absent[c] & made[c].isNull(), F.struct(F.lit(c).alias("column"), F.col(c).alias("text"), F.lit(f"not a {kind}").alias("reason")))
        for c, kind in columns.items() if kind != "text"
    ] + [F.when(absent[c], F.struct(F.lit(c).alias("column"), F.col(c).alias("text"), F.lit("missing").alias("reason"))) for c in required]
    none = F.array().cast("array<struct<column:string,text:string,reason:string>>")
    read = raw.select(
        *[v.alias(c) for c, v in made.items()], F.filter(F.array(*problems), lambda p: p.isNotNull()).alias("__rejects") if problems else none.alias("__rejects"),
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"),
    )
    written = stored_at(read, folder or new_folder(spark, "scan"))
    # A split is read by one task in order, so the rows of a block are numbered by their ids from its first.
    blocks = written.groupBy("__file", "__block").agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    before = F.sum("__n").over(Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n")
    numbered = written.where(F.size("__rejects") > 0).join(blocks, ["__file", "__block"])
    rejects = numbered.select(
        F.col("__file").alias("file"), (F.col("__before") + F.col("__id") - F.col("__first") + 1).alias("row"), F.inline("__rejects")
    )
    out = F.exists("__rejects", lambda r: r["reason"] == "missing")
    return written.where(~out).select(*columns), rejects
