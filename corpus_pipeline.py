"""From raw documents to a training mix, in five stages.

Each stage is ``(name, function)``; the function takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``, the last adds those of the mix.

1. Quality: documents that the compression classifier scores under ``REJECTED`` go.
2. Lines: a line of 20 characters that three documents hold stays in the last of them only; ``n_chars`` follows the text.
3. Near-duplicates: of documents linked by 5-word shingles with a similarity of 0.8 the first stays.
4. Decontamination: documents that share a passage with the benchmark go.
5. Mix: sources are repeated to shares by the square root of their size.

Nulls, empty texts, repeated rows and empty tables are treated as each operator's module says; a null text becomes an empty one in stage 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthpanel.llm import compression, decontaminate, line_dedup, mixing, near_duplicates
from monthpanel.llm.shared import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REJECTED = 0.5


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = compression.fit(docs, table(spark, sf_dir, "labels"))
    return compression.score_quality(docs, model).where(F.col("score") >= REJECTED).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.one_of_each(docs).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.replicate(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", filter_quality),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("source mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs


#: The trained dictionaries of the first stage can't be said in SQL; the tests hold the stages after it against SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": (run, ORACLE_SQL)}
