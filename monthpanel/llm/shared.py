"""What the operators share: tables, the shared folder, words, splits by document id."""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

_own_folder: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if "path" not in _own_folder:
        _own_folder["path"] = tempfile.mkdtemp(prefix="llm-")
    return f"file://{_own_folder['path']}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: computed once, lineage cut, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until ``df`` has no such column: for columns that come and go beside the caller's."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, other letters left; the fast way for texts of one byte per character."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words_of(text: Column) -> Column:
    """Words between white space, as an array; none for null, empty or blank text."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) > 0, F.split(bare, BLANK_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))
