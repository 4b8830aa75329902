"""Line deduplication over all documents, in DataFrame operations only.

Lines are exploded as hashes of their normalised form, the distinct documents of each hash are counted, and a document
gets the positions of its lines over the threshold, from which its other lines are put together again by position.

The text itself is shuffled once, to meet those positions; lines travel as 128-bit hashes. A line that a third of all
documents hold is counted with partial sums, and its join is one that adaptive execution splits, as the table of
repeated lines is stored before.

Nulls: a null text is one empty line. Null ids are one more document, smaller than every other. Rows that repeat an id
are one document for the counts, and each keeps its row. An empty table gives no rows. Extra columns are ignored by
``repeated_lines`` and kept by ``drop_lines``, whatever their names; only ``n_lines`` and ``n_dropped`` replace those of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthpanel.llm.shared import BLANKS, free_names, lower_ascii, stored, table

MIN_CHARS, MIN_DOCS = 20, 3


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("body"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keys = lines.select("id", "body", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keys.select("id", "body", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                   min_docs: int = MIN_DOCS) -> DataFrame:
    """Hashes ``h1, h2`` of lines in at least ``min_docs`` documents, with their number ``docs`` and the ``keeper``, the largest id."""
    once = _lines(docs, id_col, text_col, min_chars).groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
    return once.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("id").alias("keeper")).where(F.col("docs") >= min_docs)


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row with its text less the repeated lines, and ``n_lines`` and ``n_dropped``."""
    repeated = stored(repeated_lines(docs, id_col, text_col, min_chars, min_docs).drop("docs"), "lines")
    gone = _lines(docs, id_col, text_col, min_chars).join(repeated, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
    names = free_names(docs, "gone_id", "gone_body", "gone_lines", "all_lines")
    of, body, dropped, lines = names
    gone = gone.groupBy("id", "body").agg(F.collect_set("pos").alias(dropped)).withColumnsRenamed({"id": of, "body": body})
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.drop("n_lines", "n_dropped").join(
        gone, F.col(id_col).eqNullSafe(F.col(of)) & (F.xxhash64(text) == F.col(body)), "left"
    ).withColumn(lines, F.split(text, "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(dropped))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col(lines), i)), "\n")
    return joined.withColumns({
        text_col: F.when(F.col(dropped).isNull(), text).otherwise(kept),
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(F.size(dropped), F.lit(0)).cast("long"),
    }).drop(*names)


def op8_line_dedup(spark, sf_dir):
    made = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
KEPT_SQL = f"""lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM {{docs}}),
keyed AS (
  SELECT *, translate(trim(line, {_CHARS}), '{_UPPER}', '{_LOWER}') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, pos, line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone
  FROM keyed k LEFT JOIN repeated r USING (key)),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id)"""
SQL = f"""WITH {KEPT_SQL.format(docs="documents")}
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept"""

QUERIES = {"op8_line_dedup": (op8_line_dedup, SQL)}
