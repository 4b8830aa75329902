"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A passage is shared where a window of ``SPAN`` words of the item stands at a window of the document so that, of the item's words from
``AROUND`` before to ``AROUND`` after it (cut at the item's ends), at least ``SIMILARITY`` stand at the same place in the document: 13 of 16
words inside an item, 10 of 12 at its ends. None is missed: a seed says which positions count, the others may hold any word, and in any
such 8 to 16 words one of ``SEEDS`` lies on equal words only (the tests try all placements). So the hits of the seeds' hashes, benchmark with
documents, are all candidates, and each is verified on every window whose words include the seed. A lower similarity would miss some and is refused.

Items of fewer than ``SPAN`` words are found word for word: the hash of the whole item meets the hashes of as many words at every place of the
documents, and the words themselves are compared. Items of fewer than ``SHORT`` words are parts of clean texts too, so they are found only in documents
that have no other words.

The benchmark's seeds are stored, counted and joined in blocks of about ``BLOCK`` rows; each block is broadcast, a bound
of some 60 MB, and hits are verified where they are found, so no text is shuffled and a passage that a third of the
documents hold costs its hits only. A benchmark beyond the bound takes more blocks, each one scan.

Nulls and texts without words have no windows and are never hit. Rows that repeat an id are one
document or item. Empty tables give no rows. Extra columns are ignored by ``overlaps`` and kept by ``decontaminate``, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthpanel.llm.shared import free_names, stored, table, words_of

SPAN, AROUND, SIMILARITY, SHORT, BLOCK = 8, 4, 0.8, 3, 250_000
#: Positions with 1 are compared. Of 8 to 16 words of which 80 % are equal, one of these lies on equal words somewhere.
SEEDS = ("11101", "1100111")
#: The windows that include a seed, with the words around them, reach from ``BEFORE`` words before its first word; ``REACH`` words in all.
BEFORE = SPAN + AROUND
REACH = BEFORE + SPAN + 2 * AROUND


def _seeded(df: DataFrame, keep: str) -> DataFrame:
    """Columns ``keep``, ``wide``, ``at`` and ``h``: a row for each seed and place of the array ``words``.

    ``wide`` has the hashes of all words, with nulls before and after them, so that the ``REACH`` words of a place begin at ``at``. Explode and join are
    one compiled loop over it (so no lambda functions after it is made), which copies it for hits only.
    """
    ends = [F.array_repeat(F.lit(None).cast("int"), n) for n in (BEFORE, REACH - BEFORE)]
    hashed = df.where(F.size("words") >= SPAN).select(keep, F.concat(ends[0], F.transform("words", lambda w: F.hash(w)), ends[1]).alias("wide"))
    least = min(map(len, SEEDS))
    places = hashed.select(keep, "wide", F.explode(F.sequence(F.lit(0), F.size("wide") - (REACH + least))).alias("at"))
    hashes = []
    for m, seed in enumerate(SEEDS):
        words = [F.get("wide", F.col("at") + (BEFORE + k)) for k, x in enumerate(seed) if x == "1"]
        hashes.append(F.when(words[-1].isNotNull(), F.xxhash64(F.lit(m), *words)))
    return places.select(keep, "wide", "at", F.explode(F.array(*hashes)).alias("h")).where(F.col("h").isNotNull())


def _bits(flags: Column) -> Column:
    """Flags of the ``REACH`` words as a number, the last word's in the lowest bit; never null, as a check for nulls would be put into the join."""
    return F.coalesce(F.aggregate(flags, F.lit(0), lambda bits, flag: bits * 2 + F.when(flag, 1).otherwise(0)), F.lit(0))


def _whole_items(texts: DataFrame, items: DataFrame, block: int) -> list[DataFrame]:
    """Columns ``doc, item, same, of`` of the items under ``SPAN`` words that stand in a document word for word, a frame for each block and length."""
    short = items.where(F.size("words").between(1, SPAN - 1)).select(
        F.size("words").alias("n"), F.col("words").alias("wanted"), "item", F.xxhash64("words").alias("h")
    )
    short = stored(short.distinct(), "short-items")
    sizes = sorted((r.n, r["count"]) for r in short.groupBy("n").count().collect())
    found = []
    for n, count in sizes:
        blocks = -(-count // block)
        if n < SHORT:
            places = texts.where(F.size("words") == n).withColumn("around", F.col("words"))
        else:
            starts = F.explode(F.sequence(F.lit(1), F.size("words") - (n - 1)))
            places = texts.where(F.size("words") >= n).select("doc", "words", starts.alias("at")).withColumn("around", F.slice("words", F.col("at"), n))
        places = places.select("doc", "around", F.xxhash64("around").alias("h"))
        for b in range(blocks):
            own = F.broadcast(short.where((F.col("n") == n) & (F.pmod("h", F.lit(blocks)) == b)))
            hits = places.join(own, "h").where(F.col("around") == F.col("wanted"))
            found.append(hits.select("doc", "item", F.lit(n).alias("same"), F.lit(n).alias("of")))
    return found


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """Pairs ``doc, item`` that share a passage, with the most words matched in one place and the best share of them."""
    if similarity < SIMILARITY:
        raise ValueError(f"the seeds find passages with a similarity of {SIMILARITY} or more")
    items = benchmark.select(F.col(item_col).alias("item"), words_of(F.lower(text_col)).alias("words"))
    wanted = F.slice("wide", F.col("at") + 1, REACH).alias("wanted")
    seeds = stored(_seeded(items, "item").select("h", "item", wanted).distinct(), "seeds")
    blocks = max(1, -(-seeds.count() // block))
    texts = docs.select(F.col(id_col).alias("doc"), words_of(F.lower(text_col)).alias("words"))
    places = _seeded(texts, "doc")
    # A window begins at word ``r`` of the REACH words. All conditions name it: one that doesn't would go into the join and end its compiled loop.
    starts = F.array(*[F.lit(r) for r in range(AROUND, REACH - SPAN - AROUND + 1)])
    wide, window = SPAN + 2 * AROUND, f"{(1 << SPAN) - 1}"
    inside = F.expr(f"(shiftright(item_has & doc_has, {REACH - SPAN} - r) & {window}) = {window}")
    same, of = [F.expr(f"bit_count(shiftright({x}, {REACH - SPAN - AROUND} - r) & {(1 << wide) - 1})") for x in ("equal", "item_has")]
    found = [
        places.join(F.broadcast(seeds.where(F.pmod("h", F.lit(blocks)) == b)), "h")
        .select("doc", "item", "wanted", F.slice("wide", F.col("at") + 1, REACH).alias("around"))
        .select(
            "doc", "item", _bits(F.zip_with("around", "wanted", lambda x, y: x == y)).alias("equal"),
            _bits(F.transform("wanted", lambda x: x.isNotNull())).alias("item_has"), _bits(F.transform("around", lambda x: x.isNotNull())).alias("doc_has"),
        )
        .select("*", F.explode(starts).alias("r")).where(inside)
        .select("doc", "item", same.alias("same"), of.alias("of")).where(F.col("same") >= F.lit(similarity) * F.col("of"))
        for b in range(blocks)
    ]
    return reduce(DataFrame.unionAll, [*found, *_whole_items(texts, items, block)]).groupBy("doc", "item").agg(
        F.max("same").cast("long").alias("matched"), F.max(F.col("same") / F.col("of")).alias("similarity")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id") -> DataFrame:
    """The rows of documents that share no passage with the benchmark; rows with a null id are never hit."""
    (name,) = free_names(docs, "hit")
    hit = stored(overlaps(docs, benchmark, id_col, text_col, item_col).select(F.col("doc").alias(name)).distinct(), "leaks")
    return docs.join(hit, F.col(id_col) == F.col(name), "left_anti")


def op5_decontamination(spark, sf_dir):
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "matched", F.round("similarity", 9).alias("similarity"))


_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = f"string_split_regex(trim(lower(text), {_CHARS}), '[\\x20\\x09-\\x0D]+')"


# Any 80 % of 8 to 16 words have three in a row, so places where three words in a row are equal lead to all passages; each is then compared word by word.
PAIRS_SQL = f"""doc_words AS (SELECT doc_id AS id, {_WORDS} AS w FROM {{docs}}),
item_words AS (SELECT item_id AS id, {_WORDS} AS w FROM benchmark),
doc_runs AS (SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM doc_words WHERE len(w) >= 8)),
item_runs AS (SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM item_words WHERE len(w) >= 8)),
shifts AS (
  SELECT DISTINCT d.id AS doc_id, t.id AS item_id, d.i - t.i AS shift FROM doc_runs d JOIN item_runs t USING (run)),
flags AS (
  SELECT doc_id, item_id, shift, len(t.w) AS n, len(d.w) AS m,
         list_transform(range(1, len(t.w) + 1), lambda k: CASE WHEN k + shift >= 1 AND k + shift <= len(d.w) AND d.w[k + shift] = t.w[k] THEN 1 ELSE 0 END) AS same
  FROM shifts JOIN doc_words d ON d.id = doc_id JOIN item_words t ON t.id = item_id),
windows AS (
  SELECT *, greatest(1, place - 4) AS low, least(n, place + 11) AS high
  FROM (SELECT *, unnest(range(1, n - 6)) AS place FROM flags) WHERE place + shift >= 1 AND place + shift + 7 <= m),
verified AS (
  SELECT doc_id, item_id, list_sum(same[low:high]) AS same, high - low + 1 AS of FROM windows
  UNION ALL
  SELECT d.id, t.id, len(t.w), len(t.w) FROM item_words t JOIN doc_words d ON CASE
    WHEN len(t.w) BETWEEN 3 AND 7 THEN contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(t.w, ' ') || ' ')
    ELSE len(t.w) < 3 AND t.w <> [''] AND d.w = t.w END),
pairs AS (
  SELECT doc_id, item_id, max(same)::BIGINT AS matched, round(max(same / of), 9) AS similarity
  FROM verified WHERE same >= 0.8 * of GROUP BY doc_id, item_id)"""
SQL = f"WITH {PAIRS_SQL.format(docs='documents')}\nSELECT * FROM pairs"

QUERIES = {"op5_decontamination": (op5_decontamination, SQL)}
