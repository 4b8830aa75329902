"""Ranked lexical search by bags: documents with the same bag of query words and the same length class are scored once.

A text becomes the vector of its words that occur in an item (term numbers and counts), with the number of all its words. Vectors are stored; the
number of documents with a word, of all words and of documents holding each term come from them. A class is a vector and the length
``m``: rows meet by a hash of both, and grouping by the vector itself verifies them, so no two bags are ever taken for one. Of a
class only its ``k`` smallest ids can be among the ``k`` best of an item, as its members score alike; so a class is ranked by id
and cut at ``k`` in each task, then among some tasks, then among all, and a class that a third of all rows share sends ``k`` rows
a task. Classes are scored in NumPy batches against the items that hold their terms, in 64-bit integers; a task keeps the ``k`` best of an
item, and the last ranking has ``k`` rows an item and task.

Items are a stated query set, taken in blocks of at most ``BLOCK_TERMS`` different words, each a scan of the documents; only a block's words
and their counts are on the driver.

Nulls: null texts and items have no words; a document without words counts for nothing, an item without words or matches has no rows.
A null id comes after all others of its score. Empty texts are as null ones, long ones are counted whole. Rows that repeat an id are documents, or
items, of their own. Empty tables give no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthpanel.llm.shared import stored, table

TOP, BLOCK_TERMS = 10, 200_000
#: Scores held at once by a task (classes by items).
CELLS = 8_000_000
_TERM_BYTES = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_FOLDED = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _TERM_BYTES else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_FOLDED).split()


def _vectors(numbers: dict[bytes, int], id_type: pa.DataType) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, terms, tfs, ends = [], [], [], [0]
            for text in batch.column(1).cast(pa.large_binary()).to_pylist():
                found = terms_of(text)
                words.append(len(found))
                own = sorted(Counter(numbers[w] for w in found if w in numbers).items())
                terms += [t for t, _ in own]
                tfs += [n for _, n in own]
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), pa.array(words, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    return count


def _scorer(weights: np.ndarray, bounds: np.ndarray, items: np.ndarray, times: np.ndarray, n_items: int, k: int, id_type: pa.DataType) -> Callable:
    """Postings of term ``t`` are ``items`` and ``times`` from ``bounds[t]`` to ``bounds[t + 1]``. Classes come by their smallest id, so at equal scores the earlier stays."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((k, n_items), np.int64)
        which = np.full((k, n_items), -1, np.int64)
        members: dict[int, list] = {}
        seen, most = 0, max(1, CELLS // max(1, n_items))
        for whole in batches:
            for at in range(0, whole.num_rows, most):
                batch = whole.slice(at, most)
                lists = batch.column("terms")
                lengths = np.diff(lists.offsets.to_numpy())
                terms, tf = lists.flatten().to_numpy().astype(np.int64), batch.column("tfs").flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.arange(batch.num_rows), lengths)
                m = batch.column("m").to_numpy().astype(np.int64)[row]
                value = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                posted = bounds[terms + 1] - bounds[terms]
                scores = np.zeros((batch.num_rows, n_items), np.int64)
                ends = np.cumsum(posted)
                for a, b in _slices(ends, CELLS):
                    reps = posted[a:b]
                    place = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(bounds[terms[a:b]], reps)
                    cell = np.repeat(row[a:b] * n_items, reps) + items[place]
                    np.add.at(scores.reshape(-1), cell, np.repeat(value[a:b], reps) * times[place])
                better = np.flatnonzero(scores.max(axis=0, initial=0) > best[-1])
                if len(better):
                    both = np.concatenate([best[:, better], scores[:, better]])
                    rank = np.argsort(-both, axis=0, kind="stable")[:k]
                    numbers = np.concatenate([which[:, better], np.broadcast_to(np.arange(seen, seen + batch.num_rows)[:, None], (batch.num_rows, len(better)))])
                    best[:, better], which[:, better] = np.take_along_axis(both, rank, 0), np.take_along_axis(numbers, rank, 0)
                    which[best == 0] = -1
                    kept = set(np.unique(which[which >= 0]).tolist())
                    members = {c: ids for c, ids in members.items() if c in kept}
                    new = sorted(c for c in kept if c >= seen)
                    members.update(zip(new, batch.column("members").take(pa.array([c - seen for c in new], pa.int64())).to_pylist()))
                seen += batch.num_rows
        rows = []
        for item in range(n_items):
            left = k
            # Classes of one score share their places by ascending id.
            for s in dict.fromkeys(best[:, item][best[:, item] > 0].tolist()):
                ids = [d for c in which[best[:, item] == s, item].tolist() for d in members[c]]
                ids = sorted(ids, key=lambda d: (d is None, d))[:left]
                left -= len(ids)
                rows += [(item, s, d) for d in ids]
                if not left:
                    break
        if rows:
            item, s, d = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(s, pa.int64()), pa.array(d, id_type)], names=["item", "score", "doc_id"])

    return score


def _slices(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive parts of rows whose sizes add up to ``most`` or so; ``ends`` are running sums of the sizes."""
    at, done = 0, 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield at, to
        at, done = to, int(ends[to - 1])


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Items with their words, so many at a time that they have ``most`` different words or so."""
    block, words = [], set()
    for item, text in items.toLocalIterator():
        own = Counter(terms_of((text or "").encode()))
        if own:
            block.append((item, own))
            words.update(own)
            if len(words) >= most:
                yield block
                block, words = [], set()
    if block:
        yield block


def _search_block(texts: DataFrame, block: list[tuple], item_type: str, k: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    spark, kind = texts.sparkSession, texts.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)
    numbers = {w: i for i, w in enumerate(sorted({w for _, own in block for w in own}))}
    vectors = texts.mapInArrow(_vectors(numbers, arrow), f"doc_id {kind.simpleString()}, n long, terms array<int>, tfs array<int>")
    vectors = stored(vectors.withColumn("task", F.spark_partition_id()), "bags")
    sums = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words"),
                       F.coalesce(F.max("task"), F.lit(0)).alias("tasks")).first()
    held = np.zeros(len(numbers), np.int64)
    for term, docs in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        held[term] = docs
    weights = np.floor(1000 * np.log((2 * sums.docs + 2) / (2 * held + 1))).astype(np.int64)
    postings = sorted((numbers[w], i, times) for i, (_, own) in enumerate(block) for w, times in own.items())
    terms, places, times = (np.array(x, np.int64) for x in zip(*postings))
    bounds = np.searchsorted(terms, np.arange(len(numbers) + 1))

    length = F.expr(f"100 - 75 + (75 * n * {sums.docs}L) div {max(1, sums.words)}L")
    keyed = vectors.where(F.size("terms") > 0).select("doc_id", "task", length.alias("m"), "terms", "tfs")
    # The root of the number of tasks: a group of tasks has as many tasks as there are groups.
    some = F.pmod("task", F.lit(int((sums.tasks + 1) ** 0.5)))
    keyed = keyed.withColumns({"hash": F.xxhash64("m", "terms", "tfs"), "some": some})
    same = ["hash", "m", "terms", "tfs"]
    first = F.row_number().over(Window.partitionBy("some", *same).orderBy(F.col("doc_id").asc_nulls_last()))
    keyed = keyed.withColumn("place", first).where(F.col("place") <= k)
    first = F.row_number().over(Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last()))
    keyed = keyed.withColumn("place", first).where(F.col("place") <= k)
    classes = keyed.groupBy(*same).agg(F.sort_array(F.collect_list(F.struct("place", "doc_id"))).alias("members"))
    classes = classes.select("m", "terms", "tfs", F.col("members.doc_id").alias("members"))
    classes = classes.sortWithinPartitions(F.get("members", F.lit(0)).asc_nulls_last())
    scored = classes.mapInArrow(_scorer(weights, bounds, places, times, len(block), k, arrow), f"item int, score long, doc_id {kind.simpleString()}")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())))
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item int, item_id {item_type}")
    return ranked.where(F.col("rank") <= k).join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of each item."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    kind = wanted.schema["item_id"].dataType.simpleString()
    found = [_search_block(texts, block, kind, k) for block in _blocks(wanted, block_terms)]
    if not found:
        empty = f"item_id {kind}, rank int, doc_id {texts.schema['doc_id'].dataType.simpleString()}, score long"
        return docs.sparkSession.createDataFrame([], empty)
    made = found[0]
    for more in found[1:]:
        made = made.unionByName(more)
    return made


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
SQL = f"""WITH docs AS (
  SELECT doc_id, {_TERMS} AS words FROM documents),
sizes AS (
  SELECT count(*) FILTER (len(words) > 0) AS n_docs, sum(len(words))::BIGINT AS n_words FROM docs),
wanted AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term),
held AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM docs) WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, sizes GROUP BY term),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_words))))::BIGINT AS score
  FROM wanted JOIN held USING (term) JOIN weights USING (term), sizes GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

QUERIES = {"op13_lexical_search": (op13_lexical_search, SQL)}
