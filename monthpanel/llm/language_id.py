"""Language identification with bit-sliced Bloom filters of n-grams.

Every language has a Bloom filter of its typical n-grams (four bytes of lower-cased UTF-8, all ASCII but letters taken as one
blank). The filters are bit-sliced: one table of masks of 64-bit words, as many words a slot as the languages need, bit ``l`` of a slot belonging to language ``l``, so
that the AND of the slots of an n-gram is the set of all languages that have it. A text counts the bits of the masks of all its n-grams by language; from each
count what the filter's fill makes by chance is taken off, and the largest corrected count decides.

An n-gram is typical of a language where its rate is at least ``SHARE`` of its highest rate in any language and was seen
``LEAST`` times. Learned from at most ``DOCS`` documents of each language (the smallest by a hash of the id), whose id leaves no
remainder 2. The counts of the sample are added up in Spark and the driver gets the table, of at most ``2 ** MAX_BITS`` slots (32 MB for each 64 languages).
Scoring is one pass in Arrow batches; a text is read in slices of ``SLICE`` bytes.

Nulls and texts without a letter are ``und`` with score 0. Texts with letters but no known n-gram get the most frequent language
with score 0; ties go to the more frequent language. Null languages teach nothing. Rows that repeat count alike. Empty
tables give no rows; without any language all is ``und``. ``identify`` keeps all columns; ``lang_pred`` and ``score`` replace those of that name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.llm.batches import bytes_of
from monthpanel.llm.shared import free_names, id_remainder, stored, table

DOCS, LEAST, SHARE, MAX_BITS, SLICE = 3000, 3, 0.2, 22, 1 << 20
#: Factors of the two slot hashes: odd and below 2 ** 31, so that a product with an n-gram fits 63 bits.
FACTORS = (1640531527, 1013904223)
_FLAT = np.arange(256, dtype=np.uint8)
_FLAT[:128] = ord(" ")
_FLAT[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


@dataclass(frozen=True)
class Filters:
    """Languages by frequency, the table of masks (a row of words for each slot beyond 64 languages), and the chance of each language to be hit by any n-gram."""

    languages: tuple[str, ...]
    masks: np.ndarray
    chance: np.ndarray


def grams_of(text: bytes) -> Iterator[np.ndarray]:
    """The n-grams of a text as integers, slice by slice; a blank is put before and after it."""
    data = np.frombuffer(b" " + text.decode("utf-8", "replace").lower().encode() + b" ", np.uint8)
    for at in range(0, max(0, len(data) - 3), SLICE):
        part = _FLAT[data[at : at + SLICE + 3]].astype(np.uint32)
        yield part[:-3] | part[1:-2] << np.uint32(8) | part[2:-1] << np.uint32(16) | part[3:] << np.uint32(24)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, gram, n``, added up over each batch."""
    for batch in batches:
        data, offsets = bytes_of(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            counted: tuple[np.ndarray, np.ndarray] = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            pending: list[np.ndarray] = []

            def add(last: bool) -> None:
                nonlocal counted
                if pending and (last or sum(map(len, pending)) > 4 * SLICE):
                    grams, n = np.unique(np.concatenate(pending), return_counts=True)
                    both = np.concatenate([counted[0], grams])
                    keys, where = np.unique(both, return_inverse=True)
                    counted = keys, np.bincount(where, np.concatenate([counted[1], n]), len(keys)).astype(np.int64)
                    pending.clear()

            for k, own in enumerate(langs):
                if own == lang:
                    for grams in grams_of(data[offsets[k] : offsets[k + 1]].tobytes()):
                        pending.append(grams)
                        add(False)
            add(True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counted[0])), pa.array(counted[0].astype(np.int64)), pa.array(counted[1])], names=["lang", "gram", "n"]
            )


def learn_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters from documents with a language, of all languages."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (id_remainder(F.col(id_col), 4) != 2))
    known = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    languages = tuple(r.lang for r in sizes)
    if not languages:
        return Filters((), np.zeros(1, np.uint64), np.zeros(0))
    # Of each language a share by hash that holds some four times the wanted number is ranked, so no rank is over all of a language.
    place, parts = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)), 1 << 30
    share = F.coalesce(*[F.when(F.col("lang") == r.lang, F.lit(int(parts * min(1.0, 4 * DOCS / r.n)))) for r in sizes])
    by_hash = Window.partitionBy("lang").orderBy("place", "id")
    some = known.select("id", "lang", place.alias("place")).where(F.col("place") < share)
    ids = some.withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= DOCS)
    sample = known.join(F.broadcast(ids.select("id", "lang").distinct()), ["id", "lang"]).select("lang", "text")
    counts = sample.mapInArrow(_count_grams, "lang string, gram bigint, n bigint")
    wide = counts.groupBy("gram").agg(*[F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{k}") for k, lang in enumerate(languages)])
    wide = stored(wide, "grams")
    totals = wide.agg(F.count("*").alias("grams"), *[F.sum(f"n{k}").alias(f"n{k}") for k in range(len(languages))]).first()
    rates = [F.col(f"n{k}") / F.lit(float(totals[f"n{k}"] or 1)) for k in range(len(languages))]
    highest = F.greatest(*rates) if len(rates) > 1 else rates[0]
    words = [F.lit(0).cast("long")] * -(-len(languages) // 64)
    for k, rate in enumerate(rates):
        typical = (F.col(f"n{k}") >= LEAST) & (rate >= F.lit(SHARE) * highest)
        words[k // 64] = words[k // 64].bitwiseOR(F.when(typical, F.shiftleft(F.lit(1).cast("long"), k % 64)).otherwise(F.lit(0).cast("long")))
    names = [f"mask{w}" for w in range(len(words))]
    bits = int(min(MAX_BITS, max(10, np.ceil(np.log2(16 * max(totals["grams"], 1))))))
    slots = F.array(*[F.shiftright((F.col("gram") * f).bitwiseAND(0xFFFFFFFF), 32 - bits) for f in FACTORS])
    own = wide.select(*[word.alias(name) for word, name in zip(words, names)], F.explode(slots).alias("slot")).where(" OR ".join(f"{x} <> 0" for x in names))
    filled = own.groupBy("slot").agg(*[F.bit_or(x).alias(x) for x in names]).toPandas()
    masks = np.zeros((1 << bits, len(words)), np.int64)
    masks[filled["slot"].to_numpy(np.int64)] = filled[names].to_numpy(np.int64)
    masks = masks.view(np.uint64)
    fill = np.array([(masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).mean() for k in range(len(languages))])
    masks = masks[:, 0] if len(words) == 1 else masks
    return Filters(languages, masks, fill ** len(FACTORS))


def scorer(filters: Filters) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """Function of Arrow batches: number of the language and its share of all corrected counts."""
    bits, languages = int(np.log2(len(filters.masks))), len(filters.languages)
    # With few languages every AND of two masks is a small number of its own; else bits are counted one by one.
    small = languages <= 12
    masks = filters.masks.astype(np.uint16) if small else filters.masks.reshape(len(filters.masks), -1)
    member = (np.arange(1 << languages)[:, None] >> np.arange(languages) & 1) if small else None
    shift = np.uint32(32 - bits)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data, offsets = bytes_of(batch)
            best, share = np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for k, (begin, end) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                hits, total = np.zeros(languages), 0
                for grams in grams_of(data[begin:end].tobytes()):
                    found = masks[grams * np.uint32(FACTORS[0]) >> shift] & masks[grams * np.uint32(FACTORS[1]) >> shift]
                    total += len(grams)
                    if small:
                        hits += np.bincount(found, minlength=1 << languages) @ member
                    else:
                        hits += [int((found[:, j // 64] >> np.uint64(j % 64) & np.uint64(1)).sum()) for j in range(languages)]
                real = np.maximum(0, (hits - total * filters.chance) / np.maximum(1e-9, 1 - filters.chance))
                best[k] = int(np.argmax(real))
                share[k] = real[best[k]] / real.sum() if real.sum() > 0 else 0.0
            yield pa.StructArray.from_arrays([pa.array(best), pa.array(share)], names=["best", "share"])

    return score


def identify(docs: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``."""
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if not filters.languages:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    found = F.arrow_udf(scorer(filters), "best int, share double")(F.coalesce(F.col(text_col), F.lit("")))
    names = F.array(*[F.lit(x) for x in filters.languages])
    (both,) = free_names(docs, "found")
    return docs.withColumn(both, found).withColumns({
        "lang_pred": F.when(letters, F.get(names, F.col(f"`{both}`.best"))).otherwise("und"),
        "score": F.when(letters, F.col(f"`{both}`.share")).otherwise(0.0),
    }).drop(both)


def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    found = identify(docs.select("doc_id", "text"), learn_filters(docs))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {"op3_language_id": (op3_language_id, None)}
