"""MinHash near-duplicates with sequential Bayesian verification.

Every whole text is one set of shingle hashes, of which the minima under ``BANDS * ROWS`` hash functions are the signature.
Texts of equal sets are one class from then on, represented by its smallest id, so a group of copies costs as much as one text.
Classes that agree on the ``ROWS`` minima of a band are candidates. They are verified in blocks of at most ``BLOCK`` classes:

- A block compares signatures in batches of ``BATCH`` minima. A pair is pruned as soon as the posterior probability that
  its similarity reaches the threshold is under ``MISS`` (uniform prior; see ``least_matches``). Survivors are verified exactly
  on the full sets, a class against all of the block at a time, and only as long as they aren't connected already.
- First the classes are dealt to blocks by their hub, the smallest leader of their buckets. What is linked there is contracted.
- Then every bucket that still holds several components is finished: its classes form blocks again, large components blocks of
  their own, and each two blocks that share such a bucket meet, except two of one component. So every candidate pair of
  different components is compared, and a large group of near copies is never compared with itself once it is connected.

A pair at the threshold is missed with a probability of about 1e-7 (0.8) or 1e-10 (0.85) by its bands, and of ``MISS`` by pruning.
Nothing is capped: a hub of any size is split in blocks. Links are edges of a spanning forest, never all pairs of a group.

Nulls: null, blank and empty texts have no shingles and are linked with nothing. Rows with a null id are linked with nothing
either; they are kept. Rows that repeat an id are judged each by its own text, and ``one_of_each`` keeps all of them if it keeps one. Ties
can't be, as components are named by their smallest id. Empty tables give no rows. ``near_duplicates`` ignores extra columns, ``one_of_each`` keeps them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthpanel.llm.batches import bytes_of, word_hashes
from monthpanel.llm.components import components
from monthpanel.llm.shared import free_names, stored, table

SHINGLE, PERCENT, BANDS, ROWS, BATCH, MISS, BLOCK = 5, 80, 30, 4, 24, 1e-7, 192
_SIZE = BANDS * ROWS
_RANDOM = np.random.default_rng(20_240_601)
_FACTORS = _RANDOM.integers(0, 2**32, _SIZE, dtype=np.uint32) | np.uint32(1)
_OFFSETS = _RANDOM.integers(0, 2**32, _SIZE, dtype=np.uint32)
_PLACES = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _RANDOM.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit hashes."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words; of fewer words one hash of all."""
    words = text.lower().split()
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64) if words else np.zeros(0, np.uint64)
    hashes = np.fromiter(map(word_hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    return np.unique(_mixed(sum(hashes[k : n + k] * _PLACES[k] for k in range(size))))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of the set under each hash function."""
    least = np.full(_SIZE, 0xFFFFFFFF, np.uint32)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), 512):
        np.minimum(least, (high[at : at + 512, None] * _FACTORS + _OFFSETS).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band."""
    return _mixed((least.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_FACTORS).sum(axis=1))


def sketcher(size: int) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """Function of Arrow batches: number of shingles, a 128-bit name of the set, the keys of the bands."""

    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data, offsets = bytes_of(batch)
            counts, names, keys = [], [], []
            for begin, end in zip(offsets.tolist(), offsets[1:].tolist()):
                shingles = shingle_set(data[begin:end].tobytes(), size)
                counts.append(len(shingles))
                names.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                keys.append(band_keys(signature(shingles)).view(np.int64) if len(shingles) else None)
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(names, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["n_shingles", "name", "keys"],
            )

    return sketch


def least_matches(percent: int, miss: float = MISS) -> dict[int, int]:
    """By number of compared minima, the fewest matches with which a pair is kept.

    With a uniform prior the similarity has the posterior Beta(m + 1, n - m + 1) after m matches of n, and the probability that it is over t
    is that of at most m successes in n + 1 trials of probability t.
    """
    t, found = percent / 100, {}
    for n in range(BATCH, _SIZE + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        found[n] = m
    return found


def link_block(ids: np.ndarray, groups: np.ndarray, sides: np.ndarray, texts: list[bytes], size: int, percent: int) -> list[tuple[int, int]]:
    """Links that connect ``groups`` of the block: pairs of ids whose sets are similar enough, a spanning forest of them.

    With two sides only pairs across are compared.
    """
    sets = [shingle_set(t, size) for t in texts]
    signs = np.array([signature(s) for s in sets])
    keys = np.array([band_keys(s) for s in signs])
    lengths = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts, mark = np.concatenate([[0], np.cumsum(lengths)]), np.zeros(len(flat) + 1, bool)
    _, root = np.unique(groups, return_inverse=True)
    wanted, edges, two = least_matches(percent), [], len(set(sides.tolist())) > 1
    for i in range(len(ids)):
        others = np.flatnonzero((root != root[i]) & (sides != sides[i] if two else np.arange(len(ids)) > i) & (sides >= sides[i]))
        others = others[(keys[others] == keys[i]).any(axis=1)]
        matches = np.zeros(len(others), np.int64)
        for n, least in wanted.items():
            if not len(others):
                break
            matches = matches + (signs[others, n - BATCH : n] == signs[i, n - BATCH : n]).sum(axis=1)
            alive = matches >= least
            others, matches = others[alive], matches[alive]
        if not len(others):
            continue
        own = flat[starts[i] : starts[i + 1]]
        mark[own] = True
        for j in others:
            if root[i] != root[j]:
                both = int(mark[flat[starts[j] : starts[j + 1]]].sum())
                if 100 * both >= percent * (lengths[i] + lengths[j] - both):
                    edges.append((int(ids[i]), int(ids[j])))
                    root[root == root[j]] = root[i]
        mark[own] = False
    return edges


def _linker(size: int, percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def link(block: pd.DataFrame) -> pd.DataFrame:
        texts = [bytes(t) for t in block["body"]]
        found = link_block(block["rep"].to_numpy(), block["part"].to_numpy(), block["side"].to_numpy(), texts, size, percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return link


def _blocks(members: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``block``: classes alike in ``by``, split by a hash so that a block has about ``BLOCK``."""
    sizes = stored(members.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).alias("splits")), "sizes")
    return members.join(sizes, by).withColumn(
        "block", F.xxhash64(*by, F.pmod(F.xxhash64(F.lit("block"), "rep"), F.col("splits")))
    ).drop("splits")


def links(docs: DataFrame, sketches: DataFrame, size: int, percent: int) -> DataFrame:
    """``node, component`` of the linked classes, by their smallest ids."""
    reps = stored(sketches.where("name IS NOT NULL AND id IS NOT NULL").groupBy("name").agg(F.min("id").alias("rep"), F.first("keys").alias("keys")), "classes")
    bands = reps.select("rep", F.posexplode("keys").alias("band", "key")).select("rep", F.xxhash64("band", "key").alias("key"))
    leaders = bands.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader <> last").drop("last")
    member = stored(bands.join(stored(leaders, "leaders"), "key"), "members")
    hubs = stored(_blocks(member.groupBy("rep").agg(F.min("leader").alias("hub")), ["hub"]), "hubs")
    # Candidates grow with the corpus: the join that fetches their texts is a shuffle at every size.
    texts = docs.select(F.col("id").alias("rep"), "text").join(hubs.hint("merge"), "rep")
    texts = texts.withColumn("body", F.col("text").cast("binary")).drop("text")
    texts = stored(texts, "candidates")

    first = texts.select("block", "rep", F.col("rep").alias("part"), F.lit(0).alias("side"), "body")
    near = stored(first.groupBy("block").applyInPandas(_linker(size, percent), "a long, b long"), "near")
    roots = components(near)

    parts = hubs.drop("block").join(roots, F.col("rep") == F.col("node"), "left").select(
        "rep", "hub", F.coalesce("component", "rep").alias("part")
    )
    parts = stored(parts, "parts")
    held = member.join(parts.select("rep", "part"), "rep")
    open_ = held.groupBy("key").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least <> most").select("key")
    held = member.select("key", "rep").join(stored(open_, "open"), "key")
    held = stored(held, "held")
    if not held.limit(1).count():
        return roots
    large = parts.groupBy("part").count().where(F.col("count") >= BLOCK // 2).select("part", F.col("part").alias("large"))
    left = parts.join(held.select("rep").distinct(), "rep").join(stored(large, "large"), "part", "left")
    left = stored(_blocks(left.withColumn("large", F.coalesce("large", F.lit(-1))), ["hub", "large"]), "left")
    where = stored(held.join(left.select("rep", "block", "large"), "rep").select("key", "block", "large").distinct(), "where")
    other = where.select("key", F.col("block").alias("other"), F.col("large").alias("other_large"))
    meet = where.join(other, "key").where("block < other OR (block = other AND large = -1)")
    meet = stored(meet.where("large = -1 OR large <> other_large").select("block", "other").distinct(), "meet")
    sided = meet.select("block", "other", F.col("block").alias("own"), F.lit(0).alias("side")).unionAll(
        meet.where("block <> other").select("block", "other", F.col("other").alias("own"), F.lit(1).alias("side"))
    )
    bodies = texts.select("rep", "body").join(left.select("rep", "part", F.col("block").alias("own")), "rep")
    pairs = sided.join(stored(bodies, "bodies"), "own").groupBy("block", "other")
    far = pairs.applyInPandas(_linker(size, percent), "a long, b long")
    return components(near.unionAll(stored(far, "far")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``kept`` (the smallest id of its component)."""
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sketch = F.arrow_udf(sketcher(size), "n_shingles bigint, name binary, keys array<bigint>")
    sketches = stored(own.select("id", sketch("text").alias("s")).select("id", "s.*"), "sketches")
    roots = links(own, sketches, size, percent)
    classes = sketches.where("name IS NOT NULL AND id IS NOT NULL").groupBy("name").agg(F.min("id").alias("rep"))
    classes = classes.join(roots, F.col("rep") == F.col("node"), "left").select("name", F.coalesce("component", "rep").alias("component_id"))
    found = sketches.drop("keys").join(stored(classes, "names"), "name", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return found.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows that aren't near-duplicates of one with a smaller id; of rows that repeat an id all stay or go."""
    found = near_duplicates(docs, id_col, text_col, size, percent)
    (name,) = free_names(docs, "gone")
    gone = found.groupBy(F.col(id_col).alias(name)).agg(F.bool_or("kept").alias("is_kept")).where("NOT is_kept").select(name)
    return docs.join(stored(gone, "gone").hint("merge"), F.col(id_col) == F.col(name), "left_anti")


def op6_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=3, percent=85)


_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sql_of(docs: str, size: int, percent: int) -> str:
    """The tables ``sized`` and ``component`` by comparing all pairs that share a shingle."""
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(size))
    return f"""bare AS (
  SELECT doc_id, trim(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_CHARS}) AS t FROM {docs}),
worded AS (
  SELECT doc_id, CASE WHEN t = '' THEN [] ELSE string_split_regex(t, '[\\x20\\x09-\\x0D]+') END AS w FROM bare),
shingles AS (
  SELECT DISTINCT doc_id, {shingle} AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM worded)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM worded WHERE len(w) BETWEEN 1 AND {size - 1}),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= {percent} * (x.n + y.n - common)),
reach(node, other) AS (
  SELECT doc_id, doc_id FROM {docs}
  UNION SELECT node, CASE WHEN other = a THEN b ELSE a END FROM reach JOIN linked ON other = a OR other = b),
component AS (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node)"""


SQL = f"""WITH RECURSIVE {sql_of("documents", 3, 85)}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN sizes USING (doc_id)"""

QUERIES = {"op6_near_duplicates": (op6_near_duplicates, SQL)}
