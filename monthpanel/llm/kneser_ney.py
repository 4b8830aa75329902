"""Interpolated modified Kneser-Ney bigram model, counted in Spark, kept as sorted hash arrays that workers map.

Counting. Words are 64-bit hashes. Every task counts the words and the bigrams of its documents by sorting and hands over packed runs of hash and
count, one row for each shard. The bigrams of a context go to the shard of its hash; contexts that make up over a thousandth
of all words, or that are over a tenth of ``SHARD_WORDS``, are spread over all shards: at most a thousand, or ten for each ``SHARD_WORDS`` words of
the corpus (333,000 or 2.7 MB at 100 billion words). A shard adds up its bigrams, counts for each context how
many words followed it once, twice and more often, and for each word how many contexts it followed; these are added up in Spark.
The number of shards follows the number of words, so a shard has a bounded number of bigrams.

Storing. A shard is an array of sorted 64-bit values, the upper 56 bits a hash of the bigram, the lower 8 its count (255: in a second
array of such hashes and counts). The words are sorted hashes with count, number of contexts, and back-off weight. The arrays are files in the shared folder; a task writes
under a name of its own attempt, and only names in the stored table of files count.

Scoring. Workers map the files (``numpy.memmap``) and look up the sorted distinct bigrams of some million words at a time; nothing
is shuffled. Where the shared folder is not a mounted path, a worker reads the files into memory instead. The model grows with the distinct
bigrams of the corpus, 8 bytes each.

The model: p(w|v) = max(c(vw) - D(c(vw)), 0) / c(v) + g(v) p(w) with the discounts D of counts 1, 2 and more; p(w) likewise from the numbers of
contexts, and at last one part in V + 1 for each of the V known words and the unknown. A text begins after a start mark and
ends with an end token.

Nulls: a null text has only the end token. Rows with a null id teach nothing and are scored. Rows that repeat count and score
alike. An empty table gives no rows; without training text every token is unknown. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthpanel.llm.batches import bytes_of, word_hashes
from monthpanel.llm.shared import id_remainder, new_folder, stored, table

#: Words that a task gathers before it sorts them, and words of the corpus for each shard.
GATHER, SHARD_WORDS = 1_800_000, 3_000_000
HELD_OUT, ADDED = 10, 0.1
START, END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949C7DEFD5D0D2B)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(255)


def tokens_of(text: bytes) -> np.ndarray:
    """Hashes of the words of a text, and of its end."""
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(word_hashes.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def bigram_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return _mixed(before * _FACTOR + words)


def shards_of(before: np.ndarray, keys: np.ndarray, shards: int, hot: np.ndarray) -> np.ndarray:
    """Shard of each bigram: that of its context, for hot contexts that of the bigram."""
    place = np.searchsorted(hot, before).clip(max=max(0, len(hot) - 1))
    spread = hot[place] == before if len(hot) else np.zeros(len(before), bool)
    return (_mixed(np.where(spread, keys, before)) >> np.uint64(16)) % np.uint64(shards)


def _texts(batch: pa.Array) -> Iterator[bytes]:
    data, offsets = bytes_of(batch)
    for begin, end in zip(offsets.tolist(), offsets[1:].tolist()):
        yield data[begin:end].tobytes()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words and what stands before each, some millions at a time."""
    words, n = [], 0
    for batch in batches:
        for text in _texts(batch.column(0)):
            words.append(tokens_of(text))
            n += len(words[-1])
            if n >= GATHER:
                yield _joined(words)
                words, n = [], 0
    if words:
        yield _joined(words)


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    words = np.concatenate(texts)
    before = np.concatenate([[START], words[:-1]])
    before[np.cumsum([0, *map(len, texts[:-1])])] = START
    return before.astype(np.uint64), words


def _packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Hashes and counts as bytes; a count takes one byte, from 255 on eight more at the end."""
    large = counts >= 255
    return np.uint64(len(hashes)).tobytes() + hashes.tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[large].astype(np.uint64).tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.uint64, 1)[0])
    hashes = np.frombuffer(data, np.uint64, n, 8)
    counts = np.frombuffer(data, np.uint8, n, 8 + 8 * n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, np.uint64, -1, 8 + 9 * n).astype(np.int64)
    return hashes, counts


def _count_words(shards: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _gathered(batches):
            hashes, counts = np.unique(words, return_counts=True)
            shard = (_mixed(hashes) % np.uint64(shards)).astype(np.int64)
            rows = [(s, _packed(hashes[shard == s], counts[shard == s])) for s in np.unique(shard).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows]), pa.array([r for _, r in rows], pa.binary())], names=["shard", "run"])

    return count


def _add_words(runs: pd.DataFrame) -> pd.DataFrame:
    hashes, counts = _summed([_unpacked(r) for r in runs["run"]])
    return pd.DataFrame({"word": hashes.view(np.int64), "n": counts})


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _count_bigrams(shards: int, hot: np.ndarray) -> Callable:
    """Rows ``shard, contexts, runs``: the packed contexts with the length of their runs, and the packed words of the runs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for before, words in _gathered(batches):
            keys = bigram_keys(before, words)
            order = np.argsort(keys)
            ordered = keys[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            counts, keys, some = np.diff(np.append(first, len(ordered))), ordered[first], order[first]
            before, words = before[some], words[some]
            del order, ordered, first, some
            shard = shards_of(before, keys, shards, hot).astype(np.int64)
            del keys
            order = np.lexsort((before, shard))
            shard, before, words, counts = shard[order], before[order], words[order], counts[order]
            bounds = np.searchsorted(shard, np.arange(shards + 1))
            for s in range(shards):
                a, b = bounds[s], bounds[s + 1]
                if a < b:
                    contexts, lengths = np.unique(before[a:b], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s]), pa.array([_packed(contexts, lengths)], pa.binary()), pa.array([_packed(words[a:b], counts[a:b])], pa.binary())],
                        names=["shard", "contexts", "runs"],
                    )

    return count


def _write(folder: str, name: str, array: np.ndarray) -> str:
    system, path = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(np.ascontiguousarray(array).tobytes())
    return f"{folder}/{name}"


def _add_bigrams(folder: str) -> Callable:
    """Writes a shard and gives its rows: file names, counts of contexts, counts of words, counts of counts (by ``kind``)."""

    def add(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = []
        for t in tables:
            for contexts, runs in zip(t.column("contexts").to_pylist(), t.column("runs").to_pylist()):
                names, lengths = _unpacked(contexts)
                words, counts = _unpacked(runs)
                pairs.append((np.repeat(names, lengths), words, counts))
        before, words, counts = (np.concatenate(x) for x in zip(*pairs))
        pairs.clear()
        keys = bigram_keys(before, words)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.add.reduceat(counts[order], first)
        before, words, keys = before[order[first]], words[order[first]], keys[first]
        shard, attempt = int(key[0].as_py()), xxhash.xxh3_64_hexdigest(np.random.default_rng().bytes(16))
        slots = (keys & ~_LOW) | np.minimum(counts, 255).astype(np.uint64)
        large = counts >= 255
        files = [_write(folder, f"bigrams-{shard}-{attempt}", slots), _write(folder, f"large-{shard}-{attempt}", np.concatenate([slots[large] & ~_LOW, counts[large].astype(np.uint64)]))]
        schema = pa.schema([("kind", pa.string()), ("name", pa.string()), ("word", pa.int64()), *((f"n{k}", pa.int64()) for k in range(1, 6))])

        def rows(kind: str, name: str | None, word: np.ndarray, *numbers: np.ndarray) -> pa.RecordBatch:
            n = len(word)
            fill = [pa.array(x.astype(np.int64)) for x in numbers] + [pa.nulls(n, pa.int64())] * (5 - len(numbers))
            return pa.RecordBatch.from_arrays([pa.array([kind] * n), pa.array([name] * n, pa.string()), pa.array(word.astype(np.uint64).view(np.int64)), *fill], schema=schema)

        yield rows("file", files[0], np.array([shard]), np.array([len(slots)]))
        yield rows("large", files[1], np.array([shard]), np.array([int(large.sum())]))
        yield rows("counts", None, np.array([shard]), *[np.array([int((counts == k).sum())]) for k in (1, 2, 3, 4)])
        names, where = np.unique(before, return_inverse=True)
        numbers = [np.bincount(where, x, len(names)) for x in (counts, counts == 1, counts == 2, counts > 2)]
        for at in range(0, len(names), 100_000):
            yield rows("context", None, names[at : at + 100_000], *[x[at : at + 100_000] for x in numbers])
        names, contexts = np.unique(words, return_counts=True)
        for at in range(0, len(names), 100_000):
            yield rows("word", None, names[at : at + 100_000], contexts[at : at + 100_000])

    return add


def _discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more from the counts of counts; where one is missing, what keeps them between 0 and the count."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d1 = 1 - 2 * y * n2 / n1 if n1 else 0.5
    d2 = 2 - 3 * y * n3 / n2 if n2 else 1.0
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.5
    return tuple(float(min(max(d, 0.05), k)) for d, k in ((d1, 1.0), (d2, 2.0), (d3, 3.0)))


@dataclass(frozen=True)
class Model:
    """Numbers and file names of a trained model."""

    tokens: int = 0
    known: int = 0
    bigrams: int = 0
    hot: tuple[int, ...] = ()
    discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    word_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    word_backoff: float = 1.0
    shards: tuple[tuple[str, str], ...] = ()
    words: tuple[str, ...] = ()


def _write_words(folder: str, parts: int) -> Callable:
    """Writes sorted words with count, number of contexts, count as a context and back-off weight."""

    def write(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("word", "n", "contexts", "total", "weight")
        columns = [np.concatenate(x) for x in zip(*[[b.column(c).to_numpy(zero_copy_only=False) for c in names] for b in tables])]
        hashes = columns[0].view(np.uint64)
        order = np.argsort(hashes)
        attempt = xxhash.xxh3_64_hexdigest(np.random.default_rng().bytes(16))
        rows = np.zeros(len(order), [("word", "<u8"), ("n", "<i8"), ("contexts", "<i8"), ("total", "<i8"), ("weight", "<f8")])
        for name, column in zip(names, [hashes, *columns[1:]]):
            rows[name] = column[order]
        base = f"words-{key[0].as_py()}-{attempt}"
        _write(folder, base, rows["word"])
        for name in names[1:]:
            _write(folder, f"{base}-{name}", rows[name])
        yield pa.RecordBatch.from_pylist([{"part": key[0].as_py(), "name": f"{folder}/{base}"}], pa.schema([("part", pa.int64()), ("name", pa.string())]))

    return write


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count all rows of ``docs`` and store the model in a new folder of the shared folder."""
    spark = docs.sparkSession
    folder = new_folder(spark, "model")
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # A first guess of the number of words, for the number of shards: five bytes each.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-int(size) // (5 * SHARD_WORDS)))
    runs = texts.mapInArrow(_count_words(shards), "shard long, run binary")
    words = stored(runs.groupBy("shard").applyInPandas(_add_words, "word long, n long"), "words")
    sums = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("known")).first()
    if not sums["known"]:
        return Model()
    hot = np.sort(np.array([r.word for r in words.where(F.col("n") > min(sums["tokens"] / 1000, SHARD_WORDS / 10)).select("word").collect()], np.int64).view(np.uint64))
    # The start of the text is a context that as many bigrams have as there are texts.
    hot = np.unique(np.append(hot, START))
    pairs = texts.mapInArrow(_count_bigrams(shards, hot), "shard long, contexts binary, runs binary")
    kinds = "kind string, name string, word long, n1 long, n2 long, n3 long, n4 long, n5 long"
    made = stored(pairs.groupBy("shard").applyInArrow(_add_bigrams(folder), kinds), "bigrams")

    files = made.where("kind IN ('file', 'large')").select("kind", "name", "word", "n1").collect()
    names = {kind: {r.word: r.name for r in files if r.kind == kind} for kind in ("file", "large")}
    c = made.where("kind = 'counts'").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    d = _discounts(c.n1, c.n2, c.n3, c.n4)
    contexts = made.where("kind = 'context'").groupBy("word").agg(
        F.sum("n1").alias("total"), (F.lit(d[0]) * F.sum("n2") + F.lit(d[1]) * F.sum("n3") + F.lit(d[2]) * F.sum("n4")).alias("held")
    )
    followed = made.where("kind = 'word'").groupBy("word").agg(F.sum("n1").alias("contexts"))
    parts = max(1, -(-int(sums["known"]) // 20_000_000))
    both = words.join(followed, "word", "left").join(contexts, "word", "full").select(
        "word", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("contexts", F.lit(0)).alias("contexts"), F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce(F.col("held") / F.col("total"), F.lit(1.0)).alias("weight"), F.pmod("word", F.lit(parts)).alias("part"),
    )
    both = stored(both, "vocabulary")
    counts = both.agg(
        F.sum("contexts").alias("all"), *[F.count_if(F.col("contexts") == k).alias(f"n{k}") for k in (1, 2, 3, 4)], F.count_if(F.col("contexts") > 2).alias("more")
    ).first()
    e = _discounts(counts.n1, counts.n2, counts.n3, counts.n4)
    backoff = (e[0] * counts.n1 + e[1] * counts.n2 + e[2] * counts.more) / counts["all"]
    written = both.groupBy("part").applyInArrow(_write_words(folder, parts), "part long, name string")
    listed = {r.part: r.name for r in stored(written, "vocabulary-files").collect()}
    return Model(
        int(sums["tokens"]), int(sums["known"]), int(counts["all"]), tuple(int(x) for x in hot), d, e, float(backoff),
        tuple((names["file"].get(s, ""), names["large"].get(s, "")) for s in range(shards)), tuple(listed.get(p, "") for p in range(parts)),
    )


def _mapped(name: str, kind: str) -> np.ndarray:
    """A file of the model as an array: mapped where it has a local path, else read."""
    if not name:
        return np.zeros(0, kind)
    system, path = fs.FileSystem.from_uri(name) if ":" in name else (fs.LocalFileSystem(), name)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if system.get_file_info(path).size else np.zeros(0, kind)
    with system.open_input_file(path) as stream:
        return np.frombuffer(stream.read(), kind)


class Lookup:
    """A model opened for scoring."""

    def __init__(self, model: Model):
        self.model, self.hot = model, np.array(model.hot, np.uint64)
        self.shards = [(_mapped(a, "<u8"), _mapped(b, "<u8")) for a, b in model.shards]
        kinds = {"": "<u8", "-n": "<i8", "-contexts": "<i8", "-total": "<i8", "-weight": "<f8"}
        self.words = [[_mapped(name and name + end, kind) for end, kind in kinds.items()] for name in model.words]

    def word_numbers(self, words: np.ndarray) -> tuple[np.ndarray, ...]:
        """Count, contexts, count as a context and back-off weight of sorted distinct words."""
        out = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.ones(len(words))
        part = words.view(np.int64) % max(1, len(self.words))
        for p, (hashes, *columns) in enumerate(self.words):
            own = np.flatnonzero(part == p)
            if len(own) and len(hashes):
                at = np.searchsorted(hashes, words[own]).clip(max=len(hashes) - 1)
                hit = hashes[at] == words[own]
                for values, column in zip(out, columns):
                    values[own[hit]] = column[at[hit]]
        return out

    def bigram_counts(self, before: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Counts of bigrams sorted by key."""
        out = np.zeros(len(keys), np.int64)
        if not self.shards:
            return out
        shard = shards_of(before, keys, len(self.shards), self.hot)
        for s, (slots, large) in enumerate(self.shards):
            own = np.flatnonzero(shard == np.uint64(s))
            if len(own) and len(slots):
                wanted = keys[own] & ~_LOW
                at = np.searchsorted(slots, wanted).clip(max=len(slots) - 1)
                found = slots[at]
                hit = (found & ~_LOW) == wanted
                counts = np.where(hit, found & _LOW, 0).astype(np.int64)
                big = np.flatnonzero(counts == 255)
                if len(big):
                    half = len(large) // 2
                    counts[big] = large[half + np.searchsorted(large[:half], wanted[big])]
                out[own] = counts
        return out

    def score(self, before: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each word after the one before it, and its own training count."""
        m = self.model
        distinct, where = np.unique(np.concatenate([before, words]), return_inverse=True)
        n, contexts, total, weight = self.word_numbers(distinct)
        v, w = where[: len(words)], where[len(words) :]
        keys, first, back = np.unique(bigram_keys(before, words), return_index=True, return_inverse=True)
        c = self.bigram_counts(before[first], keys)[back]
        low = np.array([0.0, *m.word_discounts])[np.minimum(contexts, 3)]
        unigram = (np.maximum(contexts - low, 0) / max(1, m.bigrams) + m.word_backoff / (m.known + 1))[w]
        high = np.maximum(c - np.array([0.0, *m.discounts])[np.minimum(c, 3)], 0)
        known = total[v] > 0
        p = np.where(known, high / np.maximum(1, total[v]) + weight[v] * unigram, unigram)
        return np.log10(p), n[w]


def scorer(model: Model) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """Function of Arrow batches: number of tokens, of known ones, base score and score of each text."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup, unit = Lookup(model), np.log10(model.tokens + ADDED * (model.known + 1))
        for batch in batches:
            rows: list[tuple] = []
            texts: list[np.ndarray] = []

            def flush() -> None:
                if texts:
                    before, words = _joined(texts)
                    p, n = lookup.score(before, words)
                    starts = np.cumsum([0, *map(len, texts[:-1])])
                    base = np.add.reduceat(np.log10(n + ADDED) - unit, starts)
                    rows.extend(zip(map(len, texts), np.add.reduceat((n > 0).astype(np.int64), starts), base, np.add.reduceat(p, starts)))
                    texts.clear()

            held = 0
            for text in _texts(batch):
                texts.append(tokens_of(text))
                held += len(texts[-1])
                if held >= GATHER // 3:
                    flush()
                    held = 0
            flush()
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.StructArray.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64())],
                names=["n_tokens", "n_known", "base_score", "score"],
            )

    return score


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_tokens, n_known, base_score, score`` and ``perplexity`` per token."""
    score = F.arrow_udf(scorer(model), "n_tokens bigint, n_known bigint, base_score double, score double")
    scored = docs.select(F.col(id_col), score(F.coalesce(F.col(text_col), F.lit(""))).alias("s")).select(id_col, "s.*")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = id_remainder(F.col("doc_id"), HELD_OUT)
    model = train(docs.where(remainder != 0))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), HELD_OUT) == 0, F.lit(False))
    return score_texts(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


QUERIES = {"op10_kneser_ney": (op10_kneser_ney, None)}
