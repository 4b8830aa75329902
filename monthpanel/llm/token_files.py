"""Token ids of documents as ORC files: integer run lengths, row indexes and Bloom filters on document ids.

Writing. Documents are dealt over partitions by ranges of their id, sorted, encoded with the tokenizers library and written in ascending id
order, one file for each range. A row of a file is a part of a document, at most ``PART_IDS`` ids: ``shard`` (the range), ``doc_no`` (number
of the document in its shard), ``doc_id``, ``part``, ``before`` (crc32 of the document's ids in earlier parts) and ``ids``. So a reader holds bounded arrays
whatever the length of a document, and can verify any part by itself, in any stripe.

Encoding. The pre-tokenizer never joins across white space, so a text is encoded chunk by chunk between white space and the chunks met before are
remembered (two generations of ``REMEMBERED`` short chunks a worker); the tests hold the ids to those of the whole text. ``doc_id`` has a Bloom filter and
an index entry every ``STRIDE`` rows, which filters on ids use; a file is split by its stripes.

Reading. Parts are read stripe by stripe with the checksum of each, and put together per document; where a document begins among all ids
is a running sum in its shard plus the ids of earlier shards (a row for each shard).

Nulls: a null text is an empty one, whose only id is the end. Null ids come first. Empty texts have the end id; texts of any length are kept whole,
in parts. Rows that repeat an id are documents of their own, ordered by a hash of the text. An empty table gives no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthpanel.llm.shared import new_folder, stored, table

#: Ids of a row, bytes of text of a file, bytes of a stripe, rows of an index entry, share of ids that a Bloom filter lets through.
PART_IDS, FILE_BYTES, STRIPE_BYTES, STRIDE, FALSE_POSITIVES = 4096, 32 << 20, 16 << 20, 1000, 0.01
#: Chunks that a worker remembers (twice as many at most), and their longest.
REMEMBERED, LONGEST = 200_000, 64
END_ID = 2
_CLOSING = frozenset(".,;:!?")
#: Separators that Python's ``split`` takes for white space and the tokenizer does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


class _Chunks(dict):
    """Ids of chunks of text without white space, as bytes of 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.older = Tokenizer.from_file(path), {}
        # Characters that stand for bytes: printable ones for themselves, the others from 256 on in order.
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.names = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in printable)}

    def encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_word(self, word: str) -> bytes:
        """Ids of lower-case letters in normal form, which the steps before the merges leave as they are but for the names of bytes."""
        named = word if word.isascii() else word.encode().decode("latin-1").translate(self.names)
        return array("I", [token.id for token in self.tokenizer.model.tokenize(named)]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            if len(chunk) > 1 and chunk[-1] in _CLOSING and chunk[-2].isalnum():  # a mark after a word is a token by itself
                ids = self[chunk[:-1]] + self[chunk[-1]]
            elif chunk.isalpha() and chunk.lower() == chunk and is_normalized("NFC", chunk):
                ids = self.encode_word(chunk)
            else:
                ids = self.encode(chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


_loaded: dict[str, _Chunks] = {}


def ids_of(text: str, path: str) -> bytes:
    """Ids of a whole text without special tokens, as bytes of 32-bit integers."""
    chunks = _loaded.get(path)
    if chunks is None:
        chunks = _loaded[path] = _Chunks(path)
    if any(s in text for s in _SEPARATORS):
        return chunks.encode(text)
    if "<|" not in text and "\u03a3" not in text:  # the tokenizer lower-cases all but its special tokens, and a sigma at any place alike
        low = text.lower()
        if text.isascii() or is_normalized("NFC", text) and is_normalized("NFC", low):
            text = low
    return b"".join(map(chunks.__getitem__, text.split()))


def _encoder(path: str, end_id: int, id_type: pa.DataType) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, end = TaskContext.get().partitionId(), -1, np.array([end_id], "<u4").tobytes()
        rows: list[tuple] = []
        parts: list[bytes] = []
        held = 0

        def batch() -> pa.RecordBatch:
            offsets = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(parts), "<i4")))
            docs, numbers, order, before = zip(*rows)
            made = [pa.array([shard] * len(rows), pa.int32()), pa.array(numbers, pa.int64()), pa.array(docs, id_type), pa.array(order, pa.int32()), pa.array(before, pa.int64()), ids]
            rows.clear()
            parts.clear()
            return pa.RecordBatch.from_arrays(made, names=["shard", "doc_no", "doc_id", "part", "before", "ids"])

        for received in batches:
            for doc, text in zip(received.column(0).to_pylist(), received.column(1).to_pylist()):
                number += 1
                ids, before = ids_of(text, path) + end, 0
                for part, at in enumerate(range(0, len(ids), 4 * PART_IDS)):
                    piece = ids[at : at + 4 * PART_IDS]
                    rows.append((doc, number, part, before))
                    parts.append(piece)
                    before = zlib.crc32(piece, before)
                    held += len(piece)
                    if held >= 4 << 20:
                        yield batch()
                        held = 0
        if rows:
            yield batch()

    return encode


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text of ``docs`` with the tokenizer file and write the ids to ORC files in ``folder``."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    texts = texts.withColumn("tie", F.xxhash64("text"))
    ordered = texts.repartitionByRange(max(1, -(-int(size) // FILE_BYTES)), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"shard int, doc_no long, doc_id {kind}, part int, before long, ids array<int>"
    from pyspark.sql.pandas.types import to_arrow_type

    made = ordered.select("doc_id", "text").mapInArrow(_encoder(tokenizer, end_id, to_arrow_type(texts.schema["doc_id"].dataType)), schema)
    made.write.options(**{
        "compression": "zstd", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": str(FALSE_POSITIVES),
        "orc.row.index.stride": str(STRIDE), "orc.stripe.size": str(STRIPE_BYTES),
    }).orc(folder)


def token_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the files. A filter on ``doc_id`` skips the stripes and index entries whose ranges and Bloom filters exclude it."""
    return spark.read.orc(folder)


def tokens_of(spark: SparkSession, folder: str, doc_ids: list) -> DataFrame:
    """``doc_id, doc_no, ids`` of some documents, read through the files' indexes."""
    parts = token_parts(spark, folder).where(F.col("doc_id").isin(list(doc_ids)))
    whole = parts.groupBy("shard", "doc_no", "doc_id").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    return whole.select("doc_id", "doc_no", F.flatten("parts.ids").alias("ids"))


def _crc_after(ids: pa.Array, before: pa.Array) -> pa.Array:
    """crc32 of each list of ids as little-endian 32-bit integers, carried on from ``before``."""
    offsets = ids.offsets.to_numpy() * 4
    data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<i4")).view(np.uint8))
    return pa.array([zlib.crc32(data[a:b], c) for a, b, c in zip(offsets.tolist(), offsets[1:].tolist(), before.to_pylist())], pa.int64())


def document_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32``; fails where a part is missing or damaged."""
    parts = token_parts(spark, folder).select("shard", "doc_no", "doc_id", "part", "before", F.size("ids").alias("n"), F.arrow_udf(_crc_after, "bigint")("ids", "before").alias("after"))
    docs = parts.repartition("shard").groupBy("shard", "doc_no").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.max_by("after", "part").alias("crc"),
        (F.count("*") == F.max("part") + 1).alias("whole"), (F.sum("after") - F.sum("before")).alias("last"),
    )
    # Each checksum carried over is the one before it, so of the differences only the last checksum is left.
    sound = F.col("whole") & (F.col("last") == F.col("crc"))
    docs = stored(docs.withColumn("crc", F.when(sound, F.col("crc")).otherwise(F.raise_error(F.lit("a part of a document is missing or damaged")))), "token-index")
    shards = docs.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    earlier = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("doc_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return docs.withColumn("earlier", earlier).join(shards, "shard").select(
        "doc_id", (F.col("offset") + F.col("earlier")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return document_index(spark, folder)


QUERIES = {"op11_token_files": (op11_token_files, None)}
