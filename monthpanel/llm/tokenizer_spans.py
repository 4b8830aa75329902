"""Alignment of the tokens of two tokenizers on the bytes of the same texts, with corpus-wide counts of linked ids.

Spans. Both tokenizers see a space and the text (A gets it, B adds it). The character offsets of A and the byte spans of B's proto are coarse cuts; a token
whose span hasn't as many bytes as the token (parts of a character, byte fallback) is placed by its own decoded bytes. Places where tokens of
both end cut the text into groups; all A and B tokens of a group are linked. Words of letters go to A's merges at once, under the names of their bytes.

Chunks. No token of either goes over a single space between two other characters (A splits there, and B has no piece with a space after
another character), nor over a line end, nor over the place between a letter and a mark that no piece of B has together; ``Pair`` checks that, else texts
are taken whole. So texts are aligned chunk by chunk, and the chunks met before are remembered, two generations of ``REMEMBERED`` a worker. A text
with a chunk that doesn't give back its bytes is aligned as a whole instead.

Counts. A document's distinct id pairs are stored with how often it links them. Counted in Spark, the pairs are a table of at most |A| x |B| rows however large the
corpus is; sorted, it is written as arrays in the shared folder, which workers map to look up the pairs of their documents, so
nothing of a document is shuffled. A worker reads the arrays where the folder has no local path.

Nulls: null and empty texts have no tokens: zeros, and '' for the groups. So have texts whose tokens don't give their bytes back. Null ids are kept.
Rows that repeat are documents of their own in counts and results; long texts are taken whole. An empty table gives no rows. Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import string
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthpanel.llm.shared import new_folder, stored, table

#: Chunks that a worker remembers (twice as many at most), their longest, pairs of a file of the table of counts.
REMEMBERED, LONGEST, FILE_PAIRS = 300_000, 64, 4_000_000
_EDGE = re.compile(r"\s\s|^\s|\s$")
_SINGLE = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"


def _byte_names() -> list[str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b if b in printable else 256 + others.index(b)) for b in range(256)]


#: Tokens of A, of B, groups, their text and the links (``a * |B| + b`` as 64-bit integers) of a text.
Aligned = tuple[int, int, int, str, bytes]


def refined(cuts: list[int], sizes: Iterable[int]) -> list[int]:
    """Where each token ends: the coarse cut where it leaves the token its number of bytes, else counted in bytes."""
    counted = list(accumulate(sizes))
    return cuts if cuts == counted else counted


def written(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int], base: int) -> Aligned:
    """Cuts tokens where both sides end."""
    texts, links, n, m = [], [], 0, 0
    place = dict(zip(b_ends, range(1, len(b_ends) + 1)))
    for i, end in enumerate(a_ends, 1):
        if end in place:
            j = place[end]
            if i - n == 1 and j - m == 1:
                texts.append(f"{a[n]}|{b[m]}")
                links.append(a[n] * base + b[m])
            else:
                xs, ys = a[n:i], b[m:j]
                texts.append(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}")
                links += [x * base + y for x in xs for y in ys]
            n, m = i, j
    return len(a), len(b), len(texts), ";".join(texts), array("q", links).tobytes()


def joined(parts: list[Aligned]) -> Aligned:
    a, b, groups, texts, links = zip(*parts)
    return sum(a), sum(b), sum(groups), ";".join(texts), b"".join(links)


class _Remembered(dict):
    """Chunks met before, after a space or (``bare``) not; none for those that can't be aligned."""

    def __init__(self, pair: Pair, bare: bool):
        super().__init__()
        self.pair, self.bare, self.older = pair, bare, {}

    def __missing__(self, text: str) -> Aligned | None:
        found = self.older.get(text)
        if found is None:
            found = self._made(text)
        if found and len(text) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[text] = found
        return found

    def _made(self, text: str) -> Aligned | None:
        pair = self.pair
        if not self.bare and text.isalpha():
            return pair.align_word(text)
        at = pair.cut(text)
        if not at:
            return pair.bare_chunk(text) if self.bare else pair.align(text)
        line = text[at] == "\n"
        parts = [self[text[:at]], *([pair.line] if line else []), pair.bare[text[at + line :]]]
        if None in parts:
            return None if self.bare else pair.align(text)
        return joined(parts)


class Pair:
    """Two tokenizers with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        names = _byte_names()
        alphabet = {c: b for b, c in enumerate(names)}
        self.names = {b: ord(c) for b, c in enumerate(names)}
        vocabulary = self.a.get_vocab()
        self.a_bytes = {i: bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode() for token, i in vocabulary.items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.base = len(pieces)
        # A's merges can spell every text: they know all bytes.
        plain = self.a.normalizer is None and "ByteLevel" in str(self.a.pre_tokenizer) and "use_regex=True" in str(self.a.pre_tokenizer)
        self.chunked = plain and set(names) <= set(vocabulary) and not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        # A mark after a letter, and a line end between two characters, begin a token of A; where B has no piece with both, of B too.
        after_letters = {p[k + 1] for p in pieces for k in range(len(p) - 1) if p[k].isalpha()}
        marks = [c for c in string.punctuation if c != "'" and c not in after_letters]
        self.cuts = re.compile(rf"(?<=\S)(?:[{re.escape(''.join(marks))}]|\n(?=\S))")
        self.chunked = self.chunked and bool(marks) and not any("\n" in p for p in pieces)
        self.spaced, self.bare = _Remembered(self, False), _Remembered(self, True)
        # A space and a line end are tokens by themselves before another character.
        known, self.line, self.before = self.align("\nx"), None, ""
        if known and known[:3] == (3, 3, 3):
            space, line, _ = known[3].split(";")
            self.line, self.before = (1, 1, 1, line, known[4][8:16]), f"{space};{line};"
        self.chunked = self.chunked and self.line is not None

    def cut(self, text: str) -> int:
        """Where a chunk can be cut in two, or 0."""
        for found in self.cuts.finditer(text):
            at = found.start()
            if text[at] == "\n" or text[at - 1].isalpha():
                return at
        return 0

    def bare_chunk(self, text: str) -> Aligned | None:
        """Alignment of a text that follows a line end: that of the line end and the text, less the space and the line end."""
        made = self.align("\n" + text)
        if not made or not made[3].startswith(self.before):
            return None
        return made[0] - 2, made[1] - 2, made[2] - 2, made[3].removeprefix(self.before), made[4][16:]

    def align_word(self, word: str) -> Aligned | None:
        """As :meth:`align`, of letters: one word of A, whose merges get it under the names of its bytes."""
        wanted = b" " + word.encode()
        tokens = self.a.model.tokenize(wanted.decode("latin-1").translate(self.names))
        pieces = self.b.encode(word, return_type="proto").pieces
        b = [p.id for p in pieces]
        b_bytes = [self.b_bytes[i] for i in b]
        if b"".join(b_bytes) != wanted:
            return None
        # The name of the space has two bytes, so cuts are one too far behind it; other bytes may have such names too and are counted.
        a, a_cuts, b_cuts = [t.id for t in tokens], [t.offsets[1] - 1 for t in tokens], [p.end + 1 for p in pieces]
        if not word.isascii():
            a_cuts, b_cuts = refined(a_cuts, [len(self.a_bytes[i]) for i in a]), refined(b_cuts, map(len, b_bytes))
        return written(a, a_cuts, b, b_cuts, self.base)

    def align(self, text: str) -> Aligned | None:
        """Alignment of a space and ``text``; none where the tokens' bytes are others."""
        wanted = b" " + text.encode()
        encoded = self.a.encode(" " + text, add_special_tokens=False)
        a, cuts = encoded.ids, [end for _, end in encoded.offsets]
        if len(wanted) > len(text) + 1:  # characters to bytes
            places = list(accumulate(map(len, map(str.encode, " " + text)), initial=0))
            cuts = [places[end] for end in cuts]
        spans = [(p.id, p.end + 1) for p in self.b.encode(text, return_type="proto").pieces]
        b = [i for i, _ in spans]
        a_bytes, b_bytes = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(a_bytes) != wanted or b"".join(b_bytes) != wanted:
            return None
        return written(a, refined(cuts, map(len, a_bytes)), b, refined([end for _, end in spans], map(len, b_bytes)), self.base)

    def document(self, text: str | None) -> tuple[int, int, int, str, np.ndarray]:
        """The alignment of a whole text; zeros where it has no tokens."""
        if text:
            parts = [text] if not self.chunked else text.split(" ") if not _EDGE.search(text) else _SINGLE.split(text)
            found = list(map(self.spaced.__getitem__, parts)) if self.chunked else [self.align(text)]
            if len(parts) > 1 and None in found:
                found = [self.align(text)]
            if None not in found:
                a, b, groups, texts, links = joined(found)
                return a, b, groups, texts, np.frombuffer(links, np.int64)
        return 0, 0, 0, "", np.zeros(0, np.int64)


_loaded: dict[tuple[str, str], Pair] = {}


def pair_of(a_path: str, b_path: str) -> Pair:
    """The tokenizers, loaded once in a worker."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Pair(a_path, b_path)
    return _loaded[a_path, b_path]


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def _aligner(a_path: str, b_path: str, id_type: pa.DataType) -> Callable:
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair_of(a_path, b_path)
        for batch in batches:
            rows, pairs, times = [], [], []
            for text in batch.column(1):
                a, b, groups, written, links = both.document(text.as_py())
                distinct, n = np.unique(links, return_counts=True)
                rows.append((a, b, groups, len(links), hashlib.sha256(written.encode()).hexdigest() if a else ""))
                pairs.append(distinct)
                times.append(n.astype(np.int32))
            offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
            numbers = [pa.array(x, pa.int64()) for x in zip(*[r[:4] for r in rows])] if rows else [pa.array([], pa.int64())] * 4
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, kind), *x]))) for x, kind in ((pairs, np.int64), (times, np.int32))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), *numbers, pa.array([r[4] for r in rows], pa.string()), *lists],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

    return align


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its numbers of tokens, groups and links, the digest of its groups, and its distinct linked ids (``pairs``: A's id times |B| plus B's) with their ``times``."""
    from pyspark.sql.pandas.types import to_arrow_type

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType
    return texts.mapInArrow(_aligner(a_path, b_path, to_arrow_type(kind)), f"doc_id {kind.simpleString()}, {_ALIGNED}")


def pair_counts(made: DataFrame, base: int) -> DataFrame:
    """Per pair how many rows of ``aligned`` link it (``docs``), and whether no other pair of its A id has more (``best``)."""
    counts = made.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    most = F.max("docs").over(Window.partitionBy(F.expr(f"pair div {base}")))
    return counts.withColumn("best", F.col("docs") == most)


def _write_counts(folder: str) -> Callable:
    """Writes a task's pairs, which come sorted, as one file: the pairs, then their counts, negative for best ones. Only files that the rows name count."""

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(f["pair"].to_numpy(np.int64), np.where(f["best"], -f["docs"], f["docs"]).astype(np.int64)) for f in frames]
        pairs, docs = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*parts) if parts else ((), ())))
        if len(pairs):
            system, path = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
            system.create_dir(path, recursive=True)
            name = f"counts-{uuid.uuid4().hex}"
            with system.open_output_stream(f"{path}/{name}") as out:
                out.write(pairs.astype("<i8").tobytes())
                out.write(docs.astype("<i8").tobytes())
            yield pd.DataFrame({"name": [f"{folder}/{name}"], "first": [pairs[0]]})

    return write


def write_counts(counts: DataFrame) -> list[str]:
    """Names of the files of counts, by ascending pairs: one for each ``FILE_PAIRS`` of at most |A| x |B| pairs."""
    spark = counts.sparkSession
    counts = stored(counts, "pair-counts")
    files = max(1, -(-counts.count() // FILE_PAIRS))
    ordered = counts.repartitionByRange(files, "pair").sortWithinPartitions("pair")
    names = stored(ordered.mapInPandas(_write_counts(new_folder(spark, "pair-files")), "name string, first long"), "pair-names")
    return [r.name for r in sorted(names.collect(), key=lambda r: r.first)]


class Counts:
    """The files of counts, mapped where they have a local path."""

    def __init__(self, names: tuple[str, ...]):
        self.files = [self._opened(name) for name in names]
        self.first = np.array([pairs[0] for pairs, _ in self.files], np.int64)

    @staticmethod
    def _opened(name: str) -> tuple[np.ndarray, np.ndarray]:
        system, path = fs.FileSystem.from_uri(name) if ":" in name else (fs.LocalFileSystem(), name)
        if isinstance(system, fs.LocalFileSystem):
            both = np.memmap(path, "<i8", "r")
        else:
            with system.open_input_file(path) as stream:
                both = np.frombuffer(stream.read(), "<i8")
        return both[: len(both) // 2], both[len(both) // 2 :]

    def of(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of known pairs, negative for best ones."""
        distinct, where = np.unique(pairs, return_inverse=True)
        out, bounds = np.zeros(len(distinct), np.int64), np.append(np.searchsorted(distinct, self.first), len(distinct))
        for (known, counts), a, b in zip(self.files, bounds[:-1], bounds[1:]):
            if a < b:
                out[a:b] = counts[np.searchsorted(known, distinct[a:b])]
        return out[where]


def link_scores(names: list[str]) -> Callable[..., Column]:
    """Function of ``pairs`` and ``times``: number of links to a best pair of their A id, and the sum of the counts of all links."""
    names = tuple(names)

    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        counts = Counts(names)
        for pairs, times in batches:
            n = counts.of(pairs.flatten().to_numpy())
            t = times.flatten().to_numpy().astype(np.int64)
            ends = pairs.offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]
            made = []
            for values in (np.where(n < 0, t, 0), np.abs(n) * t):
                sums = np.concatenate([[0], np.cumsum(values)])
                made.append(pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64()))
            yield pa.StructArray.from_arrays(made, names=["n_best", "count_sum"])

    return F.arrow_udf(score, "n_best bigint, count_sum bigint")


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    made = stored(aligned(docs, a_path, b_path, id_col, text_col), "spans")
    names = write_counts(pair_counts(made, pair_of(a_path, b_path).base))
    scored = made.withColumn("s", link_scores(names)("pairs", "times"))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "s.n_best", "s.count_sum", "groups_sha256")


def op12_tokenizer_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op12_tokenizer_spans": (op12_tokenizer_spans, None)}
