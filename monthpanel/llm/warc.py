"""WARC archives as chunked record tables.

A payload is a run of rows ``record, chunk, data`` of at most ``CHUNK`` bytes each, so neither writer nor reader holds a whole record. The
writer streams the chunks of a task's records into one archive, every record a gzip member of its own. The reader streams an
archive and emits chunk rows with the SHA-1 of the payload up to and including the chunk: the last row of a record carries its digest
and size. Records whose payload another record has in full are revisits, without a payload.

Archives are files in a new folder of the shared folder. A task writes under a name of its own attempt, and only the names in
the stored table of archives, which Spark commits once for each task, are read: what lost or repeated attempts wrote is never seen.

Equal payloads are found by digest and size with partial maxima, whatever the number of copies. The join that tells each record
its response is one that adaptive execution splits, as the digests of repeated payloads are stored before.

Nulls: a null payload is empty; a null page is written as such and only the response if all its copies are null; a null URL is left
out of the record. Rows that repeat a page are records of their own; those of the largest page are all responses. URLs are written with
control characters and blanks percent-encoded. Empty tables give no archives and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthpanel.llm.shared import new_folder, stored, table

CHUNK, LEAST_BYTES = 1 << 20, 1000
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"
_WRITTEN = "archive string, records long, bytes long"
_READ = "archive string, ordinal long, page string, record_type string, refers_to string, chunk long, last boolean, size long, sha1 string"


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Per row of ``pages``: page, url, payload, its size and digest, and the page it refers to if it is a revisit."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.expr("X''"))
    rows = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"),
        F.sha1(payload).alias("digest"),
    )
    large = rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest").agg(F.max("page").alias("keeper"), F.count("*").alias("n"))
    keepers = stored(large.where("n > 1").drop("n"), "payloads")
    joined = rows.join(keepers, "digest", "left")
    return joined.withColumn("refers_to", F.when(~F.col("page").eqNullSafe(F.col("keeper")), F.col("keeper"))).drop("keeper")


def chunk_rows(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunked record table to be written: rows of a record follow one another, the first has its ``head``."""
    pieces = F.expr(
        f"transform(sequence(0, if(refers_to is null, greatest(0, octet_length(payload) - 1), 0), {size}),"
        f" at -> if(refers_to is null, substring(payload, at + 1, {size}), X''))"
    )
    cut = records.select("page", "url", "digest", "size", "refers_to", F.posexplode(pieces).alias("chunk", "data"))
    return cut.select(F.when(F.col("chunk") == 0, F.struct("page", "url", "digest", "size", "refers_to")).alias("head"), "data")


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _header(head: dict, length: int) -> tuple[bytes, bytes]:
    """The WARC header and the HTTP header that begins its block; ``length`` is what follows of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {head['size']}\r\n\r\n".encode()
    kind = "response" if head["refers_to"] is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{_name(head['page'])}>", f"WARC-Date: {DATE}"]
    if head["url"] is not None:
        lines.append(f"WARC-Target-URI: {_uri(head['url'])}")
    lines.append(f"WARC-Payload-Digest: sha1:{head['digest']}")
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{_name(head['refers_to'])}>",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + length}"]
    return "\r\n".join(lines).encode() + _END, http


def _name(page: object) -> str:
    return "none" if page is None else str(page)


def _page(urn: str | None) -> str | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">") if urn else "none"
    return None if name == "none" else name


class Archive:
    """A WARC file being written, one gzip member for each record."""

    def __init__(self, stream):
        self.stream, self.records, self.bytes, self.member = stream, 0, 0, None

    def _put(self, data: bytes) -> None:
        packed = self.member.compress(data)
        self.bytes += len(packed)
        self.stream.write(packed)

    def begin(self, head: dict) -> None:
        self.end()
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.records += 1
        for part in _header(head, head["size"] if head["refers_to"] is None else 0):
            self._put(part)

    def add(self, data: bytes) -> None:
        if data:
            self._put(data)

    def end(self) -> None:
        if self.member is not None:
            self._put(_END)
            rest = self.member.flush()
            self.bytes += len(rest)
            self.stream.write(rest)
            self.member = None


def _open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_archives(records: DataFrame, folder: str, size: int = CHUNK) -> DataFrame:
    """Write an archive for each task; returns the stored table of archives that count."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, name = None, f"{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            for head, data in zip(batch.column("head"), batch.column("data")):
                if archive is None:
                    system, path = _open_folder(folder)
                    system.create_dir(path, recursive=True)
                    archive = Archive(system.open_output_stream(f"{path}/{name}", compression=None))
                if head.is_valid:
                    archive.begin(head.as_py())
                archive.add(data.as_py())
        if archive is not None:
            archive.end()
            archive.stream.close()
            yield pa.RecordBatch.from_pylist([{"archive": f"{folder}/{name}", "records": archive.records, "bytes": archive.bytes}])

    return stored(chunk_rows(records, size).mapInArrow(write, _WRITTEN), "archives")


class _Members:
    """The bytes of an archive's records: each gzip member is a stream of its own, read by pieces."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.packed, self.ready, self.member = stream, size, b"", bytearray(), None

    def next_member(self) -> bool:
        """Go to the next record, which leaves what is left of this one."""
        while self.member is not None and not self.member.eof:
            self._fill()
            self.ready.clear()
        self.ready.clear()
        if self.member is not None:
            self.packed = self.member.unused_data or self.packed
        if not self.packed:
            self.packed = self.stream.read(self.size)
        self.member = zlib.decompressobj(31) if self.packed else None
        return self.member is not None

    def _fill(self) -> bool:
        if self.member.eof:
            return False
        if not self.packed:
            self.packed = self.stream.read(self.size)
            if not self.packed:
                raise ValueError("archive ends inside a record")
        self.ready += self.member.decompress(self.packed, self.size)
        self.packed = self.member.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        """Header bytes up to ``mark``, which is taken off."""
        while (at := self.ready.find(mark)) < 0:
            if not self._fill():
                raise ValueError("record without a complete header")
        out = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        """Exactly ``n`` bytes."""
        while len(self.ready) < n:
            if not self._fill():
                raise ValueError("record is shorter than it says")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def read_chunks(stream, size: int = CHUNK) -> Iterator[dict]:
    """Chunk rows of an archive: header values, the chunk's data, and digest and size of the payload so far."""
    members, ordinal = _Members(stream, min(size, 1 << 16)), 0
    while members.next_member():
        version, *lines = members.until(_END).decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        header = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        http = members.until(_END)
        left = int(header["content-length"]) - len(http) - len(_END)
        full = next((v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")) if k.lower() == "content-length"), "0")
        digest, done, chunk = hashlib.sha1(), 0, 0
        while True:
            data = members.take(min(size, left - done))
            digest.update(data)
            done += len(data)
            yield {"header": header, "http_length": int(full), "ordinal": ordinal, "chunk": chunk, "data": data, "size": done, "sha1": digest.copy().hexdigest(), "last": done == left}
            chunk += 1
            if done == left:
                break
        if members.take(len(_END)) != _END:
            raise ValueError("record doesn't end where it says")
        ordinal += 1


def read_archives(archives: DataFrame, size: int = CHUNK, data: bool = False) -> DataFrame:
    """The chunked record table of archives: a row for each chunk, with its bytes if ``data``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                system, path = _open_folder(archive)
                with system.open_input_stream(path, compression=None) as stream:
                    rows, held = [], 0
                    for x in read_chunks(stream, size):
                        header, revisit = x["header"], x["header"]["warc-type"] == "revisit"
                        declared = header["warc-payload-digest"].removeprefix("sha1:")
                        if x["last"] and not revisit and x["sha1"] != declared:
                            raise ValueError("a payload differs from its digest")
                        row = {
                            "archive": archive, "ordinal": x["ordinal"], "page": _page(header["warc-record-id"]), "record_type": header["warc-type"],
                            "refers_to": _page(header.get("warc-refers-to")),
                            "chunk": x["chunk"], "last": x["last"], "size": x["http_length"] if revisit else x["size"],
                            "sha1": declared if revisit else x["sha1"],
                        } | ({"data": x["data"]} if data else {})
                        rows.append(row)
                        held += len(x["data"]) if data else 0
                        if len(rows) >= 4096 or held >= 8 * size:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    columns = _READ + (", data binary" if data else "")
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in columns.split(", "))])
    # As many tasks as archives: their names are too few bytes for adaptive execution to deal them out.
    return archives.select("archive").repartition(max(1, archives.count())).mapInArrow(read, columns)


def op2_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(plan_records(table(spark, sf_dir, "pages")), new_folder(spark, "warc"))
    ends = read_archives(archives).where("last")
    return ends.select(
        F.col("page").cast("long").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )


SQL = """WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
kept AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS keeper FROM sized)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to FROM kept"""

QUERIES = {"op2_warc_records": (op2_warc_records, SQL)}
