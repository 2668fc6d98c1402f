"""WARC archives as a table of chunks.

Writing: payloads leave Spark as rows of one chunk each, in the order of their record, and
a task streams them into compressed archives, one gzip member a record. Reading: a task
streams an archive and gives one row per record and chunk number. A row carries the place
of its chunk and the SHA-1 of the payload up to its end, so the last row of a record has
the payload's size and digest. Neither side ever holds a whole record: memory is bounded
by the chunk, however large the payload.

Of the pages with equal payloads (by SHA-1 and size) of at least `least` bytes, the one
with the largest page_id is written as a response and the others as revisits that name it
(of equal page_ids that with the largest url). Which pages these are is found on rows
without payloads; payloads are shuffled only where the list of revisits is too large to
broadcast.

Rows with equal page_id, url and payload: one is the response, the others revisit it. A
null page_id is the smallest, and `refers_to` is null where the response has none. A null
payload is empty, a null url is left out, and control characters in a url are escaped. An
empty table gives no records. Columns beyond these three are ignored. Payloads may be as
long as Spark's own strings.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrail.llm.frames import partitions, settled, shared_folder

# Bytes of a payload in one row.
CHUNK_BYTES = 1 << 18
# Compressed bytes after which a task begins another archive.
FILE_BYTES = 64 << 20

# The format's version, and the profile of a revisit with an equal payload.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = "path string, records long, bytes long"
CHUNKS = (
    "page_id long, record_id string, url string, record_type string, refers_to long, chunk int, "
    "start long, length int, is_last boolean, digest string, data binary"
)


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1: five hexadecimal digits are four of base32."""
    fives = [F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 32) for i in range(8)]
    digits = F.concat(*[F.lpad(five, 4, "0") for five in fives])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _payloads(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    return rows.withColumns({"digest": base32(F.sha1("payload")), "size": F.octet_length("payload").cast("long")})


KEY = ("page_id", "url", "digest")


def _same(a: DataFrame, b: DataFrame, columns: Iterable[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def _copies(pages: DataFrame, least: int) -> DataFrame:
    """Pages whose payload another row has too: how often each is there, and its response."""
    counted = _payloads(pages).where(F.col("size") >= least).groupBy(*KEY, "size").agg(F.count(F.lit(1)).alias("times"))
    first = counted.groupBy("digest", "size").agg(
        F.max(F.struct("page_id", "url")).alias("response"), F.sum("times").alias("_all")
    )
    copies = counted.join(first.where("_all > 1"), ["digest", "size"])
    own = F.struct("page_id", "url").eqNullSafe(F.col("response"))
    return copies.select(*KEY, "size", "times", own.alias("is_response"), F.col("response.page_id").alias("refers_to"))


def _in_chunks(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk of a payload, the chunks of a record in order and side by side."""
    last = F.floor(F.greatest(F.col("size") - 1, F.lit(0)) / F.lit(chunk_bytes)).cast("int")
    numbered = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    data = F.substring(F.col("payload"), F.col("chunk") * F.lit(chunk_bytes) + 1, F.lit(chunk_bytes))
    return numbered.select(*KEY, "size", "chunk", data.alias("data"), F.lit(None).cast("long").alias("refers_to"), F.lit(0).alias("copy"))


def records(pages: DataFrame, folder: str, least: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """What the archives are to hold: chunks of responses, and a row without data per revisit."""
    spark = pages.sparkSession
    place = f"{folder}/copies"
    _copies(pages, least).write.mode("overwrite").parquet(place)
    # A table of files: Spark knows its size when it chooses between broadcast and shuffle.
    copies = spark.read.parquet(place)
    payloads = _payloads(pages)
    apart = copies.where("not is_response or times > 1")
    single = payloads.join(apart, _same(payloads, apart, KEY), "left_anti")
    repeated = copies.where("is_response and times > 1")
    one_of = payloads.join(repeated, _same(payloads, repeated, KEY), "left_semi").dropDuplicates(KEY)
    responses = _in_chunks(single, chunk_bytes).unionByName(_in_chunks(one_of, chunk_bytes))
    begin = F.when(F.col("is_response"), 1).otherwise(0)
    revisits = copies.where(F.col("times") > begin).select(
        *KEY,
        "size",
        F.lit(0).alias("chunk"),
        F.lit(None).cast("binary").alias("data"),
        "refers_to",
        F.explode(F.sequence(begin, (F.col("times") - 1).cast("int"))).alias("copy"),
    )
    return responses.withColumn("revisit", F.lit(False)).unionByName(revisits.withColumn("revisit", F.lit(True)))


def file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """A folder as pyarrow opens it."""
    scheme, colon, rest = folder.partition(":")
    if not colon:
        return pa.fs.LocalFileSystem(), folder
    if not rest.startswith("//"):
        rest = f"//{rest}"
    return pa.fs.FileSystem.from_uri(f"{ {'s3a': 's3'}.get(scheme, scheme)}:{rest}")


def record_name(page_id: int | None, digest: str, copy: int) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{digest}:{copy}"


def http_head(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def record_head(row: dict) -> bytes:
    """Header of a record and, as the start of its block, that of the answer it holds."""
    http = http_head(row["size"])
    block = len(http) + (0 if row["revisit"] else row["size"])
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if row['revisit'] else 'response'}",
        f"WARC-Record-ID: <{record_name(row['page_id'], row['digest'], row['copy'])}>",
        # The time is no part of the table.
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {quote(row['url'], safe=':/?#[]@!$&()*+,;=%~\'')}")
    if row["revisit"]:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_name(row['refers_to'], row['digest'], 0)}>"]
    lines.append(f"Content-Length: {block}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class Archive:
    """One archive that is being written."""

    def __init__(self, system: pa.fs.FileSystem, path: str):
        self.path, self.records, self.bytes = path, 0, 0
        self._file = system.open_output_stream(path, compression=None)
        self._member = None

    def _put(self, data: bytes) -> None:
        self._file.write(data)
        self.bytes += len(data)

    def begin(self, head: bytes) -> None:
        self._member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.records += 1
        self._put(self._member.compress(head))

    def add(self, data: bytes | None) -> None:
        if data:
            self._put(self._member.compress(data))

    def end(self) -> None:
        self._put(self._member.compress(b"\r\n\r\n") + self._member.flush())

    def close(self) -> dict:
        self._file.close()
        return {"path": self.path, "records": self.records, "bytes": self.bytes}


def archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write records as archives under `folder`; the rows name the files that count.

    A task that is repeated writes other files, and only those of the attempt that
    succeeded are in the list.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        context, number, archive, sent = TaskContext.get(), 0, None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["chunk"] == 0:
                    if archive is None:
                        name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.warc.gz"
                        archive, number = Archive(system, f"{root}/{name}"), number + 1
                    archive.begin(record_head(row))
                    sent = 0
                archive.add(row["data"])
                sent += len(row["data"] or b"")
                if row["revisit"] or sent == row["size"]:
                    archive.end()
                    if archive.bytes >= file_bytes:
                        yield pa.RecordBatch.from_pylist([archive.close()])
                        archive = None
        if archive is not None:
            yield pa.RecordBatch.from_pylist([archive.close()])

    file_system(folder)[0].create_dir(file_system(folder)[1], recursive=True)
    # Written down: reading the list again must not write the archives again.
    return settled(rows.mapInArrow(write, FILES))


@dataclass
class Block:
    """A record's header, and how much of its block is still to be read."""

    fields: dict[str, str] = field(default_factory=dict)
    left: int = 0

    def named(self, key: str) -> tuple[int | None, str | None]:
        """Page and name of the record that a field names."""
        if key not in self.fields:
            return None, None
        name = self.fields[key].strip("<>")
        page = name.split(":")[2] if name.startswith("urn:page:") else ""
        return int(page) if page else None, name


def _fields(stream: io.BufferedReader) -> tuple[dict[str, str], int]:
    """Header lines up to the empty one, with lower-case names, and the bytes they take."""
    found, taken = {}, 0
    while line := stream.readline():
        taken += len(line)
        text = line.decode("utf-8").rstrip("\r\n")
        if not text:
            break
        name, _, value = text.partition(":")
        found[name.strip().lower()] = value.strip()
    return found, taken


def blocks(stream: io.BufferedReader) -> Iterator[Block]:
    """Records of an archive one after the other; what a reader leaves of a block is skipped."""
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:80]!r}")
        block = Block(_fields(stream)[0])
        block.left = int(block.fields["content-length"])
        yield block
        while block.left:
            skipped = len(stream.read(min(block.left, CHUNK_BYTES)))
            if not skipped:
                raise EOFError("an archive ends inside a record")
            block.left -= skipped


def _base32(digest: hashlib._hashlib.HASH) -> str:
    return base64.b32encode(digest.digest()).decode()


def payload_chunks(stream: io.BufferedReader, block: Block, chunk_bytes: int, content: bool) -> Iterator[dict]:
    """Rows of one record. A revisit has no payload of its own: its size and digest are
    those that its record states. The digest of a response must be the one it states."""
    head, taken = {}, 0
    if block.fields.get("content-type", "").startswith("application/http"):
        taken = len(stream.readline())
        head, more = _fields(stream)
        taken += more
    block.left -= taken
    kind = block.fields["warc-type"]
    stated = block.fields.get("warc-payload-digest", "").rpartition(":")[2]
    page, name = block.named("warc-record-id")
    refers_to, _ = block.named("warc-refers-to")
    row = {
        "page_id": page,
        "record_id": name,
        "url": block.fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": refers_to,
    }
    if kind == "revisit":
        size = int(head.get("content-length", 0))
        yield row | {"chunk": 0, "start": size, "length": 0, "is_last": True, "digest": stated, "data": None}
        return
    digest, start, number = hashlib.sha1(), 0, 0
    while True:
        data = stream.read(min(chunk_bytes, block.left))
        if len(data) < min(chunk_bytes, block.left):
            raise EOFError(f"{name} ends before its block")
        block.left -= len(data)
        digest.update(data)
        last = not block.left
        if last and stated and _base32(digest) != stated:
            raise ValueError(f"{name}: payload has another digest than stated")
        yield row | {
            "chunk": number,
            "start": start,
            "length": len(data),
            "is_last": last,
            "digest": _base32(digest),
            "data": data if content else None,
        }
        start, number = start + len(data), number + 1
        if last:
            return


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row["data"] or b"")
        if size >= most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
_SCHEMA = pa.schema([(name, _KINDS[kind]) for name, kind in (part.split() for part in CHUNKS.split(", "))])


def chunk_table(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, content: bool = True) -> DataFrame:
    """Chunks of all records in the archives that `files` names by `path`.

    `digest` is that of the payload up to the end of the chunk. Without `content` the rows
    are the same, but for `data`.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, place = file_system(path)
                with system.open_input_stream(place, compression=None) as raw:
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw, CHUNK_BYTES)
                    rows = (row for block in blocks(stream) for row in payload_chunks(stream, block, chunk_bytes, content))
                    yield from _batches(rows, _SCHEMA, 4 * CHUNK_BYTES)

    dealt = files.select("path").repartition(partitions(files))
    return dealt.mapInArrow(read, CHUNKS)


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of a folder, as `chunk_table` takes them; only their names are read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select("path")


def record_table(chunks: DataFrame) -> DataFrame:
    """One row per record: what the row of its last chunk carries."""
    return chunks.where("is_last").select(
        "page_id",
        (F.col("start") + F.col("length")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def archived(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write all pages as archives below the shared folder, and what reading them back gives."""
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    files = archives(records(pages, folder, least), f"{folder}/archives")
    return record_table(chunk_table(files, content=False))
