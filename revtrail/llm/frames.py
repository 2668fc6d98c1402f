"""What every operator on documents shares: batches, packed chunks, settled tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that one step of a task holds as arrays.
SLICE_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which the driver and all executors see; a local
    session without one gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settled(rows: DataFrame) -> DataFrame:
    """Write rows to the shared folder of `spark.checkpoint.dir` and read them from there."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def stored(rows: DataFrame) -> DataFrame:
    """As `settled`, but in compressed columns: for wide rows of which each later step reads a few."""
    folder = f"{shared_folder(rows.sparkSession)}/rows-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def texts_in(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """Slices of a text column as (start, stop, bytes); only one slice is in Python at a time."""
    raw = column.cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(raw), 0).to_pylist()
    for start, stop in slices((size + 64 for size in sizes), most):
        yield start, stop, raw.slice(start, stop - start).to_pylist()
    # what a batch needed goes back to the system, not to the next batch of this worker alone
    pa.default_memory_pool().release_unused()


def slices(sizes: Iterable[int], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of items that hold about `most` bytes; one item may hold more."""
    start = held = 0
    stop = 0
    for stop, size in enumerate(sizes, 1):
        held += size
        if held >= most:
            yield start, stop
            start, held = stop, 0
    if start < stop:
        yield start, stop


def documents_in(
    batches: Iterable[pa.RecordBatch], most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of (rows, texts); the second column holds the text."""
    for batch in batches:
        for start, stop, texts in texts_in(batch.column(1), most):
            yield batch.slice(start, stop - start), texts


def ids_of(batch: pa.RecordBatch) -> pa.Array:
    return batch.column(0)


def per_text(judge: Callable[[list[bytes | None]], list[pa.Array]], kind: str) -> Callable[[Column], Column]:
    """A column function over texts: `judge` answers a slice of texts with one array a field."""
    names = [part.split()[0] for part in kind.split(", ")]

    def answer(column: pa.Array) -> pa.Array:
        parts = [judge(texts) for _, _, texts in texts_in(column)] or [judge([])]
        return pa.concat_arrays([pa.StructArray.from_arrays(part, names=names) for part in parts])

    # the types are given in full: `from __future__ import annotations` hides them from Spark
    answer.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(answer, f"struct<{', '.join(p.replace(' ', ': ', 1) for p in kind.split(', '))}>")


class Chunk:
    """Documents that are worked on together: ids (0 where not known), and texts as bytes in
    one string (null texts are empty)."""

    def __init__(self, number: int, ids: np.ndarray, known: np.ndarray, sizes: np.ndarray, data: bytes):
        self.number, self.ids, self.known, self.data = number, ids, known, data
        self.sizes = np.maximum(sizes, 0).astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    @classmethod
    def unpacked(cls, row: dict) -> Chunk:
        sizes = np.frombuffer(row["sizes"], "<i4")
        whole = max(1, int(np.maximum(sizes, 0).sum()))
        return cls(
            row["chunk"],
            np.frombuffer(row["ids"], "<i8"),
            np.frombuffer(row["known"], np.uint8).astype(bool),
            sizes,
            zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=whole),
        )

    def __len__(self) -> int:
        return len(self.sizes)

    def texts(self) -> list[bytes]:
        return [self.data[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]

    def id_list(self) -> list[int | None]:
        return [i if k else None for i, k in zip(self.ids.tolist(), self.known.tolist())]


def in_chunks(
    docs: DataFrame, work: Callable[[Chunk], pa.RecordBatch], schema: str, most: int = SLICE_BYTES
) -> DataFrame:
    """One batch of rows for each chunk of about `most` bytes of text.

    A chunk is numbered by its input partition and its place there, so a repeated task and
    every other pass over the same documents give the same chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch, texts in documents_in(batches, most):
            ids = ids_of(batch)
            known = np.asarray(ids.is_valid(), dtype=bool)
            values = np.asarray(ids.fill_null(0), dtype="<i8")
            sizes = np.asarray([-1 if t is None else len(t) for t in texts], dtype="<i4")
            yield work(Chunk(number, values, known, sizes, b"".join(t for t in texts if t)))
            number += 1

    return id_and_text(docs).mapInArrow(run, schema)


def numbered(docs: DataFrame, most: int = SLICE_BYTES) -> DataFrame:
    """Where `packed` puts each document: chunk, place in it, doc_id."""

    def number(chunk: Chunk) -> pa.RecordBatch:
        places = pa.array(range(len(chunk)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk.number] * len(chunk), pa.int64()), places, pa.array(chunk.id_list(), pa.int64())],
            names=["chunk", "number", "doc_id"],
        )

    return in_chunks(docs, number, "chunk long, number int, doc_id long", most)


def packed(docs: DataFrame, most: int = SLICE_BYTES, level: int = 1) -> DataFrame:
    """Chunks as rows with compressed texts; shuffling them moves a third of the bytes."""

    def pack(chunk: Chunk) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([chunk.number], pa.int64()),
                "ids": [chunk.ids.tobytes()],
                "known": [chunk.known.astype(np.uint8).tobytes()],
                "sizes": [chunk.sizes.astype("<i4").tobytes()],
                "data": [zstandard.ZstdCompressor(level=level).compress(chunk.data)],
            }
        )

    return in_chunks(docs, pack, "chunk long, ids binary, known binary, sizes binary, data binary", most)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
