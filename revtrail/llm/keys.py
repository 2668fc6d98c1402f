"""Which keys occur more than once in a corpus of chunks, told back to each chunk.

A chunk sends the sorted distinct keys it holds with how often it holds them, in one row
per bucket of keys; a bucket sends back, to each chunk, those that occur elsewhere too.
A key held by every document costs one entry a chunk, so no bucket grows with a copied
text or a common line beyond the number of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.llm.frames import partitions

SENT = "bucket int, chunk long, keys binary, times binary"
TOLD = "chunk long, shared binary, hot binary"


def bucket_count(rows: DataFrame) -> int:
    """Several buckets a partition, so that partitions come out even."""
    return 4 * partitions(rows)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def sent(chunk: int, keys: np.ndarray, buckets: int) -> Iterator[dict]:
    """Rows for the keys of one chunk, given with repeats."""
    held, times = np.unique(keys, return_counts=True)
    places = bucket_of(held, buckets).astype(np.int64)
    cuts = np.flatnonzero(np.diff(places)) + 1
    times = np.minimum(times, np.iinfo(np.uint32).max).astype("<u4")
    for own, often, where in zip(np.split(held, cuts), np.split(times, cuts), np.split(places, cuts)):
        if len(own):
            yield {"bucket": int(where[0]), "chunk": chunk, "keys": own.astype("<u8").tobytes(), "times": often.tobytes()}


def batch_of(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "string": pa.string()}
    fields = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[name] for r in rows], kinds[kind]) for name, kind in fields], names=[f[0] for f in fields]
    )


def told(table: pa.Table, hot: int) -> list[dict]:
    """Rows for the chunks that sent keys to one bucket."""
    chunks = table["chunk"].to_pylist()
    keys = [np.frombuffer(k, "<u8") for k in table["keys"].to_pylist()]
    times = np.concatenate([np.frombuffer(t, "<u4") for t in table["times"].to_pylist()])
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=times)[place]
    out, start = [], 0
    for chunk, own in zip(chunks, keys):
        often = total[start : start + len(own)]
        start += len(own)
        if (often > 1).any():
            out.append(
                {
                    "chunk": chunk,
                    "shared": own[often > 1].astype("<u8").tobytes(),
                    "hot": own[often >= hot].astype("<u8").tobytes(),
                }
            )
    return out


def shared_keys(rows: DataFrame, hot: int) -> DataFrame:
    """Per chunk the lists of its keys that occur twice or more, and `hot` times or more."""

    def tell(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([batch_of(told(table, hot), TOLD)])

    found = rows.groupBy("bucket").applyInArrow(tell, TOLD)
    return found.groupBy("chunk").agg(
        F.collect_list("shared").alias("shared"), F.collect_list("hot").alias("hot")
    )


def key_list(parts: list[bytes]) -> np.ndarray:
    """Sorted keys from the lists that a chunk was told."""
    return np.sort(np.frombuffer(b"".join(parts), "<u8"))


def member(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among the sorted keys."""
    if not len(keys):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return keys[at] == values
