"""Near-duplicate documents by bottom-k sketches.

The sketch of a document is the `k` smallest hashes of its distinct shingles under one
hash function; a document with fewer shingles is its own sketch. Two documents with a
similarity of 0.75 have a same value among their smallest ones all but surely (a pair
shares none of the lowest 16 with a chance of 0.25^16, 2.3e-10), so inverted lists of the
lowest `heads` values bring all pairs together. Inside a list the union of two sketches
estimates the similarity; pairs far below the limit go (`loose` lies more than six
standard deviations under it; the binomial tail of 64 draws is 1.3e-09). A pair at the limit
that nothing else connects is missed by one or the other with a chance of 1.5e-09. What is left connects documents to groups, and within a
group the full shingle sets decide every link.

Documents with equal sets are one class from the start, so copies are never paired.
Null and empty texts have no shingles, no links, and their own id as component. Rows
with equal id and text are linked like other copies. A component whose ids are all null
has a null id. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.llm.frames import documents_in, id_and_text, ids_of, settled
from revtrail.llm.links import BLOCK, Test, components, distinct_lists, in_blocks, jaccard_test, link_lists
from revtrail.llm.words import Words, windows

WIDTH = 5
K = 64
HEADS = 16
LOOSE = 0.4
PERCENT = 75


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text; a shorter text is one shingle."""
    words = Words([t.lower() if t else t for t in texts])  # bytes: A-Z only
    hashes = words.hashes()
    every = windows(hashes, width)
    sets = []
    for start, count in zip(words.starts.tolist(), words.counts.tolist()):
        if count >= width:
            sets.append(np.unique(every[start : start + count - width + 1]))
        elif count:
            sets.append(windows(hashes[start : start + count], count))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def digest(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes()) if len(shingles) else None


SIGNED = "doc_id long, mark long, n_shingles long, digest binary, sketch binary, heads array<long>"


def signatures(docs: DataFrame, k: int = K, heads: int = HEADS, width: int = WIDTH) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in documents_in(batches):
            sets = shingle_sets(texts, width)
            yield pa.RecordBatch.from_arrays(
                [
                    ids_of(batch),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.array([s[:k].astype("<u8").tobytes() for s in sets], pa.binary()),
                    pa.array([s[:heads].view(np.int64).tolist() for s in sets], pa.list_(pa.int64())),
                ],
                names=[part.split()[0] for part in SIGNED.split(", ")],
            )

    marked = id_and_text(docs).withColumn("mark", F.xxhash64("text"))
    return marked.mapInArrow(sign, SIGNED)


def sketch_test(k: int, loose: float) -> Callable[[list[np.ndarray]], Test]:
    """Estimate of the similarity from the part of two sketches in which both are complete."""

    def over(sketches: list[np.ndarray]) -> Test:
        # short sketches are whole sets: complete up to the largest number
        table = np.full((len(sketches), k), np.iinfo(np.uint64).max, dtype=np.uint64)
        sizes = np.asarray([len(s) for s in sketches], dtype=np.int64)
        for row, sketch in zip(table, sketches):
            row[: len(sketch)] = sketch
        last = table[:, -1]

        def linked(shared: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
            # one of the two sketches is counted whole, so the estimate needs this much of it
            able = np.flatnonzero(shared >= loose * np.minimum(sizes[one], sizes[others]))
            out = np.zeros(len(others), dtype=bool)
            out[able] = estimate(shared[able], one, others[able])
            return out

        def estimate(shared: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
            upto = np.minimum(last[one], last[others])[:, None]
            own = np.minimum((table[one][None, :] <= upto).sum(axis=1), sizes[one])
            theirs = np.minimum((table[others] <= upto).sum(axis=1), sizes[others])
            return shared >= loose * (own + theirs - shared)

        return linked

    return over


def exact_test(percent: int) -> Callable[[list[np.ndarray]], Test]:
    return lambda sets: jaccard_test(np.asarray([len(s) for s in sets], dtype=np.int64), percent)


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Shingle sets of the classes in `wanted` (digest, first_id, first_mark, canopy), from
    their texts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in documents_in(batches):
            sets = shingle_sets(texts, width)
            # another text may have the same id and hash: it is told by its digest
            right = [i for i, (s, d) in enumerate(zip(sets, batch.column(2).to_pylist())) if digest(s) == d]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(3).take(pa.array(right, pa.int64())),
                    batch.column(2).take(pa.array(right, pa.int64())),
                    pa.array([sets[i].astype("<u8").tobytes() for i in right], pa.binary()),
                ],
                names=["canopy", "member", "held"],
            )

    rows = id_and_text(docs).where("text is not null")
    # rows without an id are told apart by their texts alone, so of equal ones one is enough
    unnamed = rows.where("doc_id is null").dropDuplicates(["text"])
    texts = rows.where("doc_id is not null").unionByName(unnamed).withColumn("mark", F.xxhash64("text"))
    same = texts["doc_id"].eqNullSafe(wanted["first_id"]) & (texts["mark"] == wanted["first_mark"])
    found = texts.join(wanted, same).select(texts["doc_id"], "text", "digest", "canopy")
    return found.mapInArrow(read, "canopy binary, member binary, held binary")


def labelled(
    docs: DataFrame,
    percent: int = PERCENT,
    width: int = WIDTH,
    k: int = K,
    heads: int = HEADS,
    loose: float = LOOSE,
    block: int = BLOCK,
) -> DataFrame:
    """Every row with doc_id, mark (hash of the text), n_shingles, root (class of the component
    or null) and component_id."""
    signed = settled(signatures(docs, k, heads, width))
    classes = (
        signed.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"),
            F.first("sketch").alias("sketch"),
            F.first("heads").alias("heads"),
        )
        .select("digest", "sketch", "heads", F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark"))
    )
    listed = classes.select(F.explode("heads").alias("value"), F.col("digest").alias("member"))
    sketches = classes.select(F.col("digest").alias("member"), F.col("sketch").alias("held"))
    entries = in_blocks(distinct_lists(listed).join(sketches, "member"), block)
    canopies = components(link_lists(entries, sketch_test(k, loose), loose))

    canopies = canopies.select(F.col("node").alias("digest"), F.col("root").alias("canopy"))
    wanted = canopies.join(classes.select("digest", "first_id", "first_mark"), "digest")
    sizes = canopies.groupBy("canopy").agg(F.count(F.lit(1)).alias("n"))
    sets = full_sets(docs, wanted, width).join(sizes, "canopy")
    sets = in_blocks(sets.withColumnRenamed("canopy", "value"), block)
    roots = components(link_lists(sets, exact_test(percent), percent / 100))

    rooted = classes.select("digest", "first_id").join(
        roots.select(F.col("node").alias("digest"), "root"), "digest", "left"
    )
    rooted = rooted.withColumn("root", F.coalesce("root", "digest"))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(firsts, "root").select("digest", "root", "component_id")
    found = signed.select("doc_id", "mark", "n_shingles", "digest").join(labels, "digest", "left")
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "mark", "n_shingles", "root", own.alias("component_id"))


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_shingles, component_id and whether the document is the first of its component."""
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return labelled(docs, **how).drop("mark", "root").withColumn("kept", first)


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id
    (of rows with equal ids the one with the smallest hash of its text; of equal rows any),
    and every document without words."""
    rows = labelled(docs, **how)
    firsts = rows.where("root is not null").groupBy("root")
    firsts = firsts.agg(F.min(F.struct("doc_id", "mark")).alias("first")).select("first.*", F.lit(True).alias("once"))
    blank = rows.where("root is null").select("doc_id", "mark", F.lit(False).alias("once")).distinct()
    wanted = firsts.unionByName(blank)
    # the columns of the documents travel as one, so that no name of theirs meets one of ours
    whole = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("long").alias("row_id"),
        F.xxhash64(F.col("text").cast("string")).alias("row_mark"),
    )
    same = whole["row_id"].eqNullSafe(wanted["doc_id"]) & (whole["row_mark"] == wanted["mark"])
    kept = whole.join(wanted, same)
    once = kept.where("once").dropDuplicates(["row_id", "row_mark"])
    return once.unionByName(kept.where("not once")).select("row.*")
