"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts symbols: every byte is one, but ASCII letters of either case are the
same. Its n-grams of up to `order` symbols are counted over
every trusted document, labelled good and not toxic. Counting and the levels of the model
are joins and aggregates over n-gram keys: the highest level uses counts, lower levels the
number of different symbols seen before; each level has three discounts from its counts of
counts; probabilities are interpolated from the lowest level up.

To score, a chunk of documents asks for the distinct n-grams it holds, in one row per
shard of keys; shards join the questions to the model and answer with probabilities and
back-off weights. A chunk asks once for an n-gram however often it occurs.

A document is kept if its perplexity is at most the `quantile` of the trusted documents of
its language, widened by `slack`. Languages with fewer than `enough` trusted documents, and
documents without a language, use the quantile of all trusted documents.

Null and empty texts have no perplexity and are not kept. Without trusted documents the
model is uniform and every text is kept. Labels may repeat: a document is trusted if any
label says so. Rows with equal ids are judged each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrail.llm.frames import Chunk, in_chunks, numbered, packed, partitions, rows_of, settled
from revtrail.llm.keys import batch_of
from revtrail.llm.words import mix

BITS = 8
ORDER = 4
# Bits of the longest n-gram; its size stands above them.
_TOP = np.uint64(BITS * ORDER)
CHUNK_BYTES = 8 << 20
_STEP = 1 << 20


@dataclass(frozen=True)
class Rule:
    quantile: float = 0.99
    slack: float = 1.1
    enough: int = 50


def classes() -> np.ndarray:
    """The symbol of each byte: letters, the line end, then all other bytes in order."""
    letters = np.arange(ord("a"), ord("z") + 1)
    out = np.zeros(256, dtype=np.uint32)
    out[letters] = out[letters - 32] = np.arange(len(letters))
    out[ord("\n")] = len(letters)
    rest = np.setdiff1d(np.arange(256), [*letters, *(letters - 32), ord("\n")])
    out[rest] = len(letters) + 1 + np.arange(len(rest))
    return out


CLASS = classes()
SYMBOLS = int(CLASS.max()) + 1
LEAD = b"\n" * (ORDER - 1)


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of `ORDER` symbols for each byte of each text, in order, and the texts' sizes."""
    data = np.frombuffer(b"".join(LEAD + t for t in texts), np.uint8)
    symbols = CLASS[data]
    keys = np.zeros(len(symbols), dtype=np.uint32)
    for back in range(ORDER):
        keys[back:] |= symbols[: len(symbols) - back] << np.uint32(BITS * back)
    sizes = np.asarray([len(t) for t in texts], dtype=np.int64)
    own = np.ones(len(symbols), dtype=bool)
    starts = np.cumsum(sizes + len(LEAD)) - sizes - len(LEAD)
    for j in range(len(LEAD)):
        own[starts + j] = False
    return keys[own], sizes


def steps(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a megabyte."""
    start = held = 0
    for stop, text in enumerate(texts, 1):
        held += len(text)
        if held >= _STEP or stop == len(texts):
            yield start, stop
            start, held = stop, 0


def tally(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the highest order, sorted, and how often each occurs."""
    parts = [np.unique(ngrams(texts[a:b])[0], return_counts=True) for a, b in steps(texts)]
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    grams, place = np.unique(np.concatenate([held for held, _ in parts]), return_inverse=True)
    counts = np.zeros(len(grams), dtype=np.int64)
    np.add.at(counts, place, np.concatenate([often for _, often in parts]))
    return grams, counts


COUNTS = "gram long, n long"


def trusted_counts(chunks: DataFrame, spots: DataFrame) -> DataFrame:
    """Counts of the highest order over the documents listed by chunk in `spots`."""
    listed = spots.groupBy("chunk").agg(F.collect_set("number").alias("numbers"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            texts = Chunk.unpacked(row).texts()
            held, counts = tally([texts[i] for i in sorted(row["numbers"])])
            yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int64)), pa.array(counts)], names=["gram", "n"])

    return chunks.join(listed, "chunk").mapInArrow(count, COUNTS).groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(of: dict[int, int]) -> tuple[float, float, float]:
    """Discounts for counts of 1, 2 and more, from how many n-grams have counts of 1 to 4."""
    one, two, three, four = (of.get(i, 0) for i in (1, 2, 3, 4))
    if not one or not two:
        return 0.5, 0.5, 0.5
    share = one / (one + 2 * two)
    found = [1 - 2 * share * two / one, 2 - 3 * share * three / two]
    found.append(3 - 4 * share * four / three if three else found[-1])
    return tuple(min(max(d, 0.05), float(i)) for i, d in enumerate(found, 1))


def model(counts: DataFrame) -> DataFrame:
    """Rows (size, gram, p, weight): probability of the last symbol after the others, and the
    back-off weight of the n-gram as a context of the next level."""
    levels = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << BITS * size) - 1).alias("gram")
        levels[size] = settled(levels[size + 1].select(suffix).groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    known, below = [], None
    for size in range(1, ORDER + 1):
        level = levels[size]
        of = {r["n"]: r["many"] for r in level.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("many")).collect()}
        few = discounts(of)
        cut = F.when(F.col("n") == 1, few[0]).when(F.col("n") == 2, few[1]).otherwise(few[2])
        cut = F.least(cut, F.col("n").cast("double"))
        level = level.withColumn("context", F.shiftright("gram", BITS)).withColumn("cut", cut)
        sums = level.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("held"))
        level = level.join(sums, "context")
        if below is None:
            lower = F.lit(1 / SYMBOLS)
        else:
            level = level.withColumn("suffix", F.col("gram").bitwiseAND((1 << BITS * (size - 1)) - 1))
            lower = F.col("lower")
            level = level.join(below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower")), "suffix")
        p = (F.col("n") - F.col("cut")) / F.col("total") + F.col("held") / F.col("total") * lower
        below = settled(level.select("gram", p.alias("p")))
        known.append(below.select(F.lit(size).alias("size"), "gram", "p", F.lit(None).cast("double").alias("weight")))
        known.append(
            sums.select(
                F.lit(size - 1).alias("size"),
                F.col("context").alias("gram"),
                F.lit(None).cast("double").alias("p"),
                (F.col("held") / F.col("total")).alias("weight"),
            )
        )
    every = known[0]
    for some in known[1:]:
        every = every.unionByName(some)
    return every.groupBy("size", "gram").agg(F.max("p").alias("p"), F.max("weight").alias("weight"))


def tagged(size: int, grams: np.ndarray) -> np.ndarray:
    """One key for n-grams of all sizes: the size above the symbols."""
    return (np.uint64(size) << _TOP) | grams.astype(np.uint64)


def questions(texts: list[bytes]) -> np.ndarray:
    """Sorted keys of the n-grams of all sizes, and of their contexts, that a chunk needs."""
    full = tally(texts)[0]
    keys = [tagged(0, np.zeros(1, np.uint32)), tagged(ORDER, full)]
    for size in range(1, ORDER):
        mask = np.uint32((1 << BITS * size) - 1)
        grams = np.concatenate([full & mask, (full >> np.uint32(BITS)) & mask])
        keys.append(tagged(size, np.unique(grams)))
    return np.sort(np.concatenate(keys))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys) % np.uint64(shards)).astype(np.int64)


ASKED = "shard int, chunk long, keys binary"
TOLD = "chunk long, shard int, p binary, weight binary"


def tell(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Answers of one shard, in the order of each question; nothing known is not a number."""
    size = known["size"].to_numpy().astype(np.uint64)
    keys = (size << _TOP) | known["gram"].to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    keys = np.append(keys[order], np.iinfo(np.uint64).max)
    values = {}
    for name in ("p", "weight"):
        column = known[name].to_numpy(zero_copy_only=False).astype(np.float64)[order]
        values[name] = np.append(np.log(column), np.nan).astype("<f4")
    out = []
    for row in asked.to_pylist():
        wanted = np.frombuffer(row["keys"], "<u8")
        at = np.searchsorted(keys, wanted)
        at[keys[at] != wanted] = len(keys) - 1
        below = wanted >> _TOP < ORDER
        out.append(
            {
                "chunk": row["chunk"],
                "shard": row["shard"],
                "p": values["p"][at].tobytes(),
                "weight": values["weight"][at[below]].tobytes(),
            }
        )
    return pa.Table.from_batches([batch_of(out, TOLD)])


def log_table(keys: np.ndarray, told: list[dict], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the highest order that the chunk holds, sorted, and their log probabilities."""
    where = shard_of(keys, shards)
    p = np.full(len(keys), np.nan, dtype=np.float64)
    weight = np.full(len(keys), np.nan, dtype=np.float64)
    below = keys >> _TOP < ORDER
    for answer in told:
        own = np.flatnonzero(where == answer["shard"])
        p[own] = np.frombuffer(answer["p"], "<f4")
        weight[own[below[own]]] = np.frombuffer(answer["weight"], "<f4")
    full = keys[keys >> _TOP == ORDER].astype(np.uint32)
    total = np.zeros(len(full))
    open_ = np.ones(len(full), dtype=bool)
    for size in range(ORDER, 0, -1):
        mask = np.uint32((1 << BITS * size) - 1)
        own = p[np.searchsorted(keys, tagged(size, full & mask))]
        done = open_ & ~np.isnan(own)
        total[done] += own[done]
        open_ &= ~done
        context = weight[np.searchsorted(keys, tagged(size - 1, (full & mask) >> np.uint32(BITS)))]
        back = open_ & ~np.isnan(context)
        total[back] += context[back]
    total[open_] += np.log(1 / SYMBOLS)
    return full, total


def perplexities(texts: list[bytes], grams: np.ndarray, logs: np.ndarray) -> list[float | None]:
    out: list[float | None] = []
    for a, b in steps(texts):
        keys, sizes = ngrams(texts[a:b])
        sums = np.concatenate([[0.0], np.cumsum(logs[np.searchsorted(grams, keys)])])
        ends = np.cumsum(sizes)
        for start, end in zip((ends - sizes).tolist(), ends.tolist()):
            out.append(float(np.exp((sums[start] - sums[end]) / (end - start))) if end > start else None)
    return out


SCORED = "chunk long, number int, doc_id long, perplexity double"


def scored(docs: DataFrame, chunks: DataFrame, known: DataFrame) -> DataFrame:
    shards = partitions(chunks)

    def ask(chunk: Chunk) -> pa.RecordBatch:
        keys = questions(chunk.texts())
        where = shard_of(keys, shards)
        rows = [
            {"shard": s, "chunk": chunk.number, "keys": keys[where == s].astype("<u8").tobytes()}
            for s in np.unique(where).tolist()
        ]
        return batch_of(rows, ASKED)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            chunk = Chunk.unpacked(row)
            texts = chunk.texts()
            found = perplexities(texts, *log_table(questions(texts), row["told"], shards))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk.number] * len(chunk), pa.int64()),
                    pa.array(range(len(chunk)), pa.int32()),
                    pa.array(chunk.id_list(), pa.int64()),
                    pa.array(found, pa.float64()),
                ],
                names=[part.split()[0] for part in SCORED.split(", ")],
            )

    def shard(size: Column, gram: Column) -> Column:
        return shard_udf(shards)(size, gram)

    asked = in_chunks(docs, ask, ASKED, CHUNK_BYTES)
    placed = known.withColumn("shard", shard(F.col("size"), F.col("gram")))
    told = asked.groupBy("shard").cogroup(placed.groupBy("shard")).applyInArrow(tell, TOLD)
    told = told.groupBy("chunk").agg(F.collect_list(F.struct("shard", "p", "weight")).alias("told"))
    return chunks.join(told, "chunk").mapInArrow(score, SCORED)


def shard_udf(shards: int):
    """The shard of a model row, as the chunks compute it."""

    def place(size: pa.Array, gram: pa.Array) -> pa.Array:
        keys = (size.to_numpy().astype(np.uint64) << _TOP) | gram.to_numpy().astype(np.uint64)
        return pa.array(shard_of(keys, shards).astype(np.int32))

    place.__annotations__ = {"size": pa.Array, "gram": pa.Array, "return": pa.Array}
    return F.arrow_udf(place, "int")


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    return good.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()


def quality(docs: DataFrame, labels: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, lang, perplexity, the limit of its language, and whether it is kept."""
    trusted = trusted_ids(labels)
    chunks = packed(docs, CHUNK_BYTES)
    spots = numbered(docs, CHUNK_BYTES)
    counts = settled(trusted_counts(chunks, spots.join(trusted, "doc_id")))
    found = settled(scored(docs, chunks, model(counts)))

    langs = docs.select(F.col("doc_id").cast("long"), "lang").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    same = found["doc_id"].eqNullSafe(langs["doc_id"])
    judged = found.join(langs, same, "left").select(found["doc_id"], "lang", "perplexity")
    judged = settled(judged.join(trusted.withColumn("trusted", F.lit(True)), "doc_id", "left"))
    own = judged.where("trusted and perplexity is not null")
    limit = F.percentile_approx("perplexity", rule.quantile, 10_000) * rule.slack
    overall = own.agg(limit.alias("limit")).first()["limit"]
    limits = own.groupBy("lang").agg(limit.alias("own_limit"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= rule.enough)
    limited = judged.join(limits.drop("n"), "lang", "left")
    bound = F.coalesce("own_limit", F.lit(float("inf") if overall is None else overall))
    return limited.select(
        "doc_id",
        "lang",
        "perplexity",
        bound.alias("limit"),
        F.coalesce(F.col("perplexity") <= bound, F.lit(False)).alias("kept"),
    )

