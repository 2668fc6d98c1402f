"""Ranked lexical search of many items at once, sharing what they have in common.

The items are one query over all documents. Term sets that several items share are mined
first: terms that occur in the very same items are one class, and neighbouring nodes that
two items or more have side by side become a new node, round after round. Items are then
sums of few nodes. For a step of documents the accumulator of each class (the sum of its
terms' contributions, per document) is made once, inner nodes add two accumulators, and an
item adds its own. Every term of an item is in exactly one of its nodes, so scores are
those of the plain sum.

Documents are read twice, for document frequencies and for scores, and never shuffled: a
task hands on its best rows per item, and these meet by item, in two steps. Items go
through in blocks of at most about `BLOCK` pairs of item and term, which bounds what the
driver and a task hold; each block reads the documents anew.

Rows with equal item_id are one item with the terms of all of them. Items and documents
without a term (null, empty, symbols only) find nothing and are not counted. Documents
with equal ids are ranked each; a null doc_id comes last among equal scores. Empty tables
give no rows. Other columns are ignored. A long text is split at term ends and counted
piece by piece, so only its own bytes are held whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revtrail.llm.frames import SLICE_BYTES, documents_in, id_and_text, ids_of, settled

# Pairs of item and term that one pass over the documents answers.
BLOCK = 1 << 20
# Rounds in which neighbouring nodes are joined.
ROUNDS = 3
# Numbers in the accumulators of one step.
STEP = 1 << 21

# What separates terms (ASCII but digits and letters).
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes.maketrans(bytes(SEPARATORS) + _UPPER.encode(), b" " * len(SEPARATORS) + _LOWER.encode())


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct pairs of item_id and term."""
    lowered = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    found = F.explode(F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))))
    return items.select(F.col("item_id").cast("long"), found.alias("term")).distinct()


def classes(terms: DataFrame) -> DataFrame:
    """Terms with their class `node`, named by its first term: those that occur in the same
    items, which two hashes over the set of items tell, and the number of these items."""
    prints = [F.bit_xor(F.xxhash64(F.col("item_id"), F.lit(seed))).alias(f"_{seed}") for seed in (1, 2)]
    per_term = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"), *prints)
    return per_term.select("term", F.min("term").over(Window.partitionBy("n", "_1", "_2")).alias("node"), "n")


def joined(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: nodes of items (item_id, node, n) with neighbours that two items or more
    share as one, and these new nodes (node, left, right).

    Neighbours in the order of falling frequency; of overlapping pairs in an item the more
    frequent is joined.
    """
    order = Window.partitionBy("item_id").orderBy(F.desc("n"), "node")
    beside = nodes.select("item_id", "node", "n", F.lead("node").over(order).alias("next"))
    pairs = beside.where("next is not null").groupBy("node", "next").agg(F.count(F.lit(1)).alias("_items"))
    known = beside.join(pairs.where("_items > 1"), ["node", "next"], "left")
    rank = known.withColumn("_rank", F.when(F.col("_items").isNotNull(), F.struct("_items", "node", "next")))
    before, after = F.lag("_rank").over(order), F.lead("_rank").over(order)
    best = (before.isNull() | (F.col("_rank") > before)) & (after.isNull() | (F.col("_rank") > after))
    chosen = rank.withColumn("_join", F.coalesce(F.col("_rank").isNotNull() & best, F.lit(False)))
    gone = chosen.withColumn("_gone", F.coalesce(F.lag("_join").over(order), F.lit(False)))
    name = F.concat(F.lit("("), F.col("node"), F.lit(" "), F.col("next"), F.lit(")"))
    kept = settled(
        gone.where("not _gone").select(
            "item_id",
            F.when(F.col("_join"), name).otherwise(F.col("node")).alias("node"),
            F.when(F.col("_join"), F.col("node")).alias("left"),
            F.when(F.col("_join"), F.col("next")).alias("right"),
        )
    )
    new = kept.where("left is not null").select("node", "left", "right").distinct()
    counted = kept.select("item_id", "node", F.count(F.lit(1)).over(Window.partitionBy("node")).alias("n"))
    return counted, new


@dataclass
class Plan:
    """The sharing DAG of one block: classes come first, then inner nodes round by round."""

    items: list[int | None]
    terms: dict[bytes, int]
    node_of: np.ndarray
    # Nodes to add, per round; their sums are the next nodes.
    rounds: list[tuple[np.ndarray, np.ndarray]]
    # Nodes of each item, item after item, and where those of an item begin.
    members: np.ndarray
    starts: np.ndarray

    @property
    def nodes(self) -> int:
        return int(self.node_of.max()) + 1 + sum(len(left) for left, _ in self.rounds)

    @property
    def classes(self) -> int:
        return int(self.node_of.max()) + 1

    def step(self) -> int:
        """Documents whose accumulators fit in a step."""
        return max(1, STEP // max(self.nodes, len(self.members)))

    def scores(self, doc: np.ndarray, term: np.ndarray, worth: np.ndarray, docs: int) -> np.ndarray:
        """Items by documents, from the contributions of terms to documents."""
        held = np.zeros((self.nodes, docs), np.int64)
        np.add.at(held, (self.node_of[term], doc), worth)
        ready = self.classes
        for left, right in self.rounds:
            held[ready : ready + len(left)] = held[left] + held[right]
            ready += len(left)
        return np.add.reduceat(held[self.members], self.starts, axis=0)


def plan_of(terms: DataFrame, rounds: int = ROUNDS) -> Plan:
    """Mine the shared sets of one block of items. Its size bounds what is collected here."""
    in_class = settled(classes(terms))
    nodes = terms.join(in_class.where("term = node"), "term").select("item_id", "node", "n")
    merges, made = [], set()
    for _ in range(rounds):
        nodes, new = joined(nodes)
        found = {(r["node"], r["left"], r["right"]) for r in new.collect()}
        if not found:
            break
        # a pair that one item joins in this round may have been joined in another item before
        merges.append(sorted(found - made))
        made |= found
    numbers: dict[str, int] = {}
    term_rows = sorted((r["term"], r["node"]) for r in in_class.select("term", "node").collect())
    node_of = np.asarray([numbers.setdefault(node, len(numbers)) for _, node in term_rows], np.int64)
    steps = []
    for added in filter(None, merges):
        steps.append(tuple(np.asarray([numbers[row[side]] for row in added], np.int64) for side in (1, 2)))
        for name, _, _ in added:
            numbers[name] = len(numbers)
    own: dict[int | None, list[int]] = {}
    for r in nodes.select("item_id", "node").collect():
        own.setdefault(r["item_id"], []).append(numbers[r["node"]])
    sizes = [len(found) for found in own.values()]
    return Plan(
        list(own),
        {term.encode(): n for n, (term, _) in enumerate(term_rows)},
        node_of,
        steps,
        np.asarray([n for found in own.values() for n in found], np.int64),
        np.cumsum([0, *sizes[:-1]]),
    )


def _parts(text: bytes, most: int) -> Iterator[bytes]:
    """A text cut between terms into parts of about `most` bytes."""
    start = 0
    while len(text) - start > most:
        end = text.rfind(b" ", start, start + most)
        end = text.find(b" ", start + most) if end <= start else end
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def counted(texts: list[bytes | None], terms: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Length in terms of each text, and as (text, term, times) how often it has the known terms."""
    lengths = np.zeros(len(texts), np.int64)
    docs, found = [], []
    get = terms.get
    for i, text in enumerate(texts):
        for part in _parts(text.translate(_TABLE), SLICE_BYTES) if text else ():
            words = part.split()
            lengths[i] += len(words)
            numbers = np.asarray([get(w, -1) for w in words], np.int64)
            numbers = numbers[numbers >= 0]
            found.append(numbers)
            docs.append(np.full(len(numbers), i, np.int64))
    if not found:
        none = np.zeros(0, np.int64)
        return lengths, none, none, none
    keys = np.concatenate(docs) * len(terms) + np.concatenate(found)
    keys, times = np.unique(keys, return_counts=True)
    return lengths, keys // len(terms), keys % len(terms), times


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all their terms, and the weight of each term of a plan."""

    documents: int
    terms: int
    weights: np.ndarray

    def worth(self, lengths: np.ndarray, term: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Contributions of terms to documents, given the documents' lengths per row."""
        m = 100 - 50 + (50 * lengths * self.documents) // self.terms
        return self.weights[term] * ((1_000_000_000 * times) // (1000 * times + 20 * m))


DOCUMENTS, TERMS = -1, -2


def corpus_of(docs: DataFrame, plan: Plan) -> Corpus:
    """Statistics over all documents; a task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(len(plan.terms), np.int64)
        documents = terms = 0
        for _, texts in documents_in(batches):
            lengths, _, term, _ = counted(texts, plan.terms)
            documents += int((lengths > 0).sum())
            terms += int(lengths.sum())
            known += np.bincount(term, minlength=len(known))
        some = np.flatnonzero(known)
        yield pa.RecordBatch.from_arrays(
            [pa.array([DOCUMENTS, TERMS, *some.tolist()], pa.int64()), pa.array([documents, terms, *known[some].tolist()], pa.int64())],
            names=["term", "n"],
        )

    sums = id_and_text(docs).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # One row per term of the plan.
    found = {r["term"]: r["n"] for r in sums.collect()}
    documents = found.get(DOCUMENTS, 0)
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(plan.terms))]
    return Corpus(documents, found.get(TERMS, 0), np.asarray(weights, np.int64))


class Best:
    """The `most` best documents of each item so far."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.floor = np.ones(items, np.int64)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.unknown = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        item, place = np.nonzero(scores >= self.floor[:, None])
        if not len(item):
            return
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[item[len(self.item) :], place]])
        doc = np.concatenate([self.doc, ids[place]])
        unknown = np.concatenate([self.unknown, unknown[place]])
        order = np.lexsort((doc, unknown, -score, item))
        first = np.searchsorted(item[order], np.arange(len(self.floor)))
        place = np.arange(len(order)) - first[item[order]]
        order = order[place < self.most]
        self.item, self.score, self.doc, self.unknown = item[order], score[order], doc[order], unknown[order]
        last = place[place < self.most] == self.most - 1
        self.floor[self.item[last]] = self.score[last]


RANKED = "item_id long, doc_id long, score long"


def _scored(docs: DataFrame, plan: Plan, corpus: Corpus, most: int) -> DataFrame:
    """Per task the best documents of each item."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(plan.items), most)
        for batch, texts in documents_in(batches):
            ids = ids_of(batch)
            unknown = ~np.asarray(ids.is_valid(), dtype=bool)
            values = np.asarray(ids.fill_null(0), dtype=np.int64)
            lengths, doc, term, times = counted(texts, plan.terms)
            worth = corpus.worth(lengths[doc], term, times)
            # Only documents that hold a term of an item take part.
            some, doc = np.unique(doc, return_inverse=True)
            for start in range(0, len(some), plan.step()):
                stop = min(start + plan.step(), len(some))
                own = slice(*np.searchsorted(doc, [start, stop]))
                scores = plan.scores(doc[own] - start, term[own], worth[own], stop - start)
                best.add(scores, values[some[start:stop]], unknown[some[start:stop]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([plan.items[i] for i in best.item.tolist()], pa.int64()),
                pa.array([None if u else d for d, u in zip(best.doc.tolist(), best.unknown.tolist())], pa.int64()),
                pa.array(best.score, pa.int64()),
            ],
            names=["item_id", "doc_id", "score"],
        )

    return id_and_text(docs).mapInArrow(score, RANKED)


def _foremost(rows: DataFrame, by: list[str | Column], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def ranked(docs: DataFrame, items: DataFrame, most: int = 50, block: int = BLOCK) -> DataFrame:
    """The `most` best documents of each item: item_id, rank, doc_id, score."""
    terms = settled(item_terms(items))
    blocks = max(1, math.ceil(terms.count() / block))
    place = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = []
    for b in range(blocks):
        own = terms.where(place == b)
        if own.isEmpty():
            continue
        plan = plan_of(own)
        corpus = corpus_of(docs, plan)
        if corpus.documents:
            found.append(_scored(docs, plan, corpus, most))
    if not found:
        return empty(docs.sparkSession)
    rows = reduce(DataFrame.unionByName, found)
    # The rows of many tasks are thinned in groups of tasks before those of an item meet.
    group = F.pmod(F.spark_partition_id(), F.lit(1024))
    thinned = _foremost(rows.withColumn("_group", group), ["item_id", "_group"], most).drop("_group", "rank")
    return _foremost(thinned, ["item_id"], most).select("item_id", "rank", "doc_id", "score")


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
