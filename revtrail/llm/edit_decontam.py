"""Benchmark decontamination by pigeonhole edit matching.

A test item that occurs in a document with at most `e` edits has, among any `e + 1`
pieces it is cut into, one that occurs unchanged. All pieces of a block of items go into
one automaton, one pass over each text finds the exact piece hits, and each place that a
hit points to is verified with Myers' bit-parallel edit distance. The budget `e` is a
share of the item's length, so nothing within the budget is missed.

Texts are compared in lower case with runs of white space as one blank. Items shorter
than `least` characters are one piece without edits, and match between word bounds alone:
a short answer inside a longer word is no copy of it. Null and empty items match nothing.
Equal items are reported each. Null and empty documents match nothing, very long ones are
searched whole. An empty benchmark leaves every document clean, no documents give no rows.
Rows are judged one by one; extra columns are ignored, and `clean` keeps them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrail.llm.frames import documents_in, id_and_text, ids_of, per_text, settled


@dataclass(frozen=True)
class Budget:
    """Edits allowed as a share of the item's characters, and the shortest item that may have any."""

    share: float = 0.05
    least: int = 24

    def edits(self, length: int) -> int:
        return int(length * self.share) if length >= self.least else 0


# Characters of benchmark text in one block; each block takes a pass over the documents.
BLOCK_CHARS = 1_000_000

Items = tuple[tuple[int | None, str], ...]


def normal(text: bytes | str | None) -> str:
    if text is None:
        return ""
    if isinstance(text, bytes):
        text = text.decode("utf-8", "replace")
    return " ".join(text.lower().split())


def pieces(text: str, edits: int) -> list[tuple[int, str]]:
    """`edits + 1` pieces that cover the text, with their places."""
    cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the text, and where that part ends."""
    size = len(pattern)
    full, high = (1 << size) - 1, 1 << (size - 1)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    up, down, score = full, 0, size
    best, end = size, 0
    for at, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        diagonal = ((((equal & up) + up) ^ up) | equal | down) & full
        rises = down | ~(diagonal | up) & full
        falls = up & diagonal
        if rises & high:
            score += 1
        elif falls & high:
            score -= 1
        rises, falls = rises << 1 & full, falls << 1 & full
        up = falls | ~(diagonal | rises) & full
        down = rises & diagonal
        if score < best:
            best, end = score, at
    return best, end


def stretches(starts: list[int], size: int, edits: int) -> list[tuple[int, int]]:
    """Parts of the text where an item of `size` may lie, given sorted possible starts."""
    found: list[tuple[int, int]] = []
    for start in starts:
        low, high = max(0, start - edits), start + size + 2 * edits
        if found and low <= found[-1][0] + 2 * edits:
            low, high = found[-1][0], max(high, found[-1][1])
            found.pop()
        found.append((low, high))
    return found


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether no word goes on across either end of a part of the text."""
    return not any(0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum() for at in (start, end))


class Searcher:
    """One block of items, ready to be looked for."""

    def __init__(self, items: Items, budget: Budget):
        self.least = budget.least
        self.items = [(name, text, budget.edits(len(text))) for name, text in items]
        self.found_by = ahocorasick.Automaton()
        self.empty = True
        for number, (_, text, edits) in enumerate(self.items):
            if not text:
                continue
            self.empty = False
            for place, piece in pieces(text, edits):
                known = self.found_by.get(piece, None)
                if known is None:
                    self.found_by.add_word(piece, known := [len(piece)])
                known.append((number, place))
        if not self.empty:
            self.found_by.make_automaton()

    def places(self, text: str) -> dict[int, list[int]]:
        """Per item, where in the text it may start, by its exact piece hits."""
        hits: dict[int, set[int]] = {}
        for last, known in self.found_by.iter(text):
            begin = last + 1 - known[0]
            for number, place in known[1:]:
                hits.setdefault(number, set()).add(begin - place)
        return {n: sorted(starts) for n, starts in hits.items()}

    def matches(self, text: bytes | None, first: bool = False) -> list[tuple[int | None, int, int]]:
        """(item, edit distance, end of the best place in the normalised text)."""
        if not text or self.empty:
            return []
        plain = normal(text)
        found = []
        for number, starts in self.places(plain).items():
            name, item, edits = self.items[number]
            best = (edits + 1, 0)
            if len(item) < self.least:
                ends = (a + len(item) for a in starts if stands_alone(plain, a, a + len(item)))
                best = (0, end) if (end := next(ends, None)) is not None else best
            else:
                for low, high in stretches(starts, len(item), edits):
                    distance, end = myers(item, plain[low:high])
                    best = min(best, (distance, low + end))
            if best[0] <= edits:
                found.append((name, *best))
                if first:
                    break
        return found


@functools.lru_cache(maxsize=4)
def searcher(items: Items, budget: Budget) -> Searcher:
    return Searcher(items, budget)


def blocks(benchmark: DataFrame, most: int = BLOCK_CHARS) -> Iterator[Items]:
    """The items in blocks of bounded size, one at a time, in a fixed order."""
    held: list[tuple[int | None, str]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for row in rows.where("text is not null").orderBy("item_id", "text").toLocalIterator():
        text = normal(row["text"])
        if held and size + len(text) > most:
            yield tuple(held)
            held, size = [], 0
        held.append((row["item_id"], text))
        size += len(text)
    if held:
        yield tuple(held)


FOUND = "doc_id long, item_id long, distance long, text_end long"


def search(docs: DataFrame, items: Items, budget: Budget) -> DataFrame:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = searcher(items, budget)
        for batch, texts in documents_in(batches):
            hits = [(i, m) for i, t in enumerate(texts) for m in block.matches(t)]
            yield pa.RecordBatch.from_arrays(
                [
                    ids_of(batch).take(pa.array([i for i, _ in hits], pa.int64())),
                    *[pa.array([m[k] for _, m in hits], pa.int64()) for k in range(3)],
                ],
                names=[part.split()[0] for part in FOUND.split(", ")],
            )

    return id_and_text(docs).mapInArrow(look, FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """A row for each document and item that it holds within the edit budget."""
    found = None
    for items in blocks(benchmark):
        some = search(docs, items, budget)
        found = some if found is None else settled(found).unionByName(some)
    return id_and_text(docs).limit(0).selectExpr(
        "doc_id", "doc_id as item_id", "doc_id as distance", "doc_id as text_end"
    ) if found is None else found


def holds_item(text: Column, items: Items, budget: Budget = Budget()) -> Column:
    """Whether a text holds any item of the block."""

    def judge(texts: list[bytes | None]) -> list[pa.Array]:
        block = searcher(items, budget)
        return [pa.array(np.asarray([bool(block.matches(t, first=True)) for t in texts], dtype=bool))]

    return per_text(judge, "held boolean")(text.cast("string"))["held"]


def clean(docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """The documents that hold no item."""
    for items in blocks(benchmark):
        docs = docs.where(~holds_item(F.col("text"), items, budget))
    return docs
