"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most `limit` tokens: only longer documents are cut,
and the odd remainder comes first. What matters for packing is only how many pieces of
each length there are, a table of `limit` rows whatever the size of the corpus. On it
the bins are planned: a bin starts with the longest piece left, a bitset dynamic program
over the lengths left finds the fullest combination that fits beside it, and the
combination is taken as often as the counts allow. The plan, a few thousand rows at
most, is joined back to the pieces by length and rank within the length.

Null and empty texts are the end mark alone. Repeated rows are packed each on its own.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrail.llm.frames import documents_in, id_and_text, ids_of, settled

LIMIT = 1024
END = 2
PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
)
_CACHED = 250_000
# A blank that white space or the end follows is no place to cut.
_MARKS = ".,;:!?"
_UNEVEN = re.compile(r" (?:\s|\Z)")


def byte_symbols() -> dict[str, int]:
    """The byte for each character by which byte-level vocabularies write bytes: printable
    ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def ranks(described: dict) -> dict[bytes, int] | None:
    """Byte strings with their ids if the ids are the order of the merges, else None."""
    model, before = described["model"], described.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        return None
    if described.get("normalizer") or not before.get("use_regex", True):
        return None
    vocabulary, byte = model["vocab"], byte_symbols()
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if [vocabulary.get(m) for m in merges] != list(range(256, 256 + len(merges))):
        return None
    special = {t["content"] for t in described.get("added_tokens", [])}
    return {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in special}


class Pieces(dict):
    """Ids of a blank and the piece of text after it, by that piece; made when first asked for."""

    def __init__(self, merger: tiktoken.Encoding):
        self.merger = merger
        self.single = merger._core_bpe.encode_single_piece

    def __missing__(self, piece: str) -> bytes:
        head = piece.rstrip(_MARKS)
        if not head.isalpha():
            found = numbers(self.merger.encode_ordinary(" " + piece))
        elif head is piece or head == piece:
            found = numbers(self.single((" " + piece).encode()))
        else:  # letters are one pre-token, the marks behind them another
            found = self[head] + numbers(self.single(piece[len(head) :].encode()))
        self[piece] = found
        return found


def numbers(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder != "little":
        made.byteswap()
    return made.tobytes()


class TokenBytes:
    """Token ids of texts as little-endian 32-bit numbers, by the tokenizer of a file.

    A blank before a character that is no white space always starts a new pre-token of a
    byte-level vocabulary. Such texts are cut at their blanks, and the ids of the pieces,
    most of them seen before, are looked up; new pieces are merged by rank.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        with open(path) as file:
            described = json.load(file)
        self.special = [t["content"] for t in described.get("added_tokens", [])]
        found = ranks(described)
        self.merger = found and tiktoken.Encoding(
            "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={}
        )
        self.known = found and Pieces(self.merger)

    def _one(self, text: str) -> bytes:
        if self.merger is None or any(s in text for s in self.special):
            return numbers(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if _UNEVEN.search(text):
            return numbers(self.merger.encode_ordinary(text))
        first, *rest = text.split(" ")
        return numbers(self.merger.encode_ordinary(first)) + b"".join(map(self.known.__getitem__, rest))

    def forget(self) -> None:
        """Leave no pieces behind in a worker that goes on to other work."""
        if self.known:
            self.known.clear()

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        if self.known and len(self.known) > _CACHED:
            self.known.clear()
        return [self._one((t or b"").decode("utf-8", "replace")) for t in texts]


@functools.cache
def token_bytes(path: str) -> TokenBytes:
    return TokenBytes(path)


def cut_pieces(size: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of `size` tokens; the first takes the rest."""
    first = size % limit or limit
    return [(0, first)] + [(at, limit) for at in range(first, size, limit)]


def token_pieces(docs: DataFrame, path: str, limit: int = LIMIT, end: int = END) -> DataFrame:
    """Pieces with their place among the pieces of equal length of the same task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tokens, seen = token_bytes(path), Counter()
        mark = numbers([end])
        for batch, texts in documents_in(batches):
            rows = []
            for doc_id, ids in zip(ids_of(batch).to_pylist(), tokens.encode(texts)):
                ids += mark
                for number, (start, length) in enumerate(cut_pieces(len(ids) // 4, limit)):
                    check = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, number, start, length, check, part, seen[length]))
                    seen[length] += 1
            names = [p.split()[0] for p in PIECES.split(", ")]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
            )
        tokens.forget()

    return id_and_text(docs).mapInArrow(cut, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, with how many of each, that fill `room` as far as the counts allow."""
    reached = 1
    steps: list[tuple[int, int, int]] = []
    inside = (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room and counts[n]), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reached >> room & 1:
            take = min(take, left)
            steps.append((length, take, reached))
            reached |= (reached << length * take) & inside
            left, take = left - take, take * 2
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += take
            total -= length * take
    return dict(chosen)


def plan(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, dict[int, int]]]:
    """Bins as (how many, {length: pieces of it in one bin}).

    Each step uses up a length or leaves fewer of it than the step took for one bin, so
    there are at most limit * (1 + 1/2 + 1/3 + ...) steps, however many pieces.
    """
    left = Counter({n: c for n, c in counts.items() if c})
    bins = []
    while left:
        longest = max(left)
        rest = left.copy()
        rest[longest] -= 1
        chosen = Counter(fullest(rest, limit - longest))
        chosen[longest] += 1
        times = min(left[n] // k for n, k in chosen.items())
        bins.append((times, dict(chosen)))
        for n, k in chosen.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return bins


def slots(bins: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, rank after the last, per bin, first sequence, offset in a bin)."""
    rows, used, sequence = [], Counter(), 0
    for times, chosen in bins:
        offset = 0
        for length, per_bin in sorted(chosen.items(), reverse=True):
            first = used[length]
            used[length] += times * per_bin
            rows.append((length, first, used[length], per_bin, sequence, offset))
            offset += length * per_bin
        sequence += times
    return rows


SLOTS = "length long, first long, after long, per_bin long, sequence long, base long"


def pack(docs: DataFrame, path: str, limit: int = LIMIT, end: int = END) -> DataFrame:
    """Every piece with its sequence and its place there."""
    pieces = settled(token_pieces(docs, path, limit, end))
    held = pieces.groupBy("part", "length").agg((F.max("place") + 1).alias("n"))
    by_length = Window.partitionBy("length").orderBy("part")
    before = held.withColumn("before", F.sum("n").over(by_length) - F.col("n")).drop("n")
    # at most `limit` rows, whatever the size of the corpus
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    layout = docs.sparkSession.createDataFrame(slots(plan(counts, limit)), SLOTS)
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("place") + F.col("before"))
    inside = (
        (ranked["length"] == layout["length"])
        & (ranked["rank"] >= layout["first"])
        & (ranked["rank"] < layout["after"])
    )
    nth = F.col("rank") - F.col("first")
    return ranked.join(F.broadcast(layout), inside).select(
        "doc_id",
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("base") + (nth % F.col("per_bin")) * ranked["length"]).cast("long").alias("offset"),
    )
