"""Repeated byte strings, removed with a distributed, sparse suffix array.

Every window of `width` bytes that occurs twice contains an anchor: the place in it where
a hash of `seed` bytes is smallest. Equal windows have their anchor at the same place, so
sorting the suffixes that start at anchors (about one byte in forty) finds all repeats.
An anchor owns the windows that chose it, in two parts: those that start close before it
all hold the text from the anchor to a core's end, the others that from a core's start to
the end of the seed. A part's record is the text from the start of its first window to the
end of its last.

1. Chunks tell the cores of the different records they hold and learn which occur in
   another record too; records with other cores cannot repeat and are left out. They also
   tell hashes of blocks, texts cut where a seed's hash is below a limit, and learn
   which blocks are copies of earlier ones: all windows of these are repeats already.
2. Each chunk sorts the suffixes at its remaining anchors and sends sorted runs, front
   coded: a suffix holds the length of the prefix it shares with the one before it, and
   the rest. Equal records of a chunk go once; the later ones are repeats already.
3. A bucket of cores merges its runs with a loser tree over (suffix, length of the prefix
   shared with the last winner). Suffixes with different lengths are ordered by them
   alone; equal ones are compared from the shared length on. The merged order comes with
   the shared prefix of neighbours.
4. With the order to the left of the anchors likewise, every window is a pair of classes:
   equal to the right and equal to the left. All but its first place are repeats. Of equal
   records only the first is looked at window by window.

Cores in `hot` different records of chunks or more would gather in one bucket with all their
surroundings. Their windows travel as suffixes of their own instead, dealt by their whole
text, so a bucket gets a hot text once a chunk however many documents hold it.

Order: by doc_id (unknown ids last), then input order. Null and empty texts have no bytes.
Rows with equal ids are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.llm.frames import Chunk, in_chunks, packed, partitions, rows_of
from revtrail.llm.keys import SENT, batch_of, bucket_of, key_list, member, sent, told
from revtrail.llm.words import mix

WIDTH = 100
SEED = 16
HOT = 4000
# Bytes of text that are sorted together. A chunk sends a row to nearly every bucket, and both
# grow with the input: the rows are few only if the chunks are large.
CHUNK_BYTES = 8 << 20
# Bytes of a chunk that are held as arrays at a time.
PIECE_BYTES = 1 << 18
HELD_WINDOWS = 1 << 19
LOW_BITS = np.uint64((1 << 20) - 1)
SEEDS = SENT + ", blocks binary"
BLOCK = np.dtype([("text", "<u8", 2), ("doc", "<i8"), ("first", "<i4"), ("last", "<i4")])
LEARNED = "chunk long, shared binary, hot binary, gone binary"
BASE, SCRAMBLE = 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93


@dataclass
class Anchors:
    """Places of anchors in a chunk, the starts (first, last) of the windows they own, and
    whether texts are cut there into blocks, at about one byte in a thousand."""

    place: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cut: np.ndarray


@dataclass
class Records:
    """Parts of anchors whose windows share a core of text: the anchor, the core's hash, how far
    before the anchor the last and the first of the windows start, and a hash of all their text."""

    place: np.ndarray
    key: np.ndarray
    near: np.ndarray
    far: np.ndarray
    whole: np.ndarray

    def only(self, which: np.ndarray) -> Records:
        return Records(*(part[which] for part in self.parts()))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.place, self.key, self.near, self.far, self.whole


@lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    one, back = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
    one[0] = back[0] = 1
    return np.cumprod(one), np.cumprod(back)


class Piece:
    """Bytes of a chunk, of which any stretch has a hash at the cost of two look-ups."""

    def __init__(self, data: bytes):
        size = len(data)
        up, self.back = powers(1 << max(1, size).bit_length())
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:size], out=self.sums[1:])

    def every(self, width: int) -> np.ndarray:
        """Hashes of all stretches of `width` bytes."""
        return (self.sums[width:] - self.sums[:-width]) * self.back[: len(self.sums) - width]

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]


def pieces(chunk: Chunk, width: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Parts of a chunk, (place, bytes, which bytes start a window inside a document); each
    window starts in one part, that holds all of it."""
    long = np.flatnonzero(chunk.sizes >= width)
    edges = np.zeros(len(chunk.data) + 1, np.int8)
    edges[chunk.starts[long]] = 1
    edges[chunk.ends[long] - width + 1] = -1
    inside = np.cumsum(edges, dtype=np.int8).astype(bool)
    for at in range(0, len(chunk.data) - width + 1, PIECE_BYTES):
        data = chunk.data[at : at + PIECE_BYTES + width - 1]
        yield at, data, inside[at : at + len(data) - width + 1]


def anchors_in(piece: Piece, inside: np.ndarray, width: int, seed: int) -> Anchors:
    keys = piece.every(seed) * np.uint64(SCRAMBLE)
    # smallest hash of each window, the leftmost of equal ones: the place fills the low bits,
    # as many in every piece, so equal windows agree
    least = (keys & ~LOW_BITS) | np.arange(len(keys), dtype=np.uint64)
    span, covered = width - seed + 1, 1
    while covered * 2 <= span:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    if covered < span:
        least = np.minimum(least[: -(span - covered)], least[span - covered :])
    chosen = (least & LOW_BITS).astype(np.int32)
    apart = np.ones(len(chosen) + 1, dtype=bool)
    apart[1:-1] = (chosen[1:] != chosen[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(inside & apart[:-1])
    place = chosen[first].astype(np.int64)
    return Anchors(place, first, np.flatnonzero(inside & apart[1:]), keys[place] < np.uint64(1 << 54))


def anchors(chunk: Chunk, width: int, seed: int = SEED) -> Anchors:
    none = np.zeros(0, np.int64)
    parts = [(none, none, none, none.astype(bool))]
    for at, data, inside in pieces(chunk, width):
        own = anchors_in(Piece(data), inside, width, seed)
        parts.append((own.place + at, own.low + at, own.high + at, own.cut))
    return Anchors(*map(np.concatenate, zip(*parts)))


def records(chunk: Chunk, width: int, seed: int = SEED) -> tuple[Records, np.ndarray]:
    """The windows of anchors, and where texts are cut into blocks.

    An anchor's windows go in two parts: those that start at most `half` bytes before it share
    the text from the anchor on, the others that up to the end of the seed.
    """
    half = (width - seed) // 2
    none = np.zeros(0, np.int64)
    found, cuts = [(none, none.astype(np.uint64), none, none, none.astype(np.uint64))], [none]
    for at, data, inside in pieces(chunk, width):
        piece = Piece(data)
        own = anchors_in(piece, inside, width, seed)
        cuts.append(own.place[own.cut] + at)
        near, far = own.place - own.high, own.place - own.low
        right, left = near <= half, far > half
        for which, least, most, core, salt in (
            (right, 0, half, (0, width - half), 1),
            (left, half + 1, width, (-half - 1, seed), 2),
        ):
            place, close, away = own.place[which], np.maximum(near[which], least), np.minimum(far[which], most)
            key = mix(piece.between(place + core[0], place + core[1]) + np.uint64(salt * SCRAMBLE % 2**64))
            span = (close + width * away).astype(np.uint64)
            whole = mix(piece.between(place - away, place - close + width) + span * np.uint64(SCRAMBLE)) ^ key
            found.append((place + at, key, close, away, whole))
    return Records(*map(np.concatenate, zip(*found))), np.concatenate(cuts)


def ids_in_order(chunk: Chunk) -> np.ndarray:
    return np.where(chunk.known, chunk.ids, np.iinfo("<i8").max).astype("<i8")


def blocks(chunk: Chunk, cuts: np.ndarray, width: int) -> np.ndarray:
    """Blocks of a chunk's documents: the starts (first, last) of their windows, and a
    cryptographic hash of all their bytes."""
    long = np.flatnonzero(chunk.sizes >= width)
    first = np.union1d(chunk.starts[long], cuts)
    document = np.searchsorted(chunk.ends, first, side="right")
    last = np.minimum(np.append(first[1:], len(chunk.data)) - 1, chunk.ends[document] - width)
    real = first <= last
    out = np.zeros(int(real.sum()), BLOCK)
    out["first"], out["last"] = first[real], last[real]
    out["doc"] = ids_in_order(chunk)[document[real]]
    texts = (chunk.data[a : b + width] for a, b in zip(out["first"].tolist(), out["last"].tolist()))
    digests = b"".join(hashlib.blake2b(text, digest_size=16).digest() for text in texts)
    out["text"] = np.frombuffer(digests, "<u8").reshape(-1, 2)
    return out


def copies(table: pa.Table) -> list[dict]:
    """Spans of the blocks of a bucket that an equal block precedes, per chunk."""
    parts = [(chunk, np.frombuffer(b, BLOCK)) for chunk, b in zip(table["chunk"].to_pylist(), table["blocks"].to_pylist()) if b]
    if not parts:
        return []
    found = np.concatenate([b for _, b in parts])
    chunk = np.repeat([c for c, _ in parts], [len(b) for _, b in parts])
    text = found["text"]
    order = np.lexsort((found["first"], chunk, found["doc"], text[:, 1], text[:, 0]))
    later = order[1:][(text[order[1:]] == text[order[:-1]]).all(axis=1)]
    out = []
    for number in np.unique(chunk[later]).tolist():
        own = found[later[chunk[later] == number]]
        out.append({"chunk": number, "gone": np.stack([own["first"], own["last"]], axis=1).astype("<i4").tobytes()})
    return out


def same_text(chunk: Chunk, one: np.ndarray, other: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the texts of `sizes` bytes, 8 at least, at two lists of places are equal."""
    words = np.ndarray((len(chunk.data) - 7,), "<u8", chunk.data, strides=(1,))
    equal = np.ones(len(one), dtype=bool)
    for step in range(0, int(sizes.max(initial=0)), 8):
        ahead = np.minimum(step, sizes - 8)
        equal &= words[one + ahead] == words[other + ahead]
    return equal


def firsts(chunk: Chunk, found: Records, width: int) -> np.ndarray:
    """Which records no equal record of the chunk precedes, by document and place."""
    if not len(found.place):
        return np.zeros(0, dtype=bool)
    turn = np.empty(len(chunk), dtype=np.int64)
    turn[np.argsort(ids_in_order(chunk), kind="stable")] = np.arange(len(chunk))
    place = found.place - found.far
    document = turn[np.searchsorted(chunk.ends, place, side="right")]
    order = np.lexsort((document << 32 | place, found.whole))
    new = np.ones(len(order), dtype=bool)
    new[1:] = found.whole[order[1:]] != found.whole[order[:-1]]
    leader = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    again = np.flatnonzero(~new)
    one, other = order[again], leader[again]
    # hashes find the candidates, the texts decide
    equal = (found.near[one] == found.near[other]) & (found.far[one] == found.far[other])
    one, other = one[equal], other[equal]
    equal = same_text(chunk, place[one], place[other], found.far[one] - found.near[one] + width)
    alone = np.ones(len(order), dtype=bool)
    alone[one[equal]] = False
    return alone


def merged_spans(spans: np.ndarray) -> np.ndarray:
    """Spans (first, last) in order, with neighbours and overlaps as one span."""
    if not len(spans):
        return spans
    ordered = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ordered[:, 1])
    cut = np.flatnonzero(ordered[1:, 0] > reach[:-1] + 1)
    return np.stack([ordered[np.append(0, cut + 1), 0], reach[np.append(cut, len(reach) - 1)]], axis=1)


def outside(found: Records, spans: np.ndarray) -> Records:
    """What is left of the records without the windows in the spans, which are in order."""
    if not len(spans):
        return found
    start, stop = found.place - found.far, found.place - found.near
    first = np.searchsorted(spans[:, 1], start)
    parts = np.searchsorted(spans[:, 0], stop, side="right") - first + 1
    record = np.repeat(np.arange(len(parts)), parts)
    number = np.arange(len(record)) - np.repeat(np.cumsum(parts) - parts, parts)
    span = first[record] + number
    edge = len(spans) - 1
    start = np.where(number == 0, start[record], spans[np.maximum(span - 1, 0), 1] + 1)
    stop = np.where(number == parts[record] - 1, stop[record], spans[np.minimum(span, edge), 0] - 1)
    real = start <= stop
    out = found.only(record[real])
    out.near, out.far = out.place - stop[real], out.place - start[real]
    return out


def windows_of(chunk: Chunk, found: Records, width: int) -> Records:
    """Every window of the records as a record of its own."""
    counts = found.far - found.near + 1
    ahead = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    place = np.repeat(found.place - found.far, counts) + ahead
    none = np.zeros(len(place), np.int64)
    if not len(place):
        return Records(place, none.astype(np.uint64), none, none, none.astype(np.uint64))
    words = np.ndarray((len(chunk.data) - 7,), "<u8", chunk.data, strides=(1,))
    whole = np.zeros(len(place), np.uint64)
    for step in range(0, width, 8):
        whole = mix(whole + words[place + min(step, width - 8)])
    return Records(place, whole, none, none, whole)


RUN = (
    "bucket int, chunk long, shared binary, sizes binary, tails binary, left_sizes binary, "
    "lefts binary, place binary, near binary, far binary, doc binary, gone binary"
)


def front_coded(suffixes: list[bytes]) -> tuple[list[int], bytes]:
    """For sorted suffixes, the prefix each shares with the one before, and all the rests."""
    shared, tails, before = [], [], b""
    for now in suffixes:
        same = common(before, now, 0)
        shared.append(same)
        tails.append(now[same:])
        before = now
    return shared, b"".join(tails)


def common(one: bytes, other: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes need no look."""
    size = min(len(one), len(other))
    differ = int.from_bytes(one[known:size]) ^ int.from_bytes(other[known:size])
    return size - (differ.bit_length() + 7) // 8


def runs(
    chunk: Chunk, shared: np.ndarray, hot: np.ndarray, copied: np.ndarray, width: int, buckets: int
) -> Iterator[dict]:
    """Sorted runs of one chunk, a row per bucket, and the windows known to repeat: those of
    blocks that are copies, given, and those that repeat inside the chunk."""
    found, _ = records(chunk, width)
    once = firsts(chunk, found, width)
    gone = found.only(~once)
    # these need no sorting and pass through a bucket of their own
    yield from passing(chunk, np.concatenate([copied, windows_in(gone)]), buckets)
    found = found.only(once)
    found = outside(found.only(member(found.key, shared)), merged_spans(copied))
    dense = member(found.key, hot)
    held = found.only(~dense)
    for some in by_key(found.only(dense)):
        windows = windows_of(chunk, some, width)
        once = firsts(chunk, windows, width)
        yield from passing(chunk, windows_in(windows.only(~once)), buckets)
        held = Records(*map(np.concatenate, zip(held.parts(), windows.only(once).parts())))
        if len(held.place) >= HELD_WINDOWS:
            yield from run_rows(chunk, held, width, buckets)
            held = held.only(slice(0))
    yield from run_rows(chunk, held, width, buckets)


def windows_in(found: Records) -> np.ndarray:
    """Spans of the starts of the records' windows."""
    return np.stack([found.place - found.far, found.place - found.near], axis=1)


def by_key(found: Records) -> Iterator[Records]:
    """Records in parts of about `HELD_WINDOWS` windows, all of a key in one."""
    found = found.only(np.argsort(found.key, kind="stable"))
    counts = np.cumsum(found.far - found.near + 1)
    edges = np.flatnonzero(found.key[1:] != found.key[:-1]) + 1
    edges = edges[np.diff(counts[edges - 1] // HELD_WINDOWS, prepend=0) > 0].tolist()
    if len(counts):
        for start, stop in zip([0, *edges], [*edges, len(counts)]):
            yield found.only(slice(start, stop))


def passing(chunk: Chunk, spans: np.ndarray, buckets: int) -> Iterator[dict]:
    if len(spans):
        none = dict.fromkeys(("shared", "sizes", "left_sizes", "place", "near", "far", "doc"), b"")
        empty = zstandard.compress(b"")
        bucket = int(mix(np.asarray([chunk.number], dtype=np.uint64))[0] % np.uint64(buckets))
        yield none | {"bucket": bucket, "chunk": chunk.number, "tails": empty, "lefts": empty, "gone": span_bytes(spans)}


def run_rows(chunk: Chunk, found: Records, width: int, buckets: int) -> Iterator[dict]:
    """The sorted run of some records for each bucket."""
    if not len(found.place):
        return
    data, mirrored = chunk.data, chunk.data[::-1]
    found = found.only(np.argsort(found.key, kind="stable"))
    bucket = bucket_of(found.key, buckets).astype(np.int64)
    document = np.searchsorted(chunk.ends, found.place - found.far, side="right")
    doc = ids_in_order(chunk)[document]
    begin, end = found.place, found.place - found.near + width
    back = len(data) - found.place
    squeeze = zstandard.ZstdCompressor(level=1).compress
    edges = np.flatnonzero(np.diff(bucket)) + 1
    for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(bucket)]):
        texts = [data[a:b] for a, b in zip(begin[start:stop].tolist(), end[start:stop].tolist())]
        order = sorted(range(len(texts)), key=texts.__getitem__)
        own = np.asarray(order) + start
        far = found.far[own]
        lefts = [mirrored[a:b] for a, b in zip(back[own].tolist(), (back[own] + far).tolist())]
        lcps, tails = front_coded([texts[i] for i in order])
        far = far.astype("<u2").tobytes()
        yield {
            "bucket": int(bucket[start]),
            "chunk": chunk.number,
            "shared": np.asarray(lcps, "<u2").tobytes(),
            "sizes": (end[own] - begin[own]).astype("<u2").tobytes(),
            "tails": squeeze(tails),
            "left_sizes": far,
            "lefts": squeeze(b"".join(lefts)),
            "place": begin[own].astype("<i4").tobytes(),
            "near": found.near[own].astype("<u2").tobytes(),
            "far": far,
            "doc": doc[own].tobytes(),
            "gone": b"",
        }


def span_bytes(spans: np.ndarray) -> bytes:
    return merged_spans(spans).astype("<i4").tobytes()


def unpack(shared: np.ndarray, sizes: np.ndarray, tails: bytes) -> list[bytes]:
    out, at, before = [], 0, b""
    for same, size in zip(shared.tolist(), sizes.tolist()):
        before = before[:same] + tails[at : at + size - same]
        at += size - same
        out.append(before)
    return out


def merge(heads: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Merge sorted runs, each (suffixes, prefix shared with the one before).

    Gives (run, place in the run, prefix shared with the suffix given before). A loser
    tree: each inner node keeps the loser of its match and the prefix that it shares with
    the winner that passed. A contender that shares more with the last winner is smaller;
    only where both share the same are bytes compared, from there on.
    """
    count = 1
    while count < len(heads):
        count *= 2
    texts = [h[0][0] if h[0] else b"" for h in heads] + [b""] * (count - len(heads))
    # a run that is over shares less than nothing, so it loses against all others
    same = [0 if h[0] else -1 for h in heads] + [-1] * (count - len(heads))
    at = [0] * count
    losers = [0] * count

    def ordered(one: int, other: int, known: int) -> bool:
        """Whether run `one` goes before `other`, which share `known` bytes with the last winner;
        the loser learns what it shares with the winner."""
        a, b = texts[one], texts[other]
        now = common(a, b, known)
        if now < len(a) and now < len(b):
            wins = a[now] < b[now]
        else:
            wins = len(a) < len(b) or (len(a) == len(b) and one < other)
        same[other if wins else one] = now
        return wins

    winners = list(range(count))
    while len(winners) > 1:
        level = []
        for node, (one, other) in enumerate(zip(winners[::2], winners[1::2]), len(winners) // 2):
            first = same[one] > same[other] or (same[one] == same[other] and (same[one] < 0 or ordered(one, other, 0)))
            losers[node] = other if first else one
            level.append(one if first else other)
        winners = level
    winner = winners[0]
    while same[winner] >= 0:
        yield winner, at[winner], same[winner]
        suffixes, lcps = heads[winner]
        at[winner] += 1
        if at[winner] < len(suffixes):
            texts[winner], same[winner] = suffixes[at[winner]], lcps[at[winner]]
        else:
            texts[winner], same[winner] = b"", -1
        node = (winner + count) >> 1
        known = same[winner]
        while node:
            other = losers[node]
            shares = same[other]
            if shares > known or (shares == known and known >= 0 and ordered(other, winner, known)):
                losers[node], winner = winner, other
                known = same[winner]
            node >>= 1


def left_classes(lefts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the texts left of the anchors (reversed), and the prefix shared by neighbours."""
    order = sorted(range(len(lefts)), key=lefts.__getitem__)
    shared = [0]
    for a, b in zip(order, order[1:]):
        shared.append(common(lefts[a], lefts[b], 0))
    return np.asarray(order, dtype=np.int64), np.asarray(shared, dtype=np.int64)


SPANS = "chunk long, spans binary"


def repeats(table: pa.Table, width: int) -> list[dict]:
    """Spans of window starts that repeat an earlier window, per chunk, from the runs of a bucket."""
    rows = table.to_pylist()
    out = [{"chunk": r["chunk"], "spans": r["gone"]} for r in rows if r["gone"]]
    rows = [r for r in rows if r["sizes"]]
    if not rows:
        return out
    heads = []
    for r in rows:
        shared = np.frombuffer(r["shared"], "<u2")
        tails = zstandard.decompress(r["tails"])
        heads.append((unpack(shared, np.frombuffer(r["sizes"], "<u2"), tails), shared.tolist()))
    base = np.cumsum([0] + [len(h[0]) for h in heads])
    merged, prefix = [], []
    for run, at, same in merge(heads):
        merged.append(base[run] + at)
        prefix.append(same)
    merged, prefix = np.asarray(merged, dtype=np.int64), np.asarray(prefix, dtype=np.int64)

    def column(name: str, kind: str) -> np.ndarray:
        return np.concatenate([np.frombuffer(r[name], kind) for r in rows]).astype(np.int64)[merged]

    place, near, far, doc = column("place", "<i4"), column("near", "<u2"), column("far", "<u2"), column("doc", "<i8")
    chunk = np.repeat([r["chunk"] for r in rows], [len(h[0]) for h in heads])[merged]
    lefts = []
    for r in rows:
        at, whole = 0, zstandard.decompress(r["lefts"])
        for size in np.frombuffer(r["left_sizes"], "<u2").tolist():
            lefts.append(whole[at : at + size])
            at += size
    by_left, left_shared = left_classes([lefts[i] for i in merged.tolist()])
    rank = np.empty(len(merged), dtype=np.int64)
    rank[np.lexsort((place, chunk, doc))] = np.arange(len(merged))

    # of equal records all but the first are repeats as a whole
    sizes = width - near
    alike, left = np.ones(len(merged), dtype=bool), np.empty(len(merged), dtype=np.int64)
    alike[0] = False
    alike[1:] = (prefix[1:] == sizes[1:]) & (sizes[1:] == sizes[:-1])
    ends = far[by_left]
    left[by_left] = np.cumsum(np.append(True, (left_shared[1:] != ends[1:]) | (ends[1:] != ends[:-1])))
    pair = np.cumsum(~alike) * (len(merged) + 1) + left
    order = np.lexsort((rank, pair))
    later = order[1:][pair[order[1:]] == pair[order[:-1]]]
    spans = [(chunk[later], place[later] - far[later], place[later] - near[later])]
    kept = np.ones(len(merged), dtype=bool)
    kept[later] = False
    # neighbours that stay share what all between them share
    stay = np.flatnonzero(kept)
    prefix = np.minimum.reduceat(prefix, np.append(0, stay[:-1] + 1))
    stay_left = np.flatnonzero(kept[by_left])
    left_shared = np.minimum.reduceat(left_shared, np.append(0, stay_left[:-1] + 1))
    number = np.cumsum(kept) - 1
    by_left = number[by_left[stay_left]]
    place, near, far, chunk = place[stay], near[stay], far[stay], chunk[stay]
    by_rank = np.argsort(rank[stay])

    left = np.empty(len(stay), dtype=np.int64)
    for back in range(int(near.min()), int(far.max()) + 1):
        new, new_left = prefix < width - back, left_shared < back
        new[0] = new_left[0] = True
        own = (near <= back) & (back <= far)
        own &= ~(new & np.append(new[1:], True))
        own[by_left[new_left & np.append(new_left[1:], True)]] = False
        own = by_rank[own[by_rank]]
        if len(own) < 2:
            continue
        left[by_left] = np.cumsum(new_left)
        pair = np.cumsum(new)[own] * (len(stay) + 1) + left[own]
        order = np.argsort(pair, kind="stable")
        again = own[order[1:][pair[order[1:]] == pair[order[:-1]]]]
        spans.append((chunk[again], place[again] - back, place[again] - back))
    in_chunk, first, last = map(np.concatenate, zip(*spans))
    order = np.lexsort((first, in_chunk))
    in_chunk, first, last = in_chunk[order], first[order], last[order]
    edges = np.append(0, np.flatnonzero(np.diff(in_chunk)) + 1) if len(in_chunk) else in_chunk
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(in_chunk)]):
        out.append({"chunk": int(in_chunk[a]), "spans": span_bytes(np.stack([first[a:b], last[a:b]], axis=1))})
    return out


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def rest(chunk: Chunk, spans: np.ndarray, width: int) -> list[dict]:
    """What is left of each document, given (first, last) starts of repeated windows."""
    covered = merged_spans(spans + np.asarray([0, width - 1], np.int64))
    firsts, ends = covered[:, 0], covered[:, 1] + 1
    begin = np.searchsorted(ends, chunk.starts, side="right").tolist()
    end = np.searchsorted(firsts, chunk.ends, side="left").tolist()
    firsts, ends = firsts.tolist(), ends.tolist()
    rows = []
    for doc_id, a, b, one, other in zip(chunk.id_list(), chunk.starts.tolist(), chunk.ends.tolist(), begin, end):
        kept, at, removed, n_spans = hashlib.sha256(), a, 0, 0
        for first, stop in zip(firsts[one:other], ends[one:other]):
            first, stop = max(first, a), min(stop, b)
            if first < stop:
                kept.update(chunk.data[at:first])
                at = stop
                removed += stop - first
                n_spans += 1
        kept.update(chunk.data[at:b])
        rows.append(
            {"doc_id": doc_id, "n_bytes": b - a, "n_removed": removed, "n_spans": n_spans, "kept_sha256": kept.hexdigest()}
        )
    return rows


def without_repeats(docs: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """Per document the bytes removed because a string of `width` bytes around them starts earlier."""
    chunks = packed(docs, CHUNK_BYTES)
    buckets = 2 * partitions(docs)

    def seeds(chunk: Chunk) -> pa.RecordBatch:
        found, cuts = records(chunk, width)
        keys = found.key[firsts(chunk, found, width)]
        rows = {r["bucket"]: r | {"blocks": b""} for r in sent(chunk.number, keys, buckets)}
        own = blocks(chunk, cuts, width)
        where = bucket_of(own["text"][:, 0], buckets).astype(np.int64)
        order = np.argsort(where, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(where[order])) + 1):
            if len(part):
                bucket = int(where[part[0]])
                none = {"bucket": bucket, "chunk": chunk.number, "keys": b"", "times": b""}
                rows[bucket] = rows.get(bucket, none) | {"blocks": own[part].tobytes()}
        return batch_of(list(rows.values()), SEEDS)

    def tell(table: pa.Table) -> pa.Table:
        rows = [r | {"gone": b""} for r in told(table, hot)]
        rows += [{"shared": b"", "hot": b""} | r for r in copies(table)]
        return pa.Table.from_batches([batch_of(rows, LEARNED)])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            shared, hottest = key_list(row["shared"]), key_list(row["hot"])
            gone = np.frombuffer(b"".join(row["gone"]), "<i4").reshape(-1, 2).astype(np.int64)
            found = runs(Chunk.unpacked(row), shared, hottest, gone, width, buckets)
            while some := list(islice(found, 64)):
                yield batch_of(some, RUN)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            spans = np.frombuffer(b"".join(row["spans"] or []), "<i4").reshape(-1, 2)
            yield batch_of(rest(Chunk.unpacked(row), spans, width), RESULT)

    learned = in_chunks(docs, seeds, SEEDS, CHUNK_BYTES).groupBy("bucket").applyInArrow(tell, LEARNED)
    learned = learned.groupBy("chunk").agg(*(F.collect_list(c).alias(c) for c in ("shared", "hot", "gone")))
    sorted_runs = chunks.join(learned, "chunk").mapInArrow(sort, RUN)

    def find(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([batch_of(repeats(table, width), SPANS)])

    found = sorted_runs.groupBy("bucket").applyInArrow(find, SPANS)
    found = found.groupBy("chunk").agg(F.collect_list("spans").alias("spans"))
    return chunks.join(found, "chunk", "left").mapInArrow(remove, RESULT)
