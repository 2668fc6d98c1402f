"""Near-duplicate paragraphs by MinHash banding, and repeated passages inside them.

Blocks are paragraphs as they are written: what stands between blank lines, with its lines
joined. Each block gets `bands * rows` minhashes over its five-word shingles, and a key per
band of `rows` of them. With 8 bands of 2 rows a pair with similarity 0.75 collides with
a chance of 1 - (1 - 0.75^2)^8 = 0.9987; `bands_for` tunes the number to a wanted recall.

Pieces find passages that stand in the middle of other text. A document is cut where a hash
of two neighbouring words is smaller than at the `reach` places on either side. The cuts
depend on nearby words alone, whatever lines they stand in, so a passage is cut the same
everywhere. A piece has `2 * reach + 1` words on average and `reach + 1` at least, but for
the ends of a document. Its keys are the smallest of its shingles, as many as two pieces of
the wanted similarity must have one of in common: no pair is missed.

Chunks learn which keys occur elsewhere; only blocks and pieces with such a key go on.
Equal ones become one class; classes that share a key are compared by exact Jaccard
similarity of their shingles; linked classes form clusters, of blocks and of pieces apart.
The first of each cluster (by doc_id, unknown ids last, then input order) stays and the
others are removed; of a piece that touches a removed block, only what lies outside.

Blocks with fewer than `run` words and pieces with fewer than `least` are never removed, nor
are repeated pieces that stand alone with fewer than `run` words together: a short common
line is no passage. The words of a passage up to its first cut and after its last one stay.
Null and empty texts have no paragraphs. Rows with equal ids are documents of their own. An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.llm.bottomk_dedup import exact_test
from revtrail.llm.frames import Chunk, in_chunks, packed, rows_of, stored
from revtrail.llm.keys import SENT, batch_of, bucket_count, key_list, member, sent, shared_keys
from revtrail.llm.links import BLOCK, components, distinct_lists, in_blocks, link_lists
from revtrail.llm.words import mix, windows


def bands_for(recall: float, similarity: float, rows: int) -> int:
    """Fewest bands that find a pair of this similarity with this chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


@dataclass(frozen=True)
class Settings:
    reach: int = 2
    least: int = 3
    run: int = 14
    width: int = 5
    percent: int = 75
    rows: int = 2
    recall: float = 0.998
    seed: int = 11

    @property
    def bands(self) -> int:
        return bands_for(self.recall, self.percent / 100, self.rows)


@dataclass
class Paragraphs:
    """Pieces or blocks of a chunk: document, first word, words, first byte and byte after the last."""

    text: Text
    document: np.ndarray
    start: np.ndarray
    size: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of every word."""
    raw = np.frombuffer(data, np.uint8)
    blank = np.ones(len(raw) + 2, dtype=bool)
    blank[1:-1] = (raw == 32) | ((raw >= 9) & (raw <= 13))
    return np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])


@dataclass
class Text:
    """Words of a chunk with their bytes (a line end follows each document), documents and lines."""

    data: bytes
    begin: np.ndarray
    end: np.ndarray
    document: np.ndarray
    line: np.ndarray
    _made: tuple[int, np.ndarray] | None = None

    @classmethod
    def of(cls, chunk: Chunk) -> Text:
        data = b"".join(t + b"\n" for t in chunk.texts())  # a word never runs into the next document
        begin, end = word_bounds(data)
        lines = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        document = np.searchsorted(chunk.ends + np.arange(1, len(chunk) + 1), begin, side="right")
        return cls(data, begin, end, document, np.searchsorted(lines, begin))

    @cached_property
    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.data.lower().split()), np.uint64, len(self.begin))

    def shingles(self, width: int) -> np.ndarray:
        """A hash for every `width` words in a row, made once for blocks and pieces."""
        if self._made is None or self._made[0] != width:
            self._made = width, windows(self.hashes, width)
        return self._made[1]

    def cut(self, last: np.ndarray) -> Paragraphs:
        """What ends at each marked word."""
        stop = np.flatnonzero(last)
        start = np.append(0, stop[:-1] + 1) if len(stop) else stop
        document = self.document[start]
        return Paragraphs(self, document, start, stop - start + 1, self.begin[start] - document, self.end[stop] - document)


def blocks(text: Text) -> Paragraphs:
    """What stands between blank lines."""
    last = np.ones(len(text.begin), dtype=bool)
    last[:-1] = (text.document[1:] != text.document[:-1]) | (text.line[1:] > text.line[:-1] + 1)
    return text.cut(last)


def pieces(text: Text, how: Settings) -> Paragraphs:
    total, most = len(text.begin), np.iinfo(np.uint64).max
    if not total:
        return text.cut(np.zeros(0, dtype=bool))
    hashes, document = text.hashes, text.document
    joint = np.full(total, most, dtype=np.uint64)
    joint[:-1] = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
    joint[:-1][document[1:] != document[:-1]] = most
    # a word ends its piece if its joint is the smallest within reach in its document
    least = np.full(total, most, dtype=np.uint64)
    for j in range(1, how.reach + 1):
        same = document[j:] == document[:-j]
        np.minimum(least[:-j], joint[j:], out=least[:-j], where=same)
        np.minimum(least[j:], joint[:-j], out=least[j:], where=same)
    last = joint < least
    last[:-1] |= document[1:] != document[:-1]
    last[-1] = True
    return text.cut(last)


def paragraphs(chunk: Chunk, how: Settings) -> Paragraphs:
    """The pieces of a chunk."""
    return pieces(Text.of(chunk), how)


def shingles_of(found: Paragraphs, which: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of the chosen ones as they stand, one after another, and how many each has."""
    start, size = found.start[which], found.size[which]
    counts = np.maximum(size - width + 1, 1)
    ends = np.cumsum(counts)
    flat = np.zeros(int(counts.sum()), dtype=np.uint64)
    own = np.repeat(np.arange(len(which)), counts)
    places = np.arange(len(flat)) + (start - ends + counts)[own]
    whole = (size >= width)[own]
    flat[whole] = found.text.shingles(width)[places[whole]]
    for n in range(1, width):
        short = np.flatnonzero(size == n)
        if len(short):
            words = found.text.hashes[start[short][:, None] + np.arange(n)]
            flat[ends[short] - 1] = windows(words.reshape(-1), n)[::n]
    return flat, counts


def shingles(found: Paragraphs, which: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of the chosen ones, one after another, and where each begins."""
    flat, counts = shingles_of(found, which, width)
    own = np.repeat(np.arange(len(which)), counts)
    several = np.flatnonzero((counts > 1)[own])
    flat[several] = flat[several][np.lexsort((flat[several], own[several]))]
    fresh = np.ones(len(flat), dtype=bool)
    fresh[1:] = (flat[1:] != flat[:-1]) | (own[1:] != own[:-1])
    flat, own = flat[fresh], own[fresh]
    return flat, np.searchsorted(own, np.arange(len(which) + 1))


@dataclass
class Keyed:
    """Those that are long enough, and their keys with the place in `which` of each, in order."""

    which: np.ndarray
    keys: np.ndarray
    owner: np.ndarray


def band_keys(found: Paragraphs, how: Settings) -> Keyed:
    """A key per band for every block that is long enough."""
    which = np.flatnonzero(found.size >= how.run)
    flat, counts = shingles_of(found, which, how.width)
    bounds = np.cumsum(counts) - counts
    seeds = np.random.default_rng(how.seed).integers(1, 2**63, size=(how.bands, how.rows), dtype=np.uint64)
    keys = np.zeros((len(which), how.bands), dtype=np.uint64)
    for band in range(how.bands if len(which) else 0):
        key = np.full(len(which), np.uint64(band + 1))
        for seed in seeds[band]:
            key = mix(key ^ np.minimum.reduceat(mix(flat ^ seed), bounds))
        keys[:, band] = key
    return Keyed(which, keys.reshape(-1), np.repeat(np.arange(len(which)), how.bands))


def prefix_keys(found: Paragraphs, how: Settings) -> Keyed:
    """The smallest shingles of every piece that is long enough: similar pieces share one of them."""
    which = np.flatnonzero(found.size >= how.least)
    flat, bounds = shingles(found, which, how.width)
    sizes = np.diff(bounds)
    many = sizes + (-how.percent * sizes) // 100 + 1  # size - ceil(size * percent / 100) + 1
    own = np.repeat(np.arange(len(which)), sizes)
    first = np.arange(len(flat)) - bounds[own] < many[own]
    keys, own = flat[first], own[first]
    # sets of one or two are similar to none but their equals, so both make one key
    two = np.flatnonzero(sizes[own] == 2)
    keys[two] = mix(keys[two] * np.uint64(3) + flat[bounds[own[two]] + 1])
    return Keyed(which, keys, own)


# Where a block or piece stands: its document in the chunk, its first word and words, its bytes
# in the document, and for blocks the end of the word before and the first byte of the next one.
PLACE = ["document", "start", "size", "begin", "end", "before", "after"]
SPOT = "member binary, held binary, chunk long, number int, doc_id long, keys array<long>"


# blocks are numbered from here on, pieces from 0
BLOCKS = 1 << 30


def units(chunk: Chunk, how: Settings) -> list[tuple[int, Paragraphs, Keyed]]:
    text = Text.of(chunk)
    one, other = pieces(text, how), blocks(text)
    return [(0, one, prefix_keys(one, how)), (BLOCKS, other, band_keys(other, how))]


def places(chunk: Chunk, found: Paragraphs, which: np.ndarray, first: int) -> list[np.ndarray]:
    """The numbers of the chosen ones and the columns of `PLACE`."""
    text, document, start, size = found.text, found.document[which], found.start[which], found.size[which]
    own = chunk.starts[document]
    before = after = np.zeros(len(which), np.int64)
    if first == BLOCKS and len(which):
        # a line end more stands behind each document before this one
        before = text.end[np.maximum(start - 1, 0)] - document - own
        after = text.begin[np.minimum(start + size, len(text.begin) - 1)] - document - own
    return [which + first, document, start, size, found.begin[which] - own, found.end[which] - own, before, after]


def squeezed(columns: list[np.ndarray]) -> bytes:
    """Columns of whole numbers, as differences to the row before, equal bytes side by side."""
    steps = np.diff(np.asarray(columns, "<i4"), axis=1, prepend=0).astype("<i4")
    return zstandard.ZstdCompressor(level=3).compress(steps.reshape(-1).view(np.uint8).reshape(-1, 4).T.tobytes())


def restored(held: bytes) -> np.ndarray:
    """The columns again: numbers, then `PLACE`."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(held), np.uint8)
    steps = np.ascontiguousarray(raw.reshape(4, -1).T).view("<i4").reshape(len(PLACE) + 1, -1)
    return np.cumsum(steps, axis=1, dtype=np.int64)


def candidates(chunk: Chunk, shared: np.ndarray, how: Settings) -> pa.RecordBatch:
    """A row for each block and piece with a key that occurs elsewhere too, and those keys with
    the shingles where others than its equals may be similar. One row more, without a member,
    holds where they all stand."""
    ids = chunk.id_list()
    members, sets, numbers, documents, lists, spots = [], [], [], [], [], []
    for first, found, keyed in units(chunk, how):
        known = member(keyed.keys, shared)
        keys, own = keyed.keys[known].view(np.int64).tolist(), keyed.owner[known]
        some, starts = np.unique(own, return_index=True)
        which = keyed.which[some]
        flat, bounds = shingles(found, which, how.width)
        data, cuts = flat.astype("<u8").tobytes(), (8 * bounds).tolist()
        held = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        members += [xxhash.xxh3_128_digest(h, seed=first) for h in held]
        lone = [len(h) < 3 * 8 for h in held]
        sets += [None if one else h for one, h in zip(lone, held)]
        numbers += (which + first).tolist()
        documents += [ids[d] for d in found.document[which].tolist()]
        starts = [*starts.tolist(), len(keys)]
        spots.append(places(chunk, found, which, first))
        lists += [None if one else keys[a:b] for one, a, b in zip(lone, starts, starts[1:])]
    members.append(None)
    sets.append(squeezed([np.concatenate(column) for column in zip(*spots)]))
    numbers.append(-1)
    documents.append(None)
    lists.append(None)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(members, pa.binary()),
            pa.array(sets, pa.binary()),
            pa.array([chunk.number] * len(members), pa.int64()),
            pa.array(numbers, pa.int32()),
            pa.array(documents, pa.int64()),
            pa.array(lists, pa.list_(pa.int64())),
        ],
        names=[part.split()[0] for part in SPOT.split(", ")],
    )


RESULT = (
    "doc_id long, n_paragraphs long, n_removed long, removed_words long, "
    "removed array<string>, components array<long>"
)


COUNTED = "chunk long, ids binary, known binary, counts binary"


def counted(chunk: Chunk) -> pa.RecordBatch:
    """One row: the documents of a chunk and how many blocks each has."""
    counts = np.bincount(blocks(Text.of(chunk)).document, minlength=len(chunk))[: len(chunk)]
    row = {"ids": chunk.ids, "known": chunk.known.astype(np.uint8), "counts": counts.astype("<i8")}
    return batch_of([{"chunk": chunk.number} | {name: values.tobytes() for name, values in row.items()}], COUNTED)


def long_runs(number: np.ndarray, document: np.ndarray, size: np.ndarray, least: int) -> np.ndarray:
    """Which repeated pieces, given in order, stand in rows of neighbours with `least` words or more together."""
    if not len(number):
        return np.zeros(0, dtype=bool)
    row = np.cumsum(np.append(False, (np.diff(number) != 1) | (np.diff(document) != 0)))
    words = np.zeros(row[-1] + 1, np.int64)
    np.add.at(words, row, size)
    return words[row] >= least


def report(ids: list[int | None], counts: np.ndarray, gone: pa.StructArray, stand: np.ndarray, how: Settings) -> pa.RecordBatch:
    """Per document what goes: byte spans, and the cluster of each as the doc_id of its first paragraph.

    `stand` tells where the candidates stand, those that go among them.
    """
    number = np.asarray(gone.field("number"), dtype=np.int64)
    order = np.argsort(number)
    number = number[order]
    document, start, size, begin, end, before, after = stand[1:, np.searchsorted(stand[0], number)]
    stop = start + size
    whole = np.flatnonzero(number >= BLOCKS)
    parts = np.flatnonzero(number < BLOCKS)
    parts = parts[long_runs(number[parts], document[parts], size[parts], how.run)]
    # stretches of words that belong to a removed block or else to a removed piece
    bounds = np.unique(np.concatenate([start[whole], stop[whole], start[parts], stop[parts]]))
    owner = np.full(max(0, len(bounds) - 1), -1, np.int64)
    for which in (parts, whole):
        if len(which):
            last = which[np.maximum(np.searchsorted(start[which], bounds[:-1], side="right") - 1, 0)]
            inside = (start[last] <= bounds[:-1]) & (bounds[:-1] < stop[last])
            owner[inside] = last[inside]
    change = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    first, last = np.append(0, change)[: len(owner)], np.append(change, len(owner))[: len(owner)]
    some = owner[first] >= 0
    own, low, high = owner[first[some]], bounds[first[some]], bounds[last[some]]
    # what is left of a piece ends where a removed block begins, and begins where one ends
    opens, ends = begin[own], end[own]
    cut = low != start[own]
    opens[cut] = after[whole[np.searchsorted(stop[whole], low[cut])]]
    cut = high != stop[own]
    ends[cut] = before[whole[np.searchsorted(start[whole], high[cut])]]
    words = np.zeros(len(ids), np.int64)
    np.add.at(words, document[own], high - low)
    spans = np.bincount(document[own], minlength=len(ids)).astype(np.int64)
    lists = pa.array(np.append(0, np.cumsum(spans)), pa.int32())
    clusters = gone.field("first").take(pa.array(order[own]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(counts),
            pa.array(spans),
            pa.array(words),
            pa.ListArray.from_arrays(lists, pa.array([f"{a}:{b}" for a, b in zip(opens.tolist(), ends.tolist())], pa.string())),
            pa.ListArray.from_arrays(lists, clusters),
        ],
        names=[part.split()[0] for part in RESULT.split(", ")],
    )


def repeated_paragraphs(docs: DataFrame, how: Settings = Settings(), block: int = BLOCK) -> DataFrame:
    """Per document its blocks, and what of them is removed as a near copy of an earlier one."""
    chunks = packed(docs, level=7)
    buckets = bucket_count(docs)

    def seeds(chunk: Chunk) -> pa.RecordBatch:
        keys = np.concatenate([keyed.keys for _, _, keyed in units(chunk, how)])
        return batch_of(list(sent(chunk.number, keys, buckets)), SENT)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield candidates(Chunk.unpacked(row), key_list(row["shared"]), how)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids, known, counts = (row.column(name)[0].as_py() for name in ("ids", "known", "counts"))
                known = np.frombuffer(known, np.uint8).tolist()
                ids = [n if k else None for n, k in zip(np.frombuffer(ids, "<i8").tolist(), known)]
                stand = row.column("stand")[0].as_py()
                stand = np.zeros((len(PLACE) + 1, 0), np.int64) if stand is None else restored(stand)
                yield report(ids, np.frombuffer(counts, "<i8"), row.column("gone").flatten(), stand, how)

    told = shared_keys(in_chunks(docs, seeds, SENT), hot=np.iinfo(np.uint32).max).drop("hot")
    found = stored(chunks.join(told, "chunk").mapInArrow(choose, SPOT))

    able = found.where("keys is not null")
    listed = able.select(F.explode("keys").alias("value"), "member").distinct()
    sets = able.groupBy("member").agg(F.first("held").alias("held"))
    entries = in_blocks(distinct_lists(listed).join(sets, "member"), block)
    roots = components(link_lists(entries, exact_test(how.percent), how.percent / 100))

    spots = found.where("member is not null").select("chunk", "number", "member", "doc_id")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "chunk", "number")
    classes = spots.groupBy("member").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    classes = classes.join(roots.withColumnRenamed("node", "member"), "member", "left")
    classes = stored(classes.where("n > 1 or root is not null"))
    alone = classes.where("root is null").select("member", "first")
    linked = classes.where("root is not null")
    tops = linked.groupBy("root").agg(F.min("first").alias("top"))
    together = linked.join(tops, "root").select("member", F.col("top").alias("first"))
    later = spots.join(alone.union(together), "member").where(
        (F.col("chunk") != F.col("first.chunk")) | (F.col("number") != F.col("first.number"))
    )
    gone = later.groupBy("chunk").agg(
        F.collect_list(F.struct("number", F.col("first.doc_id").alias("first"))).alias("gone")
    )
    stand = found.where("member is null").select("chunk", F.col("held").alias("stand"))
    every = in_chunks(docs, counted, COUNTED).join(stand, "chunk", "left").join(gone, "chunk", "left")
    return every.mapInArrow(remove, RESULT)
