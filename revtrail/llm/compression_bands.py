"""Quality rules: word counts, repetition, and compression bands.

A text that compresses far better than prose repeats itself; one that hardly compresses
is noise. What is normal depends on length, since short inputs compress badly, so the band
of accepted zstandard ratios follows the length. The whole text is measured, and every chunk
of fixed size, so that a long text cannot hide a bad stretch; the last chunk ends with the
text and may overlap its predecessor.

`learned` takes the limits from the trusted documents of the corpus: per class of lengths
(two an octave) the outer quantiles of their ratios, moved outwards by a part of their distance
from the median. Loose fixed limits count as `weight` documents more in each class, so a class
with few trusted documents lies nearer to them, and one without has them. Trusted are documents
with every label of their id good and not toxic that pass the base rules.

Null and empty texts have zero counts, fail the base rules and are not kept. Long texts have
the limits of the longest class. Rows are judged one by one: repeated rows get equal answers,
an empty table gives none, and other columns are ignored. Without a trusted document, as in
empty tables, the limits are the loose ones; a null label of toxic is none, and labels without
an id count for nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from revtrail.llm.frames import per_text, settled
from revtrail.llm.words import Words, owner, windows

SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
WINDOW = 8


@dataclass(frozen=True)
class Bands:
    """Accepted compressed size over size, by size of the text in bytes.

    `whole`: (bytes, lowest ratio, highest ratio); between two sizes the limits lie on a line
    over the logarithm of the size. Texts shorter than the first size are not judged, those
    longer than the last have its limits. `chunk`: the limits of one chunk of `chunk_bytes`.
    A text falls when more than `chunk_share` of its chunks are out of band, or `chunk_run`
    neighbours are, whatever their share.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (160, 0.640, 0.90),
        (320, 0.545, 0.80),
        (640, 0.512, 0.74),
        (1024, 0.492, 0.66),
        (1448, 0.473, 0.66),
        (2048, 0.449, 0.66),
        (2896, 0.445, 0.66),
        (4096, 0.435, 0.66),
        (5793, 0.420, 0.66),
        (8192, 0.413, 0.66),
        (16384, 0.399, 0.66),
        (32768, 0.380, 0.66),
        (65536, 0.350, 0.66),
    )
    chunk_bytes: int = 1024
    chunk: tuple[float, float] = (0.48, 0.66)
    chunk_share: float = 0.25
    chunk_run: int = 2
    level: int = 3


LOOSE = Bands(whole=((160, 0.45, 0.95), (1024, 0.30, 0.80), (65536, 0.20, 0.75)), chunk=(0.30, 0.80))


@dataclass(frozen=True)
class Learning:
    """How limits follow from the ratios of trusted documents.

    `tail`: share of documents beyond the quantile on each side; `chunk_tail`: the same for
    chunks, smaller, since one text has many. `slack`: how far outside the quantile a limit
    lies, as a part of the quantile's distance from the median. `weight`: how many documents
    the loose limits count for. `classes`: classes of lengths from `loose.whole` on, two an
    octave; longer texts belong to the last one.
    """

    loose: Bands = LOOSE
    tail: float = 0.01
    chunk_tail: float = 0.002
    slack: float = 0.5
    weight: float = 2.0
    classes: int = 20


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_chunks_out long"
)


def repeated_words(words: Words, width: int = WINDOW) -> np.ndarray:
    """Per text, the words inside a window of `width` words that the text holds twice or more."""
    numbers, total = words.numbers, len(words.numbers)
    out = np.zeros(len(words.counts), dtype=np.int64)
    keys = windows(numbers.astype(np.uint64), width)
    if not len(keys):
        return out
    text = owner(words.ends, total)
    inside = np.flatnonzero(text[: len(keys)] == text[width - 1 :])
    order = inside[np.lexsort((inside, keys[inside], text[inside]))]
    same = (keys[order[1:]] == keys[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    for j in range(width):
        # equal hashes count only where the words are equal
        same &= numbers[order[1:] + j] == numbers[order[:-1] + j]
    again = np.zeros(len(order), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    cover = np.zeros(total + 1, dtype=np.int64)
    cover[order[again]] += 1
    np.subtract.at(cover, order[again] + width, 1)
    covered = np.cumsum(cover)[:total] > 0
    return np.bincount(text[covered], minlength=len(out))


def repeated_lines(text: bytes | None) -> int:
    if not text or b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def characters(text: bytes | None) -> int:
    """Code points outside ASCII white space."""
    return len(b"".join(text.split()).decode("utf-8", "replace")) if text else 0


class Judge:
    def __init__(self, bands: Bands):
        self.bands = bands
        self.squeeze = zstandard.ZstdCompressor(level=bands.level)
        sizes, *self.limits = np.asarray(bands.whole, dtype=np.float64).T
        self.sizes = np.log(sizes)

    def ratio(self, data: bytes) -> float:
        return len(self.squeeze.compress(data)) / len(data)

    def __call__(self, text: bytes | None) -> tuple[bool, float | None, int, int]:
        """In band, ratio of the whole text, chunks, chunks out of band."""
        bands = self.bands
        if not text:
            return True, None, 0, 0
        ratio = self.ratio(text)
        fine = True
        if len(text) >= bands.whole[0][0]:
            low, high = (np.interp(np.log(len(text)), self.sizes, limit) for limit in self.limits)
            fine = bool(low <= ratio <= high)
        low, high = bands.chunk
        ratios = self.chunks(text)
        out = run = longest = 0
        for one in ratios:
            bad = not low <= one <= high
            out += bad
            run = run + 1 if bad else 0
            longest = max(longest, run)
        if ratios:
            fine = fine and out <= bands.chunk_share * len(ratios) and longest < bands.chunk_run
        return fine, ratio, len(ratios), out

    def chunks(self, text: bytes) -> list[float]:
        """The ratio of every chunk; none in texts shorter than one."""
        size = self.bands.chunk_bytes
        stops = [*range(size, len(text), size), len(text)] if len(text) >= size else []
        return [self.ratio(text[stop - size : stop]) for stop in stops]


def base_rules(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the words in repeated windows and whether the base rules reject it."""
    repeats = repeated_words(words)
    return repeats, (words.counts < 20) | (100 * repeats > 30 * words.counts)


def measured(texts: list[bytes | None], bands: Bands) -> list[pa.Array]:
    in_band = Judge(bands)
    words = Words(texts)
    repeats, failed = base_rules(words)
    verdicts = [in_band(t) for t in texts]
    fine = np.asarray([v[0] for v in verdicts], dtype=bool)
    return [
        pa.array(words.counts),
        pa.array([characters(t) for t in texts], pa.int64()),
        pa.array([sum(map(t.count, SYMBOLS)) if t else 0 for t in texts], pa.int64()),
        pa.array([repeated_lines(t) for t in texts], pa.int64()),
        pa.array(repeats),
        pa.array(failed),
        pa.array(~failed & fine),
        pa.array([v[1] for v in verdicts], pa.float64()),
        pa.array([v[2] for v in verdicts], pa.int64()),
        pa.array([v[3] for v in verdicts], pa.int64()),
    ]


def ratios(text: Column, bands: Bands) -> Column:
    """Struct of size in bytes, ratio of the whole and of the chunks; no ratio where the base
    rules reject the text."""

    def measure(texts: list[bytes | None]) -> list[pa.Array]:
        ask = Judge(bands)
        fine = [not bad for bad in base_rules(Words(texts))[1]]
        return [
            pa.array([len(t or b"") for t in texts], pa.int64()),
            pa.array([ask.ratio(t) if ok else None for t, ok in zip(texts, fine)], pa.float64()),
            pa.array([ask.chunks(t) if ok else [] for t, ok in zip(texts, fine)], pa.list_(pa.float64())),
        ]

    return per_text(measure, "size long, ratio double, chunks array<double>")(text.cast("string"))


def trusted(labels: DataFrame) -> DataFrame:
    """The ids whose labels are all good and none toxic."""
    toxic = F.max(F.coalesce(F.col("toxic"), F.lit(0)))
    judged = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), toxic.alias("toxic"))
    return judged.where("doc_id is not null and quality = 1 and toxic = 0").select("doc_id")


def limits(row: Row, loose: tuple[float, float], how: Learning) -> tuple[float, float]:
    """Limits outside the quantiles of a class, with the loose ones as `weight` documents more."""
    if not row["n"]:
        return loose
    low, middle, high = row["at"]
    own = low - how.slack * (middle - low), high + how.slack * (high - middle)
    return tuple((row["n"] * a + how.weight * b) / (row["n"] + how.weight) for a, b in zip(own, loose))


def learned(docs: DataFrame, labels: DataFrame, how: Learning = Learning()) -> Bands:
    """Bands from all trusted documents; only sizes and ratios leave the scan, written once to
    `spark.checkpoint.dir`, and one row a class of lengths reaches the driver."""
    loose = how.loose
    least = loose.whole[0][0]
    seen = settled(docs.select("doc_id", ratios(F.col("text"), loose).alias("_r"))).select("doc_id", "_r.*")
    seen = seen.where(F.col("ratio").isNotNull()).join(trusted(labels), "doc_id", "left_semi")
    place = F.least(F.floor(2 * F.log2(F.col("size") / least)), F.lit(how.classes - 1)).cast("int")

    def spread(value: str, tail: float) -> list[Column]:
        return [F.count(value).alias("n"), F.percentile_approx(value, [tail, 0.5, 1 - tail], 10_000).alias("at")]

    whole = seen.where(F.col("size") >= least).groupBy(place.alias("place")).agg(*spread("ratio", how.tail))
    chunks = seen.select(F.explode("chunks").alias("ratio")).agg(*spread("ratio", how.chunk_tail))
    rows = whole.union(chunks.select(F.lit(-1).alias("place"), "n", "at")).collect()
    found = {row["place"]: row for row in rows}
    sizes, *edges = np.asarray(loose.whole, dtype=np.float64).T
    bands = []
    for k in range(how.classes):
        # the middle of the class; the first limits hold from the shortest judged text on
        size = least * 2 ** ((k + 0.5) / 2) if k else least
        fixed = tuple(float(np.interp(np.log(size), np.log(sizes), edge)) for edge in edges)
        bands.append((size, *(limits(found[k], fixed, how) if k in found else fixed)))
    return replace(loose, whole=tuple(bands), chunk=limits(found[-1], loose.chunk, how))


def quality(text: Column, bands: Bands = Bands()) -> Column:
    """Struct of counts, base rules and verdict for a text column."""
    return per_text(lambda texts: measured(texts, bands), MEASURES)(text.cast("string"))


def quality_bands(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Counts, base rules and verdict for every document; reads doc_id and text only."""
    return docs.select("doc_id", quality(F.col("text"), bands).alias("_q")).select("doc_id", "_q.*")
