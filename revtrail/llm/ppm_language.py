"""Language identification by prediction by partial matching.

Each language has a context tree over the UTF-8 bytes of lower-cased text: how often a
byte followed each context of up to `order` bytes. A byte costs -log2 of its share after
the longest known context (escape method C); where the context never showed that byte,
the cost of the escape and then the cost after the context without its first byte. The
statistics are frozen after training, so the sum of the costs is the exact length of the
text under that language, and the language with the shortest code is the answer; equal
lengths go to the name that sorts first. Bytes ruled out by a longer context are not
excluded from the shorter one.

The trees learn from about `sample` documents a language, chosen by a hash of the id; the
table of counts is bounded by that sample, not by the corpus. The tables of all languages
are laid into one: for every known context and byte, a row of costs, one per language.

Null texts and texts without a letter are `und` with score 0. Rows without a language do
not teach. Without anything to learn from, every text is `und`. Repeated rows get equal
answers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrail.llm.frames import per_text, slices

UNDECIDED = "und"
ORDER = 3
SAMPLE = 1500
_BYTES = 256


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def letters(text: bytes | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text.decode("utf-8", "replace"))


def stream(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts, each led by `order` line ends, and their sizes."""
    lead = b"\n" * order
    data = [lead + t.decode("utf-8", "replace").lower().encode() for t in texts]
    sizes = np.asarray([len(d) for d in data], dtype=np.int64)
    return np.frombuffer(b"".join(data), np.uint8), sizes


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each place, the byte there (lowest eight bits) and the `order` bytes before it."""
    keys = np.zeros(len(data), dtype=np.uint32)
    for back in range(order + 1):
        keys[order:] |= data[order - back : len(data) - back].astype(np.uint32) << np.uint32(8 * back)
    return keys


def own_places(sizes: np.ndarray, order: int) -> np.ndarray:
    """Which places of a stream hold text, not the leading line ends."""
    ends = np.cumsum(sizes)
    own = np.ones(int(ends[-1]) if len(ends) else 0, dtype=bool)
    for j in range(order):
        own[ends - sizes + j] = False
    return own


def sampled(docs: DataFrame, sample: int) -> DataFrame:
    """About `sample` documents a language, chosen by a hash of the id."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    held = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    shares = {r["lang"]: min(1.0, sample / r["n"]) for r in held.collect()}
    if not shares:
        return usable.limit(0)
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    draw = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return usable.where(draw < share)


COUNTS = "lang string, gram long, n long"


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for name, t in zip(langs, texts) if name == lang]
                for a, b in slices([len(t) for t in own]):
                    data, sizes = stream(own[a:b], order)
                    found, n = np.unique(grams(data, order)[own_places(sizes, order)], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n)],
                        names=["lang", "gram", "n"],
                    )

    counted = docs.select("lang", F.col("text").cast("string")).mapInArrow(count, COUNTS)
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Trees:
    """Costs in bits. Level k holds grams of k+1 bytes and contexts of k bytes, sorted."""

    langs: list[str]
    order: int
    gram_keys: list[np.ndarray]
    gram_costs: list[np.ndarray]
    context_keys: list[np.ndarray]
    escapes: list[np.ndarray]

    def costs(self, keys: np.ndarray) -> np.ndarray:
        """Bits per place and language for grams of the full order."""
        out = np.zeros((len(keys), len(self.langs)), dtype=np.float32)
        left = np.arange(len(keys))
        for k in range(self.order, -1, -1):
            now = keys[left] & np.uint32((1 << 8 * (k + 1)) - 1)
            at = np.searchsorted(self.gram_keys[k], now)
            at[at == len(self.gram_keys[k])] = 0
            known = self.gram_keys[k][at] == now
            out[left[known]] += self.gram_costs[k][at[known]]
            left, now = left[~known], now[~known]
            if not len(left):
                return out
            context = now >> np.uint32(8)
            at = np.searchsorted(self.context_keys[k], context)
            at[at == len(self.context_keys[k])] = 0
            seen = self.context_keys[k][at] == context
            out[left[seen]] += self.escapes[k][at[seen]]
        out[left] += np.float32(np.log2(_BYTES))
        return out


def _level(keys: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    short, place = np.unique(keys & np.uint32((1 << 8 * (k + 1)) - 1), return_inverse=True)
    return short, np.bincount(place, weights=counts, minlength=len(short))


def grow(table: dict[str, tuple[np.ndarray, np.ndarray]], order: int) -> Trees:
    """Context trees from {language: (grams of the full order, counts)}."""
    langs = sorted(table)
    trees = Trees(langs, order, [], [], [], [])
    for k in range(order + 1):
        levels = [_level(*table[lang], k) for lang in langs]
        every = np.unique(np.concatenate([short for short, _ in levels]))
        contexts = np.unique(every >> np.uint32(8))
        costs = np.zeros((len(every), len(langs)), dtype=np.float64)
        escapes = np.zeros((len(contexts), len(langs)), dtype=np.float64)
        if k:
            lower = Trees(langs, k - 1, trees.gram_keys, trees.gram_costs, trees.context_keys, trees.escapes)
            below = lower.costs(every)
        else:
            below = np.full(costs.shape, np.log2(_BYTES))
        inside = np.searchsorted(contexts, every >> np.uint32(8))
        for j, (short, counts) in enumerate(levels):
            own = np.searchsorted(contexts, short >> np.uint32(8))
            total = np.bincount(own, weights=counts, minlength=len(contexts))
            kinds = np.bincount(own, minlength=len(contexts))
            seen = total > 0
            # method C: an escape counts as often as the context had different bytes
            escapes[seen, j] = np.log2((total + kinds)[seen] / kinds[seen])
            costs[:, j] = escapes[inside, j] + below[:, j]
            costs[np.searchsorted(every, short), j] = np.log2((total + kinds)[own] / counts)
        trees.gram_keys.append(every)
        trees.gram_costs.append(costs.astype(np.float32))
        trees.context_keys.append(contexts)
        trees.escapes.append(escapes.astype(np.float32))
    return trees


def train(docs: DataFrame, order: int = ORDER, sample: int = SAMPLE) -> Trees | None:
    """Context trees of the languages in `docs`; the sample bounds what comes back."""
    found = gram_counts(sampled(docs, sample), order).toArrow().to_pydict()
    langs = np.asarray(found["lang"], dtype=object)
    keys = np.asarray(found["gram"], dtype=np.uint32)
    counts = np.asarray(found["n"], dtype=np.float64)
    table = {}
    for lang in sorted(set(found["lang"])):
        own = langs == lang
        by_key = np.argsort(keys[own])
        table[lang] = keys[own][by_key], counts[own][by_key]
    return grow(table, order) if table else None


def code_lengths(trees: Trees, texts: list[bytes]) -> np.ndarray:
    """Bits per text and language."""
    data, sizes = stream(texts, trees.order)
    costs = trees.costs(grams(data, trees.order)).astype(np.float64)
    costs[~own_places(sizes, trees.order)] = 0
    return np.add.reduceat(costs, np.cumsum(sizes) - sizes, axis=0)


PREDICTED = "lang_pred string, score double, bits_per_byte double"


def predicted(texts: list[bytes | None], trees: Trees | None) -> list[pa.Array]:
    names, scores, bits = [UNDECIDED] * len(texts), [0.0] * len(texts), [None] * len(texts)
    own = [i for i, t in enumerate(texts) if trees and letters(t)]
    if own:
        lengths = code_lengths(trees, [texts[i] for i in own])
        best, least = lengths.argmin(axis=1), lengths.min(axis=1)
        belief = 1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(axis=1)
        for place, i in enumerate(own):
            names[i], scores[i] = trees.langs[best[place]], float(belief[place])
            bits[i] = float(least[place] / len(texts[i]))
    return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64())]


def identify(text: Column, trees: Trees | None) -> Column:
    """Struct of language, its share of belief against the others, and bits per byte of its code."""
    return per_text(lambda texts: predicted(texts, trees), PREDICTED)(text.cast("string"))
