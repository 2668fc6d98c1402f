"""Secret scan: fixed patterns, and a character convolutional network over every candidate.

The patterns find assignments to names such as `token`, access keys and long hex runs.
Their findings are also the labels: values found by a pattern teach what a secret and its
surroundings look like, other candidates teach what does not. The network reads `inside`
characters with the text around them: character embeddings, one convolution, the strongest
answer of each filter before, inside and after them, and a logistic output. A longer
candidate is read through overlapping windows, and the surest one counts.

All documents are searched for examples; the `examples` findings and as many others with
the smallest draws (a hash of text and place) train the network. Its outputs are calibrated
on findings kept aside, and the threshold is the `1 - recall` quantile of the scores of all
findings in the documents.

Candidates are runs of `[A-Za-z0-9+/_.=-]` of six characters or more, and their parts
between `+/_.=-` of six or more. Those that touch a pattern's finding are covered already;
any other that reaches the threshold is a finding of kind `model`, as one span with those
that overlap it or follow behind a separator.

Null and empty texts have no spans. Without a finding or without another candidate, as in an
empty table, there is no network and the patterns stand alone. Long texts and runs take time
and memory in proportion. Repeated rows get equal answers; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrail.llm.frames import documents_in, id_and_text, per_text, settled
from revtrail.llm.words import mix

KINDS = ("assign", "access", "hex", "model")
NAMES = ("password", "passwd", "secret", "token", "api")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST = 6
SEPARATORS = "+/_.=-"

# Characters whose answers are held at once.
STRETCH = 8192

Span = tuple[int, str, int]  # start, kind, end


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample and shape of the network."""

    examples: int = 3_000
    before: int = 24
    inside: int = 32
    after: int = 8
    embedding: int = 8
    width: int = 5
    filters: int = 16
    epochs: int = 12
    batch: int = 64
    rate: float = 0.01
    blind: float = 0.3
    recall: float = 0.98
    seed: int = 7


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns' findings."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def value(text: str, span: tuple[int, int, int]) -> tuple[int, int]:
    """What a pattern's finding keeps secret: an assignment without the name."""
    start, kind, end = span
    return ASSIGN.match(text, start).span(2) if kind == 0 else (start, end)


def windows(start: np.ndarray, end: np.ndarray, how: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping stretches of at most `inside` characters that cover each candidate, one
    candidate after another, and how many each has."""
    step = how.inside // 2
    counts = 1 + np.maximum(0, -(-(end - start - how.inside) // step))
    ends = np.cumsum(counts)
    first, stop = np.repeat(start, counts), np.repeat(end, counts)
    place = np.arange(len(first)) - np.repeat(ends - counts, counts)
    first = np.minimum(first + place * step, np.maximum(first, stop - how.inside))
    return first, np.minimum(first + how.inside, stop), counts


def codes(text: str) -> np.ndarray:
    """Characters as numbers: printable ASCII, line ends, and one class for all others."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    out = np.full(len(points), 97)
    plain = (points >= 32) & (points < 127)
    out[plain] = points[plain] - 31
    out[points == 10] = 96
    return out


ALPHABET = 98


def classes(characters: str) -> np.ndarray:
    """Which character numbers stand for one of these."""
    out = np.zeros(ALPHABET, dtype=bool)
    out[codes(characters)] = True
    return out


PLAIN = classes(string.ascii_letters + string.digits)
TOKEN = PLAIN | classes(SEPARATORS)


def runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true values of a least length begin and end."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    long = end - start >= least
    return start[long], end[long]


class Line:
    """Texts as one row of character numbers, with room between them; 0 where there is nothing."""

    def __init__(self, texts: list[str], how: Settings):
        pad = np.zeros(max(how.before, how.after), dtype=np.uint8)
        parts, starts, at = [pad], [], len(pad)
        for text in texts:
            starts.append(at)
            parts += [codes(text).astype(np.uint8), pad]
            at += len(parts[-2]) + len(pad)
        self.codes = np.concatenate(parts)
        self.starts = np.asarray(starts, dtype=np.int64)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1

    def places(self, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Start and end in the row of spans (text, start, end)."""
        found = np.asarray(spans, dtype=np.int64).reshape(-1, 3)
        shift = self.starts[found[:, 0]]
        return found[:, 1] + shift, found[:, 2] + shift

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of runs of token characters, each before its parts."""
        start, end = runs(TOKEN[self.codes], SHORTEST)
        first, last = runs(PLAIN[self.codes], SHORTEST)
        own = np.searchsorted(start, first, side="right") - 1
        part = (first != start[own]) | (last != end[own]) if len(start) else np.zeros(0, dtype=bool)
        start, end = np.append(start, first[part]), np.append(end, last[part])
        order = np.lexsort((-end, start))
        return start[order], end[order]


def touches(start: np.ndarray, end: np.ndarray, spans: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which places overlap any span, given in order of their starts: of those that start
    before its end, the farthest reaches over its start."""
    if not len(spans[0]):
        return np.zeros(len(start), dtype=bool)
    before = np.searchsorted(spans[0], end, side="left")
    return (before > 0) & (np.maximum.accumulate(spans[1])[before - 1] > start)


def view(text: str, start: int, end: int, how: Settings) -> np.ndarray:
    """A candidate and its surroundings in fixed places; 0 where there is nothing."""
    row = np.zeros(how.before + how.inside + how.after, dtype=np.int64)
    lead = codes(text[max(0, start - how.before) : start])
    row[how.before - len(lead) : how.before] = lead
    body = codes(text[start : min(end, start + how.inside)])
    row[how.before : how.before + len(body)] = body
    tail = codes(text[end : end + how.after])
    row[how.before + how.inside : how.before + how.inside + len(tail)] = tail
    return row


def views(line: Line, start: np.ndarray, end: np.ndarray, how: Settings) -> np.ndarray:
    """`view` of many places of a row at once."""
    start, end = start[:, None], end[:, None]
    body = start + np.arange(how.inside)
    inside = np.where(body < end, line.codes[np.minimum(body, len(line.codes) - 1)], 0)
    around = line.codes[start - how.before + np.arange(how.before)], line.codes[end + np.arange(how.after)]
    return np.concatenate([around[0], inside, around[1]], axis=1)


class Answers:
    """What the filters answer at every place of rows of character numbers, by tables of
    their answers to each pair of characters and to the last one."""

    def __init__(self, weights: dict[str, np.ndarray], how: Settings):
        self.width, self.filters = how.width, how.filters
        filters = weights["filters"].reshape(how.width, how.embedding, how.filters)
        single = [(weights["letters"] @ f).astype(np.float32) for f in filters]
        self.pairs = [(j, (single[j][:, None] + single[j + 1][None]).reshape(-1, how.filters)) for j in range(0, how.width - 1, 2)]
        self.last = single[-1] if how.width % 2 else None

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        rows = rows.astype(np.int32)
        places = rows.shape[-1] - self.width + 1
        pairs = rows[..., :-1] * ALPHABET + rows[..., 1:]
        raw = np.zeros((*rows.shape[:-1], places, self.filters), np.float32)
        for j, table in self.pairs:
            raw += table.take(pairs[..., j : j + places], axis=0)
        if self.last is not None:
            raw += self.last.take(rows[..., self.width - 1 : self.width - 1 + places], axis=0)
        return raw


class Tops:
    """The strongest answers over stretches of places, from those over powers of two."""

    def __init__(self, raw: np.ndarray, longest: int):
        self.levels = [raw]
        while 1 << len(self.levels) <= longest:
            half, below = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.maximum(below[:-half], below[half:]) if len(below) > half else below[:0])

    def over(self, first: np.ndarray, counts: np.ndarray | int) -> np.ndarray:
        counts = np.broadcast_to(np.asarray(counts), first.shape)
        level = np.frexp(counts.astype(np.float64))[1] - 1
        out = np.empty((len(first), self.levels[0].shape[1]), np.float32)
        for k in np.unique(level).tolist():
            own = np.flatnonzero(level == k)
            a = first[own]
            out[own] = np.maximum(self.levels[k].take(a, axis=0), self.levels[k].take(a + counts[own] - (1 << k), axis=0))
        return out


@dataclass
class Network:
    """Weights, calibration (slope, shift) and threshold."""

    how: Settings
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def _zones(self) -> list[slice]:
        how = self.how
        last = how.before + how.inside + how.after - how.width + 1
        inside = max(0, how.before - how.width + 1)
        return [slice(0, how.before), slice(inside, how.before + how.inside), slice(how.before + how.inside - how.width, last)]

    def forward(self, rows: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Scores before calibration, and what the gradient needs."""
        w, width = self.weights, self.how.width
        letters = w["letters"][rows]
        places = rows.shape[1] - width + 1
        spread = np.concatenate([letters[:, j : j + places] for j in range(width)], axis=2)
        raw = spread @ w["filters"] + w["filter_shift"]
        active = np.maximum(raw, 0)
        tops = [active[:, zone].argmax(axis=1) + zone.start for zone in self._zones()]
        pooled = np.concatenate([np.take_along_axis(active, t[:, None], 1)[:, 0] for t in tops], axis=1)
        return pooled @ w["out"] + w["out_shift"][0], (spread, tops, pooled)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """As `forward`, by tables."""
        answers = Answers(self.weights, self.how)
        out = np.empty(len(rows))
        for a in range(0, len(rows), 128):
            raw = answers(rows[a : a + 128])
            out[a : a + 128] = self._score([raw[:, zone].max(axis=1) for zone in self._zones()])
        return out

    def _score(self, tops: list[np.ndarray]) -> np.ndarray:
        shift = np.tile(self.weights["filter_shift"].astype(np.float32), len(tops))
        active = np.maximum(np.concatenate(tops, axis=1) + shift, 0)
        return (active * self.weights["out"].astype(np.float32)).sum(axis=1) + self.weights["out_shift"][0]

    def scores_at(self, line: Line, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The scores of the views of many places, none longer than `inside`.

        Views of neighbours overlap, so the filters answer once a character of the text. The
        answers over the end of a place shorter than `inside`, where the view has a gap, are
        added place by place; a gap narrower than a filter takes the whole view.
        """
        how = self.how
        size = end - start
        full = size == how.inside
        narrow = ~full & ((size > how.inside - how.width) | (size < how.width - 1))
        out = np.empty(len(start))
        answers = Answers(self.weights, how)
        if narrow.any():
            out[narrow] = self.scores(views(line, start[narrow], end[narrow], how))
        for some, wide in ((np.flatnonzero(full), True), (np.flatnonzero(~full & ~narrow), False)):
            some = some[np.argsort(start[some], kind="stable")]
            cuts = np.flatnonzero(np.diff(start[some] // STRETCH)) + 1
            for own in np.split(some, cuts) if len(some) else []:
                low = int(start[own[0]]) - how.before
                raw = answers(line.codes[low : int(end[own].max()) + how.after])
                tops = Tops(raw, max(how.before, how.inside))
                out[own] = self._score(self._whole(tops, start[own] - low) if wide else self._parted(answers, tops, line, start[own], end[own], low))
        return out

    def _whole(self, tops: Tops, start: np.ndarray) -> list[np.ndarray]:
        """Strongest answers before, inside and after places as long as a view takes."""
        how, over = self.how, self.how.width - 1
        before = tops.over(start - how.before, how.before)
        inside = np.maximum(tops.over(start - over, how.inside), tops.over(start, how.inside))
        return [before, inside, tops.over(start + how.inside - how.width, how.after + 1)]

    def _parted(self, answers: Answers, tops: Tops, line: Line, start: np.ndarray, end: np.ndarray, low: int) -> list[np.ndarray]:
        """The same for shorter places, whose views have a gap of a filter or more behind them."""
        how, over = self.how, self.how.width - 1
        near = np.zeros((len(start), 3 * over), dtype=np.uint8)
        near[:, :over] = line.codes[end[:, None] - over + np.arange(over)]
        near[:, 2 * over :] = line.codes[end[:, None] + np.arange(over)]
        edge = answers(near)  # the first `over` answers run into the gap, the others out of it
        out_of = np.maximum(edge[:, over:].max(axis=1), answers(np.zeros(how.width, dtype=np.uint8)))
        inside = tops.over(start - low - over, end - start)
        inside = np.maximum(inside, np.maximum(edge[:, :over].max(axis=1), out_of))
        after = np.maximum(out_of, tops.over(end - low, how.after - over))
        return [tops.over(start - low - how.before, how.before), inside, after]

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return self._calibrated(self.scores(rows))

    def probability_at(self, line: Line, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._calibrated(self.scores_at(line, start, end))

    def _calibrated(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * scores + self.shift, -50, 50)))

    def gradient(self, rows: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        w, how = self.weights, self.how
        scores, (spread, tops, pooled) = self.forward(rows)
        error = (1 / (1 + np.exp(-np.clip(scores, -50, 50))) - truth) / len(rows)
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        grads["out"] = pooled.T @ error
        grads["out_shift"] = np.asarray([error.sum()])
        back = error[:, None] * w["out"][None, :] * (pooled > 0)
        which = np.arange(len(rows))[:, None]
        for zone, top in enumerate(tops):
            own = back[:, zone * how.filters : (zone + 1) * how.filters]
            seen = spread[which, top]  # example, filter, width * embedding
            grads["filters"] += np.einsum("nf,nfd->df", own, seen)
            grads["filter_shift"] += own.sum(axis=0)
            to_input = own[:, :, None] * w["filters"].T[None]
            to_input = to_input.reshape(len(rows), how.filters, how.width, how.embedding)
            for j in range(how.width):
                np.add.at(grads["letters"], rows[which, top + j], to_input[:, :, j])
        return grads


def fit(rows: np.ndarray, truth: np.ndarray, how: Settings) -> Network:
    """Train on two thirds; calibrate and set the threshold on the rest."""
    draw = np.random.default_rng(how.seed)
    weights = {
        "letters": draw.normal(0, 0.5, (ALPHABET, how.embedding)),
        "filters": draw.normal(0, 0.3, (how.width * how.embedding, how.filters)),
        "filter_shift": np.zeros(how.filters),
        "out": draw.normal(0, 0.3, 3 * how.filters),
        "out_shift": np.zeros(1),
    }
    net = Network(how, weights)
    kept = np.arange(len(rows)) % 3 == 2
    own, answers = rows[~kept], truth[~kept]
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(how.epochs):
        order = draw.permutation(len(own))
        for a in range(0, len(order), how.batch):
            some = own[order[a : a + how.batch]].copy()
            # without its surroundings a secret must show by its own characters
            blind = draw.random(len(some)) < how.blind
            some[blind, : how.before] = 0
            some[blind, how.before + how.inside :] = 0
            step += 1
            for k, g in net.gradient(some, answers[order[a : a + how.batch]]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                weights[k] -= how.rate * move
    aside = rows[kept] if kept.any() else rows
    answers = truth[kept] if kept.any() else truth
    scores = net.forward(aside)[0]
    # counts of one each side keep the calibration finite when the classes part cleanly
    target = np.where(answers == 1, (answers.sum() + 1) / (answers.sum() + 2), 1 / ((answers == 0).sum() + 2))
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(net.slope * scores + net.shift, -50, 50)))
        wrong = p - target
        curve = p * (1 - p) + 1e-6
        centre = scores.mean()
        net.shift -= wrong.sum() / curve.sum()
        net.slope -= 0.5 * (wrong * (scores - centre)).sum() / (curve * (scores - centre) ** 2 + 1e-6).sum()
    found = np.sort(net.probability(aside)[answers == 1])
    if len(found):
        net.threshold = float(found[int(len(found) * (1 - how.recall))])
    return net


EXAMPLES = "draw long, label int, view binary"


def draws(texts: list[str], line: Line, places: np.ndarray) -> np.ndarray:
    """A number for each place of a row that depends on its text and the place there alone."""
    own = np.asarray([xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) for t in texts], dtype=np.uint64)
    number = line.text_of(places)
    return (mix((places - line.starts[number]).astype(np.uint64) ^ own[number]) >> np.uint64(1)).astype(np.int64)


class Smallest:
    """The rows with the smallest distinct draws; `bound` is no longer reached by others."""

    def __init__(self, most: int):
        self.most, self.rows, self.bound = most, {}, np.iinfo(np.int64).max

    def add(self, draw: int, row: bytes) -> None:
        self.rows[draw] = row
        if len(self.rows) >= 2 * self.most:
            self.rows = dict(self.first())
            self.bound = max(self.rows)

    def first(self) -> list[tuple[int, bytes]]:
        return sorted(self.rows.items())[: self.most]


def examples(docs: DataFrame, how: Settings) -> DataFrame:
    """Labelled views from all documents, of each task those with the smallest draws per label."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Smallest(how.examples), Smallest(how.examples)]
        for _, data in documents_in(batches):
            texts = [t.decode("utf-8", "replace") if t else "" for t in data]
            line = Line(texts, how)
            found = [(n, span) for n, text in enumerate(texts) for span in base_spans(text)]
            start, end = line.candidates()
            free = ~touches(start, end, line.places([(n, a, b) for n, (a, _, b) in found]))
            secret = windows(*line.places([(n, *value(texts[n], span)) for n, span in found]), how)[:2]
            for truth, (a, b) in enumerate(((start[free], end[free]), secret)):
                numbers = draws(texts, line, a)
                own = np.flatnonzero(numbers < kept[truth].bound)
                least = np.unique(numbers[own])[: how.examples]
                own = own[numbers[own] <= least[-1]] if len(least) else own
                first, stop, counts = windows(a[own], b[own], how)
                # one window of each, by its draw
                which = np.cumsum(counts) - counts + numbers[own] % counts
                for draw, row in zip(numbers[own].tolist(), views(line, first[which], stop[which], how)):
                    kept[truth].add(draw, row.tobytes())
        rows = [(draw, truth, seen) for truth, some in enumerate(kept) for draw, seen in some.first()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
            names=["draw", "label", "view"],
        )

    return id_and_text(docs).where("text is not null").select("doc_id", "text").mapInArrow(label, EXAMPLES)


def sureness(line: Line, start: np.ndarray, end: np.ndarray, net: Network) -> np.ndarray:
    """The highest probability over the windows of each place."""
    if not len(start):
        return np.zeros(0)
    first, stop, counts = windows(start, end, net.how)
    return np.maximum.reduceat(net.probability_at(line, first, stop), np.cumsum(counts) - counts)


def finding_scores(docs: DataFrame, net: Network) -> DataFrame:
    """The score of every finding of the patterns."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data in documents_in(batches):
            texts = [t.decode("utf-8", "replace") if t else "" for t in data]
            asked = [(n, *value(text, span)) for n, text in enumerate(texts) for span in base_spans(text)]
            if asked:
                line = Line(texts, net.how)
                yield pa.RecordBatch.from_arrays([pa.array(sureness(line, *line.places(asked), net))], names=["score"])

    return id_and_text(docs).where("text is not null").mapInArrow(score, "score double")


def train(docs: DataFrame, how: Settings = Settings()) -> Network | None:
    """A network from at most `examples` findings and as many other candidates of all documents,
    with the threshold that `recall` of all findings reach."""
    found = settled(examples(docs, how).distinct())
    sample = [
        r
        for label in (0, 1)
        for r in found.where(F.col("label") == label).orderBy("draw", "view").limit(how.examples).collect()
    ]
    truth = np.asarray([r["label"] for r in sample], dtype=np.float64)
    if not 0 < truth.sum() < len(truth):
        return None
    rows = np.asarray([np.frombuffer(r["view"], np.uint8) for r in sample], dtype=np.int64)
    mixed = np.argsort([r["draw"] for r in sample], kind="stable")
    net = fit(rows[mixed], truth[mixed], how)
    quantile = F.percentile_approx("score", 1 - how.recall, 100_000)
    net.threshold = finding_scores(docs, net).agg(quantile.alias("low")).first()["low"]
    return net


def unnamed(texts: list[str], found: list[list[tuple[int, int, int]]], net: Network) -> list[tuple[int, int, int]]:
    """Candidates (text, start, end) that no pattern covers and the network is sure of, in order."""
    line = Line(texts, net.how)
    start, end = line.candidates()
    free = ~touches(start, end, line.places([(n, a, b) for n, spans in enumerate(found) for a, _, b in spans]))
    start, end = start[free], end[free]
    sure = sureness(line, start, end, net) >= net.threshold
    number = line.text_of(start[sure])
    shift = line.starts[number]
    return list(zip(number.tolist(), (start[sure] - shift).tolist(), (end[sure] - shift).tolist()))


def all_spans(texts: list[bytes | None], net: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """Per text, the patterns' spans and all spans, as (start, kind, end) in order."""
    plain = [data.decode("utf-8", "replace") if data else "" for data in texts]
    found = [base_spans(text) for text in plain]
    more: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, a, b in unnamed(plain, found, net) if net else ():
        own = more[number]
        if own and (a < own[-1][2] or a == own[-1][2] + 1 and plain[number][a - 1] in SEPARATORS):
            own[-1] = (own[-1][0], 3, max(own[-1][2], b))
        else:
            own.append((a, 3, b))
    return [(named(base), named(sorted(base + extra))) for base, extra in zip(found, more)]


def named(spans: list[tuple[int, int, int]]) -> list[Span]:
    return [(start, KINDS[kind], end) for start, kind, end in spans]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def spans(text: Column, net: Network | None) -> Column:
    """Struct of the patterns' counts and digest and of all spans."""

    def judge(texts: list[bytes | None]) -> list[pa.Array]:
        found = all_spans(texts, net)
        return [
            *[pa.array([sum(k == kind for _, k, _ in base) for base, _ in found], pa.int64()) for kind in KINDS[:3]],
            pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
            pa.array([joined(every) for _, every in found], pa.string()),
        ]

    return per_text(judge, FOUND)(text.cast("string"))


MASK = "[secret]"


def without(text: str, found: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by a mark."""
    out, done = [], 0
    last = None
    for start, _, end in found:
        if last is None or start >= last:
            out += [text[done:start], MASK]
            last = end
        last = done = max(last, end)
    return "".join(out) + text[done:]


def redacted(text: Column, net: Network | None) -> Column:
    """The text with all secrets replaced; null stays null."""

    def judge(texts: list[bytes | None]) -> list[pa.Array]:
        answers = []
        for data, (_, every) in zip(texts, all_spans(texts, net)):
            plain = None if data is None else data.decode("utf-8", "replace")
            answers.append(without(plain, every) if every else plain)
        return [pa.array(answers, pa.string())]

    return per_text(judge, "plain string")(text.cast("string"))["plain"]
