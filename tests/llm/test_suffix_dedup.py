import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from textdata import SF_DIR, empty, odd, odd_rows, prose, table  # noqa: F401

from revtrail.llm import queries, suffix_dedup
from revtrail.llm.suffix_dedup import common, front_coded, merge, unpack, without_repeats


def brute(docs, width):
    """Result rows for documents in their order."""
    seen, out = set(), []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for start in range(len(data) - width + 1):
            window = data[start : start + width]
            if window in seen:
                gone[start : start + width] = b"\1" * width
            seen.add(window)
        spans = sum(g and not b for g, b in zip(gone, b"\0" + gone))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows(found):
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("width, hot, letters", [(30, 4000, "ab "), (30, 3, "abcde"), (100, 5, "abcdefgh ")])
def test_matches_brute_force(table, width, hot, letters):
    draw = random.Random(width + hot)
    pool = ["".join(draw.choices(letters, k=draw.randint(5, 150))) for _ in range(12)]
    docs = []
    for i in range(120):
        parts = [
            draw.choice(pool) if draw.random() < 0.6 else "".join(draw.choices(letters + "é", k=40))
            for _ in range(draw.randint(0, 6))
        ]
        docs.append((i, None if i == 7 else "".join(parts)))
    mixed = draw.sample(docs, len(docs))
    found = without_repeats(table(mixed).repartition(5), width, hot)
    assert rows(found) == sorted(brute(docs, width), key=str)


def test_whole_table(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    assert rows(queries.op5_suffix_dedup(spark, SF_DIR)) == sorted(brute(docs, 100), key=str)


def test_odd_rows(odd, odd_rows):
    found = rows(without_repeats(odd))
    known = sorted((r[:2] for r in odd_rows if r[0] not in (None, 12)), key=lambda r: r[0])
    expected = brute(known, 100)
    assert [r for r in found if r[0] not in (None, 12)] == sorted(expected, key=str)
    assert len(found) == len(odd_rows)
    assert [r[1:3] for r in found if r[0] is None and not r[1]] == [(0, 0)]


def test_empty_table(empty):
    assert without_repeats(empty).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=8).map(lambda b: bytes(c % 3 for c in b)), max_size=8), min_size=1, max_size=6))
def test_merge_gives_all_suffixes_in_order_with_shared_prefixes(lists):
    heads = []
    for own in lists:
        lcps, tails = front_coded(sorted(own))
        sizes = np.asarray([len(s) for s in sorted(own)], dtype=np.int64)
        assert unpack(np.asarray(lcps, dtype=np.int64), sizes, tails) == sorted(own)
        heads.append((sorted(own), lcps))
    found = list(merge(heads))
    texts = [heads[run][0][at] for run, at, _ in found]
    assert texts == sorted(s for own in lists for s in own)
    before = [b"", *texts]
    assert [same for _, _, same in found] == [common(a, b, 0) for a, b in zip(before, texts)]


def test_every_window_has_one_anchor_that_follows_its_text():
    from revtrail.llm.frames import Chunk

    draw = random.Random(1)
    shared = bytes(draw.choices(b"abcd", k=300))
    texts = [bytes(draw.choices(b"abcd", k=n)) + shared + bytes(draw.choices(b"abcd", k=n)) for n in (0, 7, 99, 150)]
    sizes = np.asarray([len(t) for t in texts])
    chunk = Chunk(0, np.arange(4), np.ones(4, bool), sizes, b"".join(texts))
    found = suffix_dedup.anchors(chunk, 100)
    owned = [s for a, b in zip(found.low.tolist(), found.high.tolist()) for s in range(a, b + 1)]
    assert sorted(owned) == [s for a, b in zip(chunk.starts, chunk.ends) for s in range(a, b - 99)]
    back = {}
    for place, low, high in zip(found.place.tolist(), found.low.tolist(), found.high.tolist()):
        for start in range(low, high + 1):
            text = chunk.data[start : start + 100]
            assert back.setdefault(text, place - start) == place - start


@pytest.mark.parametrize("parts, hot", [(1, 4000), (5, 4000), (5, 20)])
def test_long_copies_with_changes_match_brute_force(table, parts, hot):
    draw = random.Random(parts + hot)
    pool = [prose(n, draw.randint(50, 900)) for n in range(8)]
    line = prose(99, 25) + "\n"
    docs = []
    for i in range(60):
        words = draw.choice(pool).split()
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = prose(draw.random(), 1)
        text = " ".join(words[draw.choice([0, 0, 7]) :]) + line * draw.choice([0, 1, 1, 8])
        docs.append((i, text + prose(1000 + i, draw.choice([0, 12]))))
    mixed = draw.sample(docs, len(docs))
    found = without_repeats(table(mixed).repartition(parts), 100, hot)
    assert rows(found) == sorted(brute(docs, 100), key=str)


def test_equal_ids_and_unknown_ids_keep_one_copy(table):
    text = prose(5, 700)
    found = rows(without_repeats(table([(i, text) for i in (7, 7, None, 3, None, 9)]).repartition(3)))
    assert [r[0] for r in found if not r[2]] == [3]
    assert all(r[2] == len(text) for r in found if r[0] != 3)


def shuffled_rows(plan):
    """Rows that all exchanges of an executed plan wrote."""
    kind, total = plan.getClass().getSimpleName(), 0
    if kind == "ShuffleExchangeExec":
        total = plan.metrics().apply("shuffleRecordsWritten").value()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(plan.plan())
    children = plan.children()
    return total + sum(shuffled_rows(children.apply(i)) for i in range(children.size()))


def test_rows_sent_do_not_grow_as_the_square_of_the_input(table):
    def sent(size):
        found = without_repeats(table([(i, prose(i // 2, 30_000) + prose(-i, 50)) for i in range(size)]).repartition(2))
        found.collect()
        return shuffled_rows(found._jdf.queryExecution().executedPlan())

    few, many = sent(10), sent(60)
    assert 0 < many < 2 * few


def test_records_without_spans_are_what_lies_between():
    draw = random.Random(3)
    low = np.cumsum([draw.randint(1, 40) for _ in range(200)])
    high = low + np.asarray([draw.randint(0, 30) for _ in low])
    ints = np.arange(len(low), dtype=np.uint64)
    found = suffix_dedup.Records(high + 5, ints, np.full(len(low), 5), high + 5 - low, ints)
    spans = suffix_dedup.merged_spans(np.asarray([(a, a + draw.randint(0, 25)) for a in range(0, 4000, 31)]))
    left = suffix_dedup.outside(found, spans)
    gone = {s for a, b in spans.tolist() for s in range(a, b + 1)}
    expected = sorted((i, s) for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())) for s in range(a, b + 1) if s not in gone)
    starts = zip(left.key.tolist(), (left.place - left.far).tolist(), (left.place - left.near).tolist())
    assert sorted((i, s) for i, a, b in starts for s in range(a, b + 1)) == expected


@pytest.mark.parametrize("size, most", [(0, 10), (1, 10), (500, 40), (500, 10**6)])
def test_records_go_in_parts_by_key(monkeypatch, size, most):
    monkeypatch.setattr(suffix_dedup, "HELD_WINDOWS", most)
    draw = np.random.default_rng(size)
    key, near, wide = draw.integers(0, 60, size).astype(np.uint64), draw.integers(0, 9, size), draw.integers(0, 5, size)
    found = suffix_dedup.Records(np.arange(size), key, near, near + wide, key)
    parts = list(suffix_dedup.by_key(found))
    assert sorted(n for p in parts for n in p.place.tolist()) == list(range(size))
    assert sum(len(set(p.key.tolist())) for p in parts) == len(set(key.tolist()))
    assert all((p.far - p.near + 1).sum() <= most + max(np.bincount(key.astype(int), wide + 1)) for p in parts)
    assert len(parts) <= 1 + (wide + 1).sum() // most
