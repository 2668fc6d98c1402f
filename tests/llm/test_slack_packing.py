import zlib
from collections import Counter

import numpy as np
from textdata import SF_DIR, empty, odd, odd_rows, table  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revtrail.llm import queries, slack_packing
from revtrail.llm.slack_packing import fullest, pack, plan, slots


def check_layout(rows, limit=1024):
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= limit
    return len(used)


def reference(texts, limit=1024):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    out = Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % limit or limit
        cuts = [0, *range(first, len(ids) + 1, limit)]
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            data = np.asarray(ids[a:b], dtype="<u4").tobytes()
            out[doc_id, number, a, b - a, zlib.crc32(data)] += 1
    return out


def found_pieces(rows):
    return Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)


def test_every_token_once(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = queries.op4_slack_packing(spark, SF_DIR).collect()
    assert found_pieces(rows) == reference(texts)
    least = -(-sum(r["length"] for r in rows) // 1024)
    assert check_layout(rows) <= least * 1.05 + 1


def test_odd_rows(odd, odd_rows):
    rows = pack(odd, queries.TOKENIZER).collect()
    assert found_pieces(rows) == reference([r[:2] for r in odd_rows])
    check_layout(rows)


def test_odd_blanks(table):
    texts = ["a  b", "x <|endoftext|> y", " lead", "trail ", "a\n b", "a \n b", "don't  it's \t x", "   ", "word's, end.", "é ñ  x", "a\n\n  b 12 3!! .."]
    rows = pack(table(enumerate(texts)), queries.TOKENIZER).collect()
    assert found_pieces(rows) == reference(enumerate(texts))


def test_empty_table(empty):
    assert pack(empty, queries.TOKENIZER).collect() == []


def test_small_limit_cuts_with_the_rest_first(table):
    rows = pack(table([(1, "one two three four five six seven")]), queries.TOKENIZER, limit=3).collect()
    assert sorted((r["piece"], r["start"], r["length"]) for r in rows) == [(0, 0, 2), (1, 2, 3), (2, 5, 3)]
    check_layout(rows, 3)


def best_fill(counts, room):
    sums = {0}
    for length, count in counts.items():
        sums = {s + k * length for s in sums for k in range(count + 1) if s + k * length <= room}
    return max(sums)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 4), max_size=6), st.integers(0, 40))
def test_fullest_fills_as_far_as_possible(counts, room):
    chosen = fullest(counts, room)
    assert all(k <= counts[n] for n, k in chosen.items())
    assert sum(n * k for n, k in chosen.items()) == best_fill(counts, room)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 500), max_size=12))
def test_plan_places_every_piece(counts):
    bins = plan(counts, 30)
    used = Counter()
    for times, chosen in bins:
        assert times > 0 and sum(n * k for n, k in chosen.items()) <= 30
        for n, k in chosen.items():
            used[n] += times * k
    assert used == Counter(counts)
    for length, first, after, per_bin, _, _ in slots(bins):
        assert 0 <= first < after <= counts[length] and (after - first) % per_bin == 0


def test_plan_stays_small_for_any_corpus():
    draw = np.random.default_rng(1)
    counts = {n: int(draw.integers(1, 10**9)) for n in range(1, 1025)}
    bins = plan(counts)
    assert len(bins) < 8000
    assert sum(t for t, _ in bins) <= -(-sum(n * c for n, c in counts.items()) // 1024) * 1.01 + 1


def test_vocabularies_of_other_kinds_go_through_the_tokenizer(tmp_path):
    assert slack_packing.ranks({"model": {"type": "WordPiece"}}) is None
