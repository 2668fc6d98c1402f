import random

from hypothesis import given, settings
from hypothesis import strategies as st
from textdata import SF_DIR, empty, odd, odd_rows, prose, table  # noqa: F401

from revtrail.llm import edit_decontam, queries
from revtrail.llm.edit_decontam import Budget, Searcher, myers, normal, pieces

ITEMS = "item_id long, text string"


def distance(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        now = [i]
        for j, x in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != x)))
        before = now
    return min(before)


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", min_size=1, max_size=80), st.text("ab ", max_size=100))
def test_myers_matches_the_table(pattern, text):
    best, end = myers(pattern, text)
    assert best == distance(pattern, text)
    assert distance(pattern, text[:end]) == best


@settings(max_examples=100, deadline=None)
@given(st.text("abc", min_size=1, max_size=60), st.integers(0, 8))
def test_pieces_cover_the_item(text, edits):
    edits = min(edits, len(text) - 1)
    found = pieces(text, edits)
    assert len(found) == edits + 1 and "".join(p for _, p in found) == text
    assert all(p and text[a : a + len(p)] == p for a, p in found)


def test_search_matches_brute_force():
    draw = random.Random(8)
    items = [(i, prose(i, draw.randint(5, 14), "abc")) for i in range(12)]
    texts = []
    for n in range(60):
        own = list(items[n % 12][1])
        for _ in range(draw.randint(0, 6)):
            place = draw.randrange(len(own))
            own[place : place + draw.randint(0, 1)] = draw.choice(["", "z", "ab"])
        texts.append(prose(100 + n, 20, "abc") + " " + "".join(own) + " " + prose(200 + n, 20, "abc"))
    budget = Budget(share=0.08)
    search = Searcher(tuple(items), budget)
    for text in texts:
        expected = {
            (i, d) for i, t in items if len(t) >= budget.least and (d := distance(t, normal(text))) <= budget.edits(len(t))
        }
        expected |= {(i, 0) for i, t in items if len(t) < budget.least and f" {t} " in f" {normal(text)} "}
        assert {(i, d) for i, d, _ in search.matches(text.encode())} == expected


def test_short_items_match_whole_words_without_edits():
    search = Searcher(((1, "four score"), (2, "7"), (3, ""), (4, "(b) yes!")), Budget())

    def found(text):
        return [(i, d, text[:end][-10:]) for i, d, end in search.matches(text.encode())]

    assert found("its fourscore") == found("four scores") == found("xfour score") == found("four  scor") == found("77") == []
    assert found("xfour score, four score.") == [(1, 0, "four score")]
    assert search.matches(b"Four\n SCORE") == [(1, 0, 10)]
    assert search.matches(b"of 17, 7 are") == [(2, 0, 8)]
    assert search.matches(b"say (B) yes!no") == [(4, 0, 12)]
    assert Searcher(((3, ""), (5, "")), Budget()).matches(b"any text") == []


def test_one_very_long_text(spark, table):
    text = prose(5, 300) + " " + " ".join(["word"] * 400_000) + " the quick brown fox jumps over the lazy dag"
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog"), (2, "lazy dag"), (3, "wor")], ITEMS)
    found = edit_decontam.contamination(table([(9, text)]), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in found) == [(9, 1, 1), (9, 2, 0)]


def test_whole_tables(spark):
    docs = {r["doc_id"]: normal(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    items = {r["item_id"]: normal(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    exact = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    found = queries.op8_edit_decontam(spark, SF_DIR).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if r["distance"] == 0} == exact
    for r in found:
        assert distance(items[r["item_id"]], docs[r["doc_id"]]) == r["distance"]


def test_odd_rows(spark, odd, odd_rows):
    copied = odd_rows[0][1]
    items = spark.createDataFrame(
        [(1, copied[:120]), (1, copied[:120]), (2, None), (3, ""), (4, "short"), (None, copied[40:200].upper())], ITEMS
    )
    found = edit_decontam.contamination(odd, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} >= {(1, 1), (2, 1), (1, None), (2, None)}
    assert {r["item_id"] for r in found} == {1, None} and len([r for r in found if r["item_id"] == 1 and r["doc_id"] == 1]) == 2
    kept = edit_decontam.clean(odd, items)
    assert kept.columns == odd.columns
    gone = {r["doc_id"] for r in found}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in odd_rows if r[0] not in gone)


def test_empty_tables(spark, odd, empty, odd_rows):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, odd_rows[0][1])], ITEMS)
    assert edit_decontam.contamination(odd, none).collect() == []
    assert edit_decontam.contamination(empty, some).collect() == []
    assert edit_decontam.clean(odd, none).count() == len(odd_rows)


def test_blocks_hold_every_item_once(spark):
    items = spark.createDataFrame([(i, prose(i, 20)) for i in range(30)], ITEMS)
    held = list(edit_decontam.blocks(items, most=500))
    assert len(held) > 3 and [i for block in held for i, _ in block] == list(range(30))
