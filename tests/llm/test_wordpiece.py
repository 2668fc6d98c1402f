import random

from hypothesis import given, settings
from hypothesis import strategies as st
from textdata import SF_DIR, empty, odd, odd_rows, table  # noqa: F401

from revtrail.llm import queries, wordpiece


def greedy(word, vocabulary):
    """Longest match first; a word that cannot be spelled is one token."""
    count = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 1
        count, at = count + 1, end
    return count


letters = st.binary(max_size=14).map(lambda b: bytes(97 + c % 3 for c in b))


@settings(max_examples=200, deadline=None)
@given(st.sets(letters.map(lambda b: b[:5]), max_size=12), st.lists(letters, max_size=20))
def test_automaton_matches_greedy(vocabulary, words):
    vocabulary = {v for v in vocabulary if v}
    counts = wordpiece.build(sorted(vocabulary)).counts(words)
    assert counts.tolist() == [greedy(w, vocabulary) for w in words]


def test_long_words_and_vocabularies():
    draw = random.Random(6)
    vocabulary = {bytes(draw.choices(b"ab", k=draw.randint(1, 40))) for _ in range(400)} | {b"a", b"b"}
    words = [bytes(draw.choices(b"ab", k=draw.randint(0, 3000))) for _ in range(20)]
    assert wordpiece.build(sorted(vocabulary)).counts(words).tolist() == [greedy(w, vocabulary) for w in words]


def expected(text, vocabulary):
    words = (text or "").encode().split()
    return len(words), sum(greedy(b" " + w, vocabulary) for w in words)


def test_whole_table(spark):
    vocabulary = set(wordpiece.vocabulary(queries.PIECES))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = queries.op3_wordpiece(spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for row in found:
        assert (row["n_words"], row["n_tokens"]) == expected(texts[row["doc_id"]], vocabulary)


def test_odd_rows(odd, odd_rows):
    vocabulary = set(wordpiece.vocabulary(queries.PIECES))
    found = wordpiece.count_tokens(odd, queries.PIECES).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_tokens"]) for r in found) == sorted(
        (r[0] or 0, *expected(r[1], vocabulary)) for r in odd_rows
    )


def test_empty_table(empty):
    assert wordpiece.count_tokens(empty, queries.PIECES).collect() == []
