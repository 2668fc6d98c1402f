import random
import re
from collections import Counter

import numpy as np
import pytest
import zstandard
from pydoc_data.topics import topics
from textdata import SF_DIR, empty, odd, odd_rows, table  # noqa: F401

from revtrail.llm import compression_bands, queries
from revtrail.llm.compression_bands import LOOSE, Bands, Learning, learned

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in lines
            lines.add(line)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        repeats,
        len(inside),
        failed,
    )


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = queries.op1_compression_bands(spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for row in found:
        assert tuple(row[f] for f in FIELDS) == brute(texts[row["doc_id"]])
        assert not (row["base_failed"] and row["kept"])


def test_odd_rows(odd, odd_rows):
    found = compression_bands.quality_bands(odd).collect()
    expected = sorted((r[0] or 0, *brute(r[1])) for r in odd_rows)
    assert sorted((r["doc_id"] or 0, *[r[f] for f in FIELDS]) for r in found) == expected


def test_empty_table(empty):
    assert compression_bands.quality_bands(empty).collect() == []


def test_windows_that_overlap_themselves(table):
    texts = ["a " * 30, "a b " * 12, " ".join(map(str, range(40))) + " " + " ".join(map(str, range(10)))]
    found = compression_bands.quality_bands(table(enumerate(texts))).collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in found} == {i: brute(t)[4] for i, t in enumerate(texts)}


def test_bands_reject_repetition_and_noise(table):
    draw = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    prose = " ".join("".join(draw.choices(letters[:12], k=draw.randint(2, 8))) for _ in range(500))
    noise = " ".join("".join(draw.choices(letters + letters.upper() + "0123456789+/", k=70)) for _ in range(60))
    repeated = " ".join(f"{i} same words again" for i in range(300))
    verdict = {r["doc_id"]: r["kept"] for r in compression_bands.quality_bands(table([(1, prose), (2, noise), (3, repeated)])).collect()}
    assert verdict == {1: True, 2: False, 3: False}


def test_chunks_show_a_bad_stretch_that_the_whole_hides():
    draw = random.Random(5)
    prose = " ".join("".join(draw.choices("abcdefghijkl", k=draw.randint(2, 8))) for _ in range(1200))
    text = (prose + " " + "zz " * 1400).encode()
    judge = compression_bands.Judge(Bands())
    fine, ratio, chunks, out = judge(text)
    assert ratio > 0.2 and out > chunks / 4 and not fine
    assert ratio == len(zstandard.ZstdCompressor(level=3).compress(text)) / len(text)


def test_marks_and_bars_fall_and_the_same_words_without_them_stay(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1 and toxic = 0").collect()
    judge = compression_bands.Judge(Bands())
    draw = random.Random(6)
    good = [t for t in (docs[r["doc_id"]] for r in labels) if len(t) > 1200 and not brute(t)[5]]
    assert len(good) > 5 and all(judge(t.encode())[0] for t in good)
    for text in good:
        words = text.split()
        assert not judge(" | ".join(words).encode())[0]
        assert not judge(" ".join(w + "###" for w in words).encode())[0]
    marked = [" ".join(w + draw.choice(["###", "%%%", "&&&", "$$$", "***"]) for w in t.split()) for t in good]
    assert sum(not judge(m.encode())[0] for m in marked) >= 0.9 * len(marked)


def test_the_last_chunk_and_a_run_of_any_share_count(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1 and toxic = 0").orderBy("doc_id").collect()
    text = " ".join(t for t in (docs[r["doc_id"]] for r in labels) if not brute(t)[5]).encode()
    judge = compression_bands.Judge(Bands())
    size = Bands().chunk_bytes
    whole = text[: 12 * size]
    assert judge(whole) == (True, judge(whole)[1], 12, 0)
    # a bad stretch of 4 of 40 chunks
    long = text[: 18 * size] + (b"This " * size)[: 4 * size] + text[18 * size : 36 * size]
    fine, _, chunks, out = judge(long)
    assert not fine and out >= 2 and out <= Bands().chunk_share * chunks
    # a bad end behind one full chunk, too short for a chunk of its own
    _, _, chunks, out = judge(text[:size] + (b"This " * size)[: size - 100])
    assert (chunks, out) == (2, 1)


def judged(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_limits_come_from_the_trusted_texts_of_the_corpus(spark, table):
    """Real English, which compresses better than the test tables: half of it teaches."""
    texts = [t for _, t in sorted(topics.items()) if len(t) > 1500 and not brute(t)[5]]
    taught, others = texts[::2], texts[1::2]
    labels = judged(spark, [(i, 1, 0, None) for i in range(len(taught))])
    bands = learned(table(list(enumerate(taught))), labels)
    judge, fixed = compression_bands.Judge(bands), compression_bands.Judge(Bands())
    kept = [judge(t.encode())[0] for t in others]
    assert len(others) > 20 and np.mean(kept) >= 0.9
    assert np.mean([fixed(t.encode())[0] for t in others]) < np.mean(kept)
    draw = random.Random(2)
    for text in others:
        line = draw.choice([l for l in text.split("\n") if len(l) > 30])
        assert not judge((line * (len(text) // len(line) + 1)).encode())[0]
        noise = "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=len(text)))
        assert not judge(noise.encode())[0]


def test_limits_match_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    good = {r["doc_id"] for r in labels.where("quality = 1 and toxic = 0").collect()}
    rows = [r["text"] for r in docs.collect() if r["doc_id"] in good and r["text"] and not brute(r["text"])[5]]
    how, bands = Learning(), learned(docs, labels)
    ask = compression_bands.Judge(LOOSE)
    sized = [(len(t.encode()), ask.ratio(t.encode())) for t in rows]
    assert len(sized) > 20 and len(bands.whole) == how.classes

    def expected(values, tail, loose):
        if not len(values):
            return loose
        # the smallest value that the share of values reaches
        low, middle, high = (np.sort(values)[max(0, int(np.ceil(q * len(values))) - 1)] for q in (tail, 0.5, 1 - tail))
        own = low - 0.5 * (middle - low), high + 0.5 * (high - middle)
        return tuple((len(values) * a + 2 * b) / (len(values) + 2) for a, b in zip(own, loose))

    edges = np.asarray(LOOSE.whole).T
    for k, (size, *limits) in enumerate(bands.whole):
        assert size == (160 * 2 ** ((k + 0.5) / 2) if k else 160)
        loose = tuple(np.interp(np.log(size), np.log(edges[0]), e) for e in edges[1:])
        own = [r for n, r in sized if 160 * 2 ** (k / 2) <= n < 160 * 2 ** ((k + 1) / 2)]
        assert limits == pytest.approx(expected(own, 0.01, loose), abs=1e-9)
    chunks = [c for t in rows for c in ask.chunks(t.encode())]
    assert bands.chunk == pytest.approx(expected(chunks, 0.002, LOOSE.chunk), abs=1e-9)


def test_limits_without_trusted_documents_are_loose(spark, table, odd, empty):
    prose = " ".join(f"{w}{i}" for i, w in enumerate(["alpha", "beta", "gamma", "delta"] * 60))
    docs = table([(1, prose), (2, prose), (None, prose), (3, None), (4, "")])
    loose = learned(docs, judged(spark, []))
    assert learned(docs, judged(spark, [(1, 0, 0, "x"), (2, 1, 1, "x"), (3, 1, 0, "x"), (4, 1, 0, "x"), (None, 1, 0, "x")])) == loose
    assert learned(docs, judged(spark, [(1, 1, 0, "x"), (1, 0, 0, "x"), (2, 1, 0, "x"), (2, 1, 1, "x")])) == loose
    assert learned(docs, judged(spark, [(2, 1, None, "x"), (2, 1, 0, "x")])) != loose
    assert learned(empty, judged(spark, [(1, 1, 0, None)])) == loose
    assert loose.chunk == LOOSE.chunk and loose.whole[0] == LOOSE.whole[0]
    assert len(learned(odd, judged(spark, [(1, 1, 0, None)])).whole) == Learning().classes
