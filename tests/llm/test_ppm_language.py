import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from textdata import SF_DIR, empty, odd, odd_rows, prose, table  # noqa: F401

from revtrail.llm import ppm_language, queries
from revtrail.llm.ppm_language import code_lengths, identify, train


def brute_bits(train_texts, text, order):
    """Code length by the tree of plain dictionaries, one symbol at a time."""
    after = Counter()
    for t in train_texts:
        data = b"\n" * order + t.lower().encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                after[data[i - k : i], data[i]] += 1
    total, kinds = Counter(), Counter()
    for (context, _), n in after.items():
        total[context] += n
        kinds[context] += 1
    bits = 0.0
    data = b"\n" * order + text.lower().encode()
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            context = data[i - k : i]
            if not total[context]:
                continue
            n = after[context, data[i]]
            weight = total[context] + kinds[context]
            if n:
                bits += math.log2(weight / n)
                break
            bits += math.log2(weight / kinds[context])
        else:
            bits += 8
    return bits


def test_code_lengths_match_brute_force(table):
    texts = {"aa": [prose(i, 30, "abcd") for i in range(6)], "bb": [prose(i, 30, "cdéf") for i in range(6)]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((g, t) for g, ts in texts.items() for t in ts)]
    trees = train(table(rows), order=3, sample=10**6)
    tests = [prose(99, 20, "abc"), prose(98, 20, "déf"), "QQQ zz", "x", texts["aa"][0]]
    found = code_lengths(trees, [t.encode() for t in tests])
    for row, text in zip(found, tests):
        for bits, lang in zip(row, trees.langs):
            assert bits == pytest.approx(brute_bits(texts[lang], text, 3), rel=1e-4)


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = queries.op10_ppm_language(spark, SF_DIR).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [(r["lang_pred"], docs[r["doc_id"]]["lang"]) for r in found if r["held_out"] and docs[r["doc_id"]]["lang"]]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)


def test_odd_rows(odd, odd_rows):
    trees = train(odd)
    assert trees.langs == ["aa", "bb"]
    found = odd.select("doc_id", identify(F.col("text"), trees).alias("p")).select("doc_id", "p.*").collect()
    assert len(found) == len(odd_rows)
    blank = sorted(str(r["doc_id"]) for r in found if r["lang_pred"] == "und")
    assert blank == sorted(str(r[0]) for r in odd_rows if not r[1] or not r[1].strip())
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") for r in found)
    assert len({(r["lang_pred"], r["score"]) for r in found if r["doc_id"] in (1, 2)}) == 1


def test_digits_alone_have_no_language(table):
    trees = train(table([(1, "abc abd", "aa"), (2, "xyz xyy", "bb")]))
    found = table([(1, "123 !!"), (2, "abc")]).select(identify(F.col("text"), trees).alias("p")).select("p.*").collect()
    assert [r["lang_pred"] for r in found] == ["und", "aa"]


def test_equal_lengths_go_to_the_first_name(table):
    trees = train(table([(1, "same words", "bb"), (2, "same words", "aa")]))
    assert table([(1, "same")]).select(identify(F.col("text"), trees)["lang_pred"]).first()[0] == "aa"


def test_nothing_to_learn_from(empty, table):
    assert train(empty) is None
    assert train(table([(1, "abc", None), (2, None, "aa")])) is None
    assert table([(1, "abc")]).select(identify(F.col("text"), None)["lang_pred"]).first()[0] == "und"
    assert empty.select(identify(F.col("text"), None)).collect() == []


def test_sample_bounds_what_teaches(table):
    rows = [(i, prose(i, 5), "aa" if i % 4 else "bb") for i in range(2000)]
    kept = ppm_language.sampled(table(rows), 200).groupBy("lang").count().collect()
    assert all(130 < r["count"] < 280 for r in kept) and len(kept) == 2
