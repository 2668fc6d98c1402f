import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from textdata import SF_DIR, empty, odd, odd_rows, prose, table  # noqa: F401

from revtrail.llm import kneser_ney, queries
from revtrail.llm.kneser_ney import CLASS, ORDER, SYMBOLS, Rule, discounts, quality

LABELS = "doc_id long, quality long, toxic long"


def symbols(text):
    return [26] * (ORDER - 1) + [int(CLASS[b]) for b in text.encode()]


class Brute:
    """The model from plain dictionaries, highest level first."""

    def __init__(self, texts):
        top = Counter()
        for text in texts:
            s = symbols(text)
            top.update(tuple(s[i - ORDER + 1 : i + 1]) for i in range(ORDER - 1, len(s)))
        self.levels = {ORDER: top}
        for size in range(ORDER - 1, 0, -1):
            self.levels[size] = Counter(g[1:] for g in self.levels[size + 1])
        self.cuts = {n: discounts(Counter(c.values())) for n, c in self.levels.items()}
        self.after = {n: defaultdict(list) for n in self.levels}
        for n, counts in self.levels.items():
            for gram, count in counts.items():
                self.after[n][gram[:-1]].append(count)

    def cut(self, n, count):
        return min(self.cuts[n][min(count, 3) - 1], count)

    def p(self, gram):
        n = len(gram)
        if not n:
            return 1 / SYMBOLS
        below = self.p(gram[1:]) if n > 1 else 1 / SYMBOLS
        seen = self.after[n].get(gram[:-1])
        if not seen:
            return below
        held = sum(self.cut(n, c) for c in seen)
        count = self.levels[n].get(gram, 0)
        return ((count - self.cut(n, count) if count else 0) + held * below) / sum(seen)

    def perplexity(self, text):
        s = symbols(text)
        logs = [math.log(self.p(tuple(s[i - ORDER + 1 : i + 1]))) for i in range(ORDER - 1, len(s))]
        return math.exp(-sum(logs) / len(logs)) if logs else None


def test_model_and_perplexities_match_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    trusted = {r["doc_id"] for r in labels if r["quality"] == 1 and not r["toxic"]}
    brute = Brute([docs[i] for i in sorted(trusted) if i in docs])
    found = {r["doc_id"]: r for r in queries.op2_kneser_ney(spark, SF_DIR).collect()}
    assert set(found) == set(docs)
    for doc_id in sorted(docs)[::7]:
        assert found[doc_id]["perplexity"] == pytest.approx(brute.perplexity(docs[doc_id]), rel=1e-4)
    own = [found[i]["kept"] for i in trusted if i in found]
    assert sum(own) >= 0.97 * len(own)


def test_probabilities_add_up_to_one():
    brute = Brute(["the cat sat on the mat", "a cat and a hat", "on and on"])
    for context in [(), (19,), (19, 7), (0, 1, 2), (26, 26, 19)]:
        assert sum(brute.p((*context, s)) for s in range(SYMBOLS)) == pytest.approx(1)


def test_discounts_stay_in_bounds():
    for of in ({}, {1: 5}, {1: 10, 2: 4, 3: 2, 4: 1}, {1: 1, 2: 100, 3: 1, 4: 50}):
        found = discounts(of)
        assert all(0 < d <= i for i, d in enumerate(found, 1))


def test_classes_fold_case_and_fit():
    assert len(CLASS) == 256 and int(CLASS.max()) < SYMBOLS
    assert CLASS[ord("A")] == CLASS[ord("a")] and len({int(c) for c in CLASS}) > 50


def test_every_byte_but_case_is_a_symbol_of_its_own(spark, table):
    other = [b for b in range(256) if chr(b) not in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    assert sorted(int(CLASS[b]) for b in other) == list(range(SYMBOLS))
    trusted = "né # né # né # né"
    rows = [(1, trusted, "aa"), (2, "nù # né", "aa"), (3, "né $ né", "aa"), (4, "né # né", "aa"), (5, "n\u4e00é\t#\x00", "aa")]
    brute = Brute([trusted])
    found = {r["doc_id"]: r["perplexity"] for r in quality(table(rows), spark.createDataFrame([(1, 1, 0)], LABELS)).collect()}
    assert found == {i: pytest.approx(brute.perplexity(text), rel=1e-4) for i, text, _ in rows}
    assert found[2] > 1.2 * found[4] and found[3] > 1.2 * found[4]


def test_counts_of_steps_add_up(monkeypatch):
    texts = [b"abc\xff\xfeabc", b"", b"Abc abc", b"\n\xe4\xb8\x80 abc"]
    whole = Counter(t for text in texts for t in kneser_ney.ngrams([text])[0].tolist())
    monkeypatch.setattr(kneser_ney, "_STEP", 6)
    grams, counts = kneser_ney.tally(texts)
    assert dict(zip(grams.tolist(), counts.tolist())) == whole and (np.diff(grams.astype(np.int64)) > 0).all()


def test_noise_goes_and_prose_stays(spark, table):
    rows = [(i, prose(i, 60, "etaoin"), "aa") for i in range(80)]
    noise = (900, "".join(chr(33 + (i * 37) % 90) for i in range(400)), "aa")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(80)], LABELS)
    kept = {r["doc_id"]: r["kept"] for r in quality(table([*rows, noise]), labels).collect()}
    assert not kept[900] and sum(kept.values()) >= 78


def test_odd_rows(spark, odd, odd_rows):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, None), (3, None, None), (None, 1, 0), (7, 0, 0), (11, 1, 1)], LABELS)
    found = quality(odd, labels, Rule(enough=1)).collect()
    assert len(found) == len(odd_rows)
    blank = [r for r in found if r["perplexity"] is None]
    assert sorted(str(r["doc_id"]) for r in blank) == sorted(str(r[0]) for r in odd_rows if not r[1])
    assert not any(r["kept"] for r in blank)
    same = {r["perplexity"] for r in found if r["doc_id"] in (1, 2)}
    assert len(same) == 1


def test_without_trusted_documents_the_model_is_uniform(spark, table):
    found = quality(table([(1, "abc def", "aa")]), spark.createDataFrame([], LABELS)).collect()
    assert [(r["perplexity"], r["kept"]) for r in found] == [(pytest.approx(SYMBOLS), True)]


def test_empty_table(spark, empty):
    assert quality(empty, spark.createDataFrame([(1, 1, 0)], LABELS)).collect() == []


def test_questions_hold_every_context():
    keys = kneser_ney.questions([b"abcab", b"zz"])
    assert len(np.unique(keys)) == len(keys) and (np.diff(keys.astype(np.int64)) > 0).all()
