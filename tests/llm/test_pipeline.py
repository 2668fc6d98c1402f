import zlib

import numpy as np
import pytest
from test_bottomk_dedup import brute as components
from test_compression_bands import brute as base_counts
from test_slack_packing import check_layout
from textdata import DOCUMENTS, SF_DIR, empty, odd, odd_rows, prose, table  # noqa: F401
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from revtrail.llm import compression_bands, edit_decontam, queries, secret_cnn


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Stages on the smallest tables, each written and read again."""
    path = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    outputs = {"input": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(path / name))
        docs = spark.read.parquet(str(path / name))
        outputs[name] = docs.collect()
    return outputs


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_quality_keeps_what_passes(spark, folder):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    judge = compression_bands.Judge(compression_bands.learned(docs, labels))
    expected = [r["doc_id"] for r in folder["input"] if not base_counts(r["text"])[5] and judge(r["text"].encode())[0]]
    assert ids(folder["quality"]) == sorted(expected)


def test_near_duplicates_keep_one_of_each(folder):
    rows = [(r["doc_id"], r["text"]) for r in folder["quality"]]
    assert ids(folder["near_duplicates"]) == sorted({c for _, _, c in components(rows)})


def test_decontamination_drops_what_holds_an_item(spark, folder):
    items = [edit_decontam.normal(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = set(ids(folder["decontamination"]))
    for r in folder["near_duplicates"]:
        if any(item in edit_decontam.normal(r["text"]) for item in items):
            assert r["doc_id"] not in kept
    assert len(folder["near_duplicates"]) - len(kept) < 0.2 * len(kept)


def test_secrets_go_and_documents_stay(folder):
    assert ids(folder["secrets"]) == ids(folder["decontamination"])
    before = {r["doc_id"]: r["text"] for r in folder["decontamination"]}
    for r in folder["secrets"]:
        assert not secret_cnn.base_spans(r["text"])
        assert r["n_chars"] == len(r["text"])
        if not secret_cnn.base_spans(before[r["doc_id"]]) and secret_cnn.MASK not in r["text"]:
            assert r["text"] == before[r["doc_id"]]


def test_packing_holds_every_token(folder):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    texts = {r["doc_id"]: r["text"] for r in folder["secrets"]}
    pieces = {}
    for r in folder["packing"]:
        pieces.setdefault(r["doc_id"], {})[r["start"]] = (r["length"], r["ids_crc32"])
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = np.asarray([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        while at < len(ids):
            length, check = pieces[doc_id][at]
            assert zlib.crc32(ids[at : at + length].tobytes()) == check
            at += length
    check_layout(folder["packing"])


def test_run_gives_the_stages_one_after_another(spark, folder):
    found = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    expected = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in folder["packing"]]
    assert sorted(map(tuple, found)) == sorted(expected)


@pytest.mark.parametrize("number", range(4))
def test_stages_return_the_columns_of_documents(spark, odd, empty, number):
    name, stage = corpus_pipeline.STAGES[number]
    for docs in (odd, empty):
        found = stage(spark, docs, SF_DIR)
        assert found.columns == docs.columns, name
        assert found.count() <= docs.count()
    assert stage(spark, empty, SF_DIR).count() == 0


def test_clashing_columns(spark, odd_rows):
    names = "doc_id long, text string, row_id string, once string, mark string, digest string, held string"
    rows = [(*r[:2], "a", "b", "c", "d", "e") for r in odd_rows]
    docs = spark.createDataFrame(rows, names)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF_DIR)
        assert [f.split()[0] for f in names.split(", ")] == docs.columns
    assert docs.count() > 0


def test_every_operator_has_a_query():
    names = entry_points.queries()
    for number in range(1, 11):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
