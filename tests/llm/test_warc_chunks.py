import base64
import hashlib
import io
from collections import defaultdict

import pytest
from textdata import SF_DIR

from revtrail.llm import queries, warc_chunks

PAGES = "page_id long, url string, html string, digest string, size string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least=0):
    groups = defaultdict(list)
    for page, url, html in rows:
        if len((html or "").encode()) >= least:
            groups[digest(html)].append((page is not None, page or 0, url is not None, url or "", page))
    first = {d: max(g) for d, g in groups.items()}
    out, used = [], set()
    for page, url, html in rows:
        d = digest(html)
        own = (page is not None, page or 0, url is not None, url or "", page)
        revisit = d in first and (own != first[d] or d in used)
        if d in first and own == first[d]:
            used.add(d)
        kind = ("revisit", first[d][4]) if revisit else ("response", None)
        out.append((page, len((html or "").encode()), d, *kind))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (3, "http://a/3 \r\nX: y", "ünï 漢字\r\n\r\nWARC/1.1\r\n"),
    (4, None, None),
    (5, "", ""),
    (6, "http://a/6", "x" * 700_001),
    (7, "http://a/7", "x" * 700_001),
    (7, "http://a/7", "x" * 700_001),
    (7, "http://a/0", "x" * 700_001),
    (8, "http://a/8", "one"),
    (8, "http://a/8", "two"),
    (None, "http://a/n", "<p>same</p>"),
    (None, None, "no id"),
    (None, None, "no id"),
    (-9, "http://a/m", "y" * 64),
]


def build(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES).repartition(3)


@pytest.mark.parametrize("least", [0, 12])
def test_records_match_brute_force(spark, least):
    found = warc_chunks.archived(build(spark, ROWS), least=least).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected(ROWS, least)


@pytest.mark.parametrize("chunk", [7, 64, 1 << 18])
def test_payloads_come_back_in_chunks(spark, tmp_path, chunk):
    rows = [r for r in ROWS if len(r[2] or "") < 1000]
    written = warc_chunks.records(build(spark, rows), str(tmp_path), chunk_bytes=chunk)
    files = warc_chunks.archives(written, f"{tmp_path}/a", file_bytes=200)
    assert files.count() > 3
    back = defaultdict(list)
    for r in warc_chunks.chunk_table(files, chunk).collect():
        if r["record_type"] == "response":
            back[r["record_id"]].append(r)
    found = []
    for own in back.values():
        own.sort(key=lambda r: r["chunk"])
        data = b""
        for number, r in enumerate(own):
            assert (r["chunk"], r["start"], r["length"]) == (number, len(data), len(r["data"])) and len(r["data"]) <= chunk
            data += r["data"]
            assert r["digest"] == digest(data.decode("latin-1")) or r["digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
            assert r["is_last"] == (r is own[-1])
        found.append(data.decode())
    assert sorted(found) == sorted({r[2] or "" for r in rows})
    # a listing of the folder finds the same files
    listed = warc_chunks.archives_in(spark, f"{tmp_path}/a")
    assert listed.count() == files.count()
    assert warc_chunks.record_table(warc_chunks.chunk_table(listed)).count() == len(rows)


def test_other_writers_archives(spark, tmp_path):
    body = b"plain text, no answer of a server"
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    (tmp_path / "x.warc").write_bytes((head + body + b"\r\n\r\n") * 2)
    rows = warc_chunks.chunk_table(warc_chunks.archives_in(spark, str(tmp_path)), 10).where("is_last").collect()
    assert [(r["page_id"], r["record_id"], r["start"] + r["length"], r["record_type"]) for r in rows] == [(None, "urn:uuid:1", len(body), "resource")] * 2


def test_damaged_archives_are_errors():
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 4\r\n\r\n"

    def read(data):
        stream = io.BufferedReader(io.BytesIO(data))
        return [r for b in warc_chunks.blocks(stream) for r in warc_chunks.payload_chunks(stream, b, 2, True)]

    good = head % digest("text").encode()
    assert len(read(good + b"text\r\n\r\n")) == 2
    with pytest.raises(ValueError, match="digest"):
        read(good + b"tent\r\n\r\n")
    with pytest.raises(EOFError):
        read(good + b"te")
    with pytest.raises(ValueError, match="no WARC"):
        read(b"junk\r\n")


def test_empty_table(spark):
    assert warc_chunks.archived(spark.createDataFrame([], PAGES)).collect() == []


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html")
    found = queries.op11_warc_chunks(spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected([tuple(r) for r in pages.collect()])
