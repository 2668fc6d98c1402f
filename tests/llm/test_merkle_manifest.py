import hashlib
import zlib
from collections import defaultdict

import pytest
from textdata import SF_DIR, empty, odd, odd_rows, table  # noqa: F401

from revtrail.llm import merkle_manifest, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return H(*fields)


def climbed(nodes):
    """The root over `nodes`, and per node its siblings and the sides they are on."""
    paths = [[] for _ in nodes]
    level = [(d, [i]) for i, d in enumerate(nodes)]
    while len(level) > 1:
        above = []
        for i in range(0, len(level), 2):
            run = level[i : i + 2]
            for place, (_, below) in enumerate(run):
                other = run[1 - place][0] if len(run) == 2 else None
                for n in below:
                    paths[n].append((other, place == 0))
            above.append((H(*[d for d, _ in run]), [n for _, b in run for n in b]))
        level = above
    return level[0][0], paths


def folded(own, path):
    for other, left in path:
        own = H(own) if other is None else H(own, other) if left else H(other, own)
    return own


def expected(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[lang] = (own, *climbed([leaf(*r) for r in own]))
    root, upper = climbed([trees[lang][1] for lang in langs])
    out = []
    for lang, above in zip(langs, upper):
        own, subroot, paths = trees[lang]
        for r, path in zip(own, paths):
            path = path + above
            given = r
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                given = (*r[:3], r[3] + 1, r[4])
            end = folded(leaf(*given), path)
            proof = H(*[o for o, _ in path if o is not None])
            out.append((r[0], leaf(*r), subroot, root, proof, end, end == root))
    return sorted(out, key=str)


def check(found, rows):
    assert sorted((tuple(r) for r in found), key=str) == expected(rows)


def five(rows):
    return [(r[0], r[3], r[2], r[4], r[1]) for r in rows]


def test_odd_rows(spark, odd, odd_rows):
    check(merkle_manifest.verified(odd).collect(), five(odd_rows))


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (2, 1, 3), (257, 256, 1, 511, 5), (600,)])
def test_trees_of_all_shapes(spark, table, sizes):
    rows = [(100 * n + i if n else i, f"t{i}", f"l{n}", None, i) for n, size in enumerate(sizes) for i in range(size)]
    found = merkle_manifest.verified(table(rows).repartition(3)).collect()
    check(found, five([(*r, None, None) for r in rows]))
    assert {r["verified"] for r in found if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0} <= {False}


def test_many_languages_and_repeated_rows(spark, table):
    rows = [(i % 40, "same", f"l{i % 300:03d}" if i % 300 else None, "s", 4) for i in range(700)]
    rows += [(7, "copy", "hot", "s", 4)] * 600 + [(None, "copy", "hot", "s", None)] * 300
    check(merkle_manifest.verified(table(rows).repartition(4)).collect(), five([(*r, None, None) for r in rows]))


def test_empty_table(spark, empty):
    assert merkle_manifest.verified(empty).collect() == []


def test_settings_come_back(spark, table):
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    merkle_manifest.verified(table([(1, "x", "a")]))
    assert spark.conf.get(key) == before
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("merkle_")]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    check(queries.op13_merkle_manifest(spark, SF_DIR).collect(), [tuple(r) for r in docs.collect()])
