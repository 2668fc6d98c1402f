import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from textdata import SF_DIR, empty, odd, odd_rows, prose, table  # noqa: F401

from revtrail.llm import paragraph_dedup, queries
from revtrail.llm.frames import Chunk
from revtrail.llm.paragraph_dedup import Settings, bands_for, paragraphs, repeated_paragraphs

HOW = Settings()


def units(rows, how=HOW):
    """Paragraphs of each row as (place, text words, begin, end, shingles)."""
    import numpy as np

    found = []
    for n, (_, text) in enumerate(rows):
        data = (text or "").encode()
        own = paragraphs(Chunk(0, np.zeros(1, "<i8"), np.ones(1, bool), np.asarray([len(data)]), data), how)
        for i in range(len(own.start)):
            words = data[own.begin[i] : own.end[i]].lower().split()
            assert len(words) == own.size[i]
            sets = {tuple(words[j : j + 5]) for j in range(len(words) - 4)} or {tuple(words)}
            found.append((n, i, len(words), f"{own.begin[i]}:{own.end[i]}", sets))
    return found


def brute(rows, how=HOW):
    """Removed spans per row, by all pairs."""
    every = units(rows, how)
    able = [u for u in every if u[2] >= how.least]
    group = list(range(len(able)))
    lists = defaultdict(list)
    for k, u in enumerate(able):
        for s in u[4]:
            lists[s].append(k)
    pairs = {(a, b) for members in lists.values() for i, a in enumerate(members) for b in members[:i]}
    for a, b in pairs:
        one, other = able[a][4], able[b][4]
        if 100 * len(one & other) >= 75 * len(one | other):
            x, y = group[a], group[b]
            group = [min(x, y) if g in (x, y) else g for g in group]
    order = sorted(range(len(able)), key=lambda k: (rows[able[k][0]][0] is None, rows[able[k][0]][0] or 0, able[k][0], able[k][1]))
    seen, gone = set(), defaultdict(dict)
    for k in order:
        if group[k] in seen:
            gone[able[k][0]][able[k][1]] = able[k]
        seen.add(group[k])
    out = {}
    for n in range(len(rows)):
        kept, run = [], []
        for i in sorted(gone[n]) + [None]:
            if run and (i is None or i != run[-1] + 1):
                if sum(gone[n][j][2] for j in run) >= how.run:
                    kept += run
                run = []
            run.append(i)
        out[n] = [gone[n][i][3] for i in kept]
    return out


def test_matches_brute_force(table):
    draw = random.Random(21)
    passages = [prose(500 + i, 60) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(i * 10 + j, draw.randint(5, 60)) for j in range(3)]
        for _ in range(draw.randint(0, 2)):
            words = draw.choice(passages).split()
            if draw.random() < 0.4:
                words[draw.randrange(60)] = "changed"
            parts.insert(draw.randint(0, 3), " ".join(words))
        rows.append((i, draw.choice([" ", "\n"]).join(parts)))
    found = repeated_paragraphs(table(rows).repartition(4)).collect()
    expected = brute(rows)
    assert {r["doc_id"]: r["removed"] for r in found} == expected
    assert sum(map(len, expected.values())) > 40
    assert all(len(r["components"]) == r["n_removed"] == len(r["removed"]) for r in found)
    small = repeated_paragraphs(table(rows).repartition(3), block=5).collect()
    assert {r["doc_id"]: r["removed"] for r in small} == expected


def test_long_passages_are_caught_wherever_they_stand(table):
    misses = 0
    for seed in range(12):
        passage = prose(900 + seed, 51)
        rows = [(seed * 10 + i, f"{prose(seed * 50 + i, 20 + i)} {passage} {prose(seed * 70 + i + 5, 17)}") for i in range(3)]
        expected = brute(rows)
        assert not expected[0]
        misses += not (expected[1] and expected[2])
    assert misses <= 1
    rows = [(1, prose(1, 40)), (2, prose(2, 40)), (3, prose(3, 9)), (4, prose(3, 9))]
    assert [r["n_removed"] for r in repeated_paragraphs(table(rows)).collect()] == [0, 0, 0, 0]


def test_whole_table_keeps_every_first_passage(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in queries.op9_paragraph_dedup(spark, SF_DIR).collect()}
    assert set(found) == set(docs)
    seen, later = {}, set()
    for doc_id in sorted(docs):
        words = docs[doc_id].lower().split()
        for i in range(len(words) - 50):
            if seen.setdefault(tuple(words[i : i + 51]), doc_id) != doc_id:
                later.add(doc_id)
    assert later and all(found[i]["n_removed"] for i in later)


def test_odd_rows(odd, odd_rows):
    found = repeated_paragraphs(odd).collect()
    assert len(found) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] in (1, 2, 4, 5, 6, 11)}
    assert by_id[1]["n_removed"] == 0 and by_id[2]["n_removed"] > 0 and set(by_id[2]["components"]) == {1}
    assert [by_id[i]["n_paragraphs"] for i in (4, 5, 6)] == [0, 0, 0]
    assert by_id[11]["n_removed"] > 0 and set(by_id[11]["components"]) == {11}


def test_empty_table(empty):
    assert repeated_paragraphs(empty).collect() == []


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.999):
        bands = bands_for(recall, 0.75, 2)
        assert 1 - (1 - 0.75**2) ** bands >= recall > 1 - (1 - 0.75**2) ** (bands - 1)
    assert HOW.bands == bands_for(HOW.recall, 0.75, HOW.rows)


def gone_words(row, text):
    return [w for a, b in (map(int, s.split(":")) for s in row["removed"]) for w in text.encode()[a:b].decode().split()]


def test_no_long_passage_is_missed_in_one_line_or_in_short_ones(table):
    rows = []
    for seed in range(300):
        words = prose(9000 + seed, 51).split()
        lines = ["\n".join(" ".join(words[i : i + n]) for i in range(0, 51, n)) for n in (51, 4, 9)]
        rows += [(seed * 10 + i, f"{prose(20_000 + seed * 3 + i, 20 + i)} {lines[i]} {prose(30_000 + seed * 3 + i, 17)}") for i in range(3)]
    found = {r["doc_id"]: r for r in repeated_paragraphs(table(rows)).collect()}
    left = 0
    for doc_id, text in rows:
        gone = gone_words(found[doc_id], text)
        assert bool(gone) == (doc_id % 10 > 0)
        left += 51 - len(gone) if doc_id % 10 else 0
    assert left < 0.25 * 51 * 600


def test_blocks_of_short_lines_are_paragraphs(table):
    words = prose(77, 60).split()
    near = words[:30] + ["other"] + words[31:]
    verse = ["\n".join(" ".join(w[i : i + n]) for i in range(0, 60, n)) for w, n in ((words, 5), (near, 3))]
    rows = [(i, f"{prose(i, 30)}\n \n{v}\n\n{prose(i + 10, 30)}") for i, v in enumerate(verse, 1)]
    found = {r["doc_id"]: r for r in repeated_paragraphs(table(rows)).collect()}
    assert [found[i]["n_paragraphs"] for i in (1, 2)] == [3, 3] and found[1]["n_removed"] == 0
    assert gone_words(found[2], rows[1][1]) == near and found[2]["components"] == [1]


def chunk_of(texts):
    data = [t.encode() for t in texts]
    return Chunk(0, np.arange(len(data)), np.ones(len(data), bool), np.asarray([len(d) for d in data]), b"".join(data))


def test_shingles_of_a_chunk_are_made_once(monkeypatch):
    made = []
    windows = paragraph_dedup.windows
    monkeypatch.setattr(paragraph_dedup, "windows", lambda hashes, width: made.append(len(hashes)) or windows(hashes, width))
    texts = [f"{prose(i, 200)}\n\n{prose(i + 50, 30)}" for i in range(20)]
    paragraph_dedup.units(chunk_of(texts), HOW)
    assert sum(made) <= 2 * sum(len(t.split()) for t in texts)


def test_report_matches_plain_loops():
    for seed in range(20):
        draw = random.Random(seed)
        texts = [draw.choice(["", " \n ", "\n\n".join(prose(seed * 100 + i * 9 + j, draw.randint(1, 40)) for j in range(3))]) for i in range(8)]
        chunk = chunk_of(texts)
        text = paragraph_dedup.Text.of(chunk)
        one, other = paragraph_dedup.pieces(text, HOW), paragraph_dedup.blocks(text)
        removed = {i: draw.choice([None, i]) for i in range(len(one.start)) if draw.random() < 0.8}
        removed |= {paragraph_dedup.BLOCKS + i: 900 + i for i in range(len(other.start)) if draw.random() < 0.3}
        owner, row = {}, []
        for i in [*range(len(one.start)), None]:
            joins = i in removed and (not row or one.document[i] == one.document[row[-1]])
            if not joins:
                if sum(int(one.size[j]) for j in row) >= HOW.run:
                    owner |= {w: j for j in row for w in range(one.start[j], one.start[j] + one.size[j])}
                row = []
            row += [i] if i in removed else []
        for i in range(len(other.start)):
            if paragraph_dedup.BLOCKS + i in removed:
                owner |= {w: paragraph_dedup.BLOCKS + i for w in range(other.start[i], other.start[i] + other.size[i])}
        expected = [[] for _ in texts]
        for w in sorted(owner):
            shift = int(chunk.starts[text.document[w]]) + int(text.document[w])
            spans = expected[text.document[w]]
            if w and owner.get(w - 1) == owner[w]:
                spans[-1][1:3] = [int(text.end[w]) - shift, spans[-1][2] + 1]
            else:
                spans.append([int(text.begin[w]) - shift, int(text.end[w]) - shift, 1, removed[owner[w]]])
        chosen = []
        for kind, first in ((one, 0), (other, paragraph_dedup.BLOCKS)):
            which = np.asarray([i for i in range(len(kind.start)) if first + i in removed or draw.random() < 0.5], np.int64)
            chosen.append(paragraph_dedup.places(chunk, kind, which, first))
        stand = [np.concatenate(column) for column in zip(*chosen)]
        back = paragraph_dedup.restored(paragraph_dedup.squeezed(stand))
        assert back.tolist() == [c.tolist() for c in stand]
        gone = [{"number": n, "first": first} for n, first in removed.items()]
        draw.shuffle(gone)
        gone = pa.array(gone, pa.struct([("number", pa.int32()), ("first", pa.int64())]))
        held = paragraph_dedup.counted(chunk).to_pylist()[0]
        counts = np.frombuffer(held["counts"], "<i8")
        found = paragraph_dedup.report(chunk.id_list(), counts, gone, back, HOW).to_pylist()
        assert [r["n_paragraphs"] for r in found] == [int((other.document == i).sum()) for i in range(len(texts))]
        assert [r["removed"] for r in found] == [[f"{a}:{b}" for a, b, _, _ in spans] for spans in expected]
        assert [r["components"] for r in found] == [[c for _, _, _, c in spans] for spans in expected]
        assert [r["removed_words"] for r in found] == [sum(n for _, _, n, _ in spans) for spans in expected]
        assert [r["n_removed"] for r in found] == [len(spans) for spans in expected]
