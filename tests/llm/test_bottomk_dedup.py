import random
from collections import Counter, defaultdict

import duckdb
from textdata import SF_DIR, empty, odd, odd_rows, prose, table  # noqa: F401

from revtrail.llm import bottomk_dedup, queries, sql


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    """Component ids of rows (doc_id, text), by position."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, one in enumerate(sets):
        for j in range(i):
            if one and sets[j] and 100 * len(one & sets[j]) >= 75 * len(one | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = defaultdict(lambda: None)
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            least[g] = doc_id if least[g] is None else min(least[g], doc_id)
    return [(i, len(s), least[g] if s else i) for (i, _), s, g in zip(rows, sets, group)]


def compare(docs, rows, **how):
    found = bottomk_dedup.near_duplicates(docs, **how).collect()
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)
    assert got == Counter(brute(rows))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_odd_rows(odd, odd_rows):
    compare(odd, [r[:2] for r in odd_rows])


def test_empty_table(empty):
    assert bottomk_dedup.near_duplicates(empty).collect() == []
    assert bottomk_dedup.one_of_each(empty).collect() == []


def test_chains_and_large_groups_of_near_copies(table):
    draw = random.Random(2)
    rows = []
    for base in range(3):
        words = prose(base, 60).split()
        for copy in range(40):
            own = list(words)
            for _ in range(draw.randint(0, 4)):
                own[draw.randrange(60)] = f"x{draw.randrange(9)}"
            rows.append((len(rows), " ".join(own)))
            if copy % 10 == 0:
                words = own
    common = prose(99, 12)
    rows += [(1000 + i, common + " " + prose(200 + i, 40)) for i in range(60)]
    compare(table(rows), rows)
    compare(table(rows), rows, block=7)


def test_rows_without_or_with_equal_ids_are_read_once(table):
    words = prose(7, 60).split()
    rows = []
    for doc_id in (None, 5):
        for n in range(40):
            own = list(words)
            own[n] = f"y{n}"
            rows += [(doc_id, " ".join(own))] * (3 if doc_id is None and n < 5 else 1)
    docs = table(rows)
    compare(docs, rows)
    signed = bottomk_dedup.signatures(docs).selectExpr("digest", "doc_id first_id", "mark first_mark", "digest canopy").distinct()
    assert signed.count() == bottomk_dedup.full_sets(docs, signed, bottomk_dedup.WIDTH).count() == 80


def test_whole_table_matches_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    expected = sorted(duck.sql(sql.NEAR_DUPLICATES).fetchall())
    found = queries.op7_bottomk_dedup(spark, SF_DIR)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, found.collect())) == expected


def test_one_of_each_keeps_a_row_of_every_component(odd, odd_rows):
    kept = bottomk_dedup.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = [r[:2] for r in odd_rows]
    components = [c for (_, size, c), (_, t) in zip(brute(rows), rows) if size]
    found = kept.collect()
    assert sum(bool(shingles(r["text"])) for r in found) == len(
        {(c, frozenset(shingles(t))) if c in (12, None) else c for c, t in zip(components, [t for _, t in rows if shingles(t)])}
    )
    assert sum(not shingles(r["text"]) for r in found) == sum(not shingles(t) for _, t in rows)
    assert sorted(r["doc_id"] for r in found if r["text"] and r["text"].startswith(rows[0][1][:30])) == [1]


def test_a_pair_without_a_common_value_among_the_lowest_ten(table):
    words = [f"w{i}" for i in range(600)]
    hashes = bottomk_dedup.windows(bottomk_dedup.Words([" ".join(words).encode()]).hashes(), bottomk_dedup.WIDTH)
    other = list(words)
    for at in hashes.argsort()[:10]:
        other[at] = f"x{at}"
    one, two = (bottomk_dedup.shingle_sets([" ".join(w).encode()])[0] for w in (words, other))
    assert not set(one[:10]) & set(two[:10])
    rows = [(1, " ".join(words)), (2, " ".join(other))]
    assert brute(rows)[1][2] == 1
    compare(table(rows), rows)


def test_chance_of_a_miss_at_the_limit():
    from math import ceil, comb

    k, need = bottomk_dedup.K, ceil(bottomk_dedup.LOOSE * bottomk_dedup.K)
    below = sum(comb(k, i) * 0.75**i * 0.25 ** (k - i) for i in range(need))
    assert below + 0.25**bottomk_dedup.HEADS < 1e-8
