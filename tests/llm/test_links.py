import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from textdata import empty  # noqa: F401

from revtrail.llm.bottomk_dedup import exact_test
from revtrail.llm.links import components, forest, in_blocks, link_lists


def roots_of(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        one, other = root(a), root(b)
        parent[max(one, other)] = min(one, other)
    return {x: root(x) for x in list(parent)}


def key(n):
    return n.to_bytes(4, "big")


def found(spark, pairs, parts=4):
    rows = [(key(max(p)), key(min(p))) for p in pairs]
    edges = spark.createDataFrame(rows, "a binary, b binary").repartition(parts)
    return {int.from_bytes(r["node"], "big"): int.from_bytes(r["root"], "big") for r in components(edges).collect()}


def test_components_of_paths_stars_and_noise(spark):
    draw = random.Random(3)
    path = [(i, i + 1) for i in range(300)]
    mixed = [(i, j) for i, j in zip(range(1000, 1400), draw.sample(range(1000, 1400), 400)) if i != j]
    star = [(2000, 2001 + i) for i in range(200)]
    pairs = path + mixed + star
    draw.shuffle(pairs)
    assert found(spark, pairs) == roots_of(pairs)


def test_no_edges(spark):
    assert found(spark, []) == {}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), max_size=8), max_size=10))
def test_forest_connects_what_is_linked(sets):
    arrays = [np.asarray(sorted(s), dtype=np.uint64) for s in sets]
    edges = forest(arrays, exact_test(75)(arrays), 0.75)
    linked = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    assert len(edges) < max(1, len(sets))
    assert all((max(e), min(e)) in linked for e in edges)
    mine, true = roots_of(edges), roots_of(linked)
    assert mine == true


def test_long_lists_go_out_as_pairs_of_blocks(spark):
    draw = random.Random(9)
    base = list(range(40))
    sets = []
    for i in range(60):
        own = set(base)
        for _ in range(draw.randint(0, 5)):
            own.discard(draw.randrange(40))
            own.add(1000 + draw.randrange(40))
        sets.append(sorted(own))
    rows = [(7, key(i), np.asarray(s, dtype="<u8").tobytes(), len(sets)) for i, s in enumerate(sets)]
    entries = spark.createDataFrame(rows, "value long, member binary, held binary, n long")
    dealt = in_blocks(entries, block=10)
    assert dealt.groupBy("part").count().agg(F.max("count")).first()[0] < 40
    edges = [(int.from_bytes(r["a"], "big"), int.from_bytes(r["b"], "big")) for r in link_lists(dealt, exact_test(75), 0.75).collect()]
    linked = [
        (i, j)
        for i in range(60)
        for j in range(i)
        if 100 * len(set(sets[i]) & set(sets[j])) >= 75 * len(set(sets[i]) | set(sets[j]))
    ]
    assert set(edges) <= set(linked)
    assert roots_of(edges) == roots_of(linked)
