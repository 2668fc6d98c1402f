"""Links inside lists of sets, and the connected components of links.

A list is a key with the sets that share it. A task works on one list, or on two blocks
of a long one, and gives back a spanning forest of the links it finds there: as many
rows as members at most, never all pairs, and enough to keep everything connected that
is linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.llm.frames import settled

# Members of a list that one task compares; longer lists are dealt out as pairs of blocks.
BLOCK = 4096

# Test of one member against others: (shared values, own place, places of the others).
Test = Callable[[np.ndarray, int, np.ndarray], np.ndarray]


def jaccard_test(sizes: np.ndarray, percent: int = 75) -> Test:
    """Exact similarity of at least `percent` hundredths of full sets."""

    def linked(shared: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
        return 100 * shared >= percent * (sizes[one] + sizes[others] - shared)

    return linked


def forest(sets: list[np.ndarray], test: Test, need: float) -> list[tuple[int, int]]:
    """Spanning forest of the links between sets of distinct numbers.

    Linked sets share at least `need` of the numbers of either. So two of them share one of
    the rarest numbers of either, when as many are left out as the two must share less one;
    text that many members have in common costs nothing. A member is compared only with
    members not yet reached, so a group of near copies costs little more than its size.
    """
    count = len(sets)
    sizes = np.asarray([len(s) for s in sets], dtype=np.int64)
    if count < 2 or not sizes.sum():
        return []
    if count == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if shared and test(np.asarray([shared]), 0, np.asarray([1]))[0] else []
    _, ids, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    by_value = np.repeat(np.arange(count), sizes)[np.argsort(ids, kind="stable")]
    value_ends = np.cumsum(df)
    value_starts = value_ends - df
    own = np.split(ids, np.cumsum(sizes)[:-1])
    fresh = np.ones(count, dtype=bool)
    marked = np.zeros(len(df), dtype=bool)
    edges = []
    for first in range(count):
        if not fresh[first]:
            continue
        fresh[first] = False
        stack = [first]
        while stack:
            one = stack.pop()
            mine = own[one]
            rare = mine[np.argsort(df[mine], kind="stable")[: len(mine) - int(np.ceil(need * len(mine))) + 1]]
            rare = rare[df[rare] > 1]
            if not len(rare):
                continue
            met = np.concatenate([by_value[value_starts[v] : value_ends[v]] for v in rare.tolist()])
            others = np.unique(met[fresh[met]])
            if not len(others):
                continue
            marked[mine] = True
            held = np.concatenate([own[other] for other in others.tolist()])
            ends = np.cumsum(sizes[others])
            shared = np.add.reduceat(marked[held].astype(np.int64), ends - sizes[others])
            marked[mine] = False
            found = others[test(shared, one, others)]
            fresh[found] = False
            edges += [(one, other) for other in found.tolist()]
            stack += found.tolist()
    return edges


def distinct_lists(listed: DataFrame, short: int = 16) -> DataFrame:
    """Lists of two members or more, with their size `n`, from distinct rows (value, member).

    A pair of near copies shares most of its values; lists of up to `short` members that
    hold the same members are one list.
    """
    sizes = listed.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = listed.join(sizes, "value")
    few = sized.where(F.col("n") <= short).groupBy("value")
    few = few.agg(F.array_sort(F.collect_list("member")).alias("members")).select("members").distinct()
    few = few.select(
        F.xxhash64("members").alias("value"),
        F.explode("members").alias("member"),
        F.size("members").cast("long").alias("n"),
    )
    return few.unionByName(sized.where(F.col("n") > short).select("value", "member", "n"))


def in_blocks(entries: DataFrame, block: int = BLOCK) -> DataFrame:
    """Add column `part`: short lists stay whole, long ones go out as pairs of blocks."""
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("long")
    own = F.pmod(F.xxhash64("member"), F.col("blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.least(other, F.col("own")) * F.col("blocks") + F.greatest(other, F.col("own")),
    )
    dealt = entries.withColumn("blocks", blocks).withColumn("own", own)
    return dealt.withColumn("part", F.explode(pairs)).drop("blocks", "own", "n")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[bytes, bytes]]:
    """Members of each list with their sets, for rows (value, part, member, held) in order."""
    last, members = None, {}
    for batch in batches:
        for value, part, member, held in zip(*[c.to_pylist() for c in batch.columns]):
            if (value, part) != last:
                if len(members) > 1:
                    yield members
                last, members = (value, part), {}
            members[member] = held
    if len(members) > 1:
        yield members


def link_lists(entries: DataFrame, linked: Callable[[list[np.ndarray]], Test], need: float) -> DataFrame:
    """Edges (a, b) inside lists, for rows (value, part, member, held), `held` being the set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[bytes, bytes]] = []
        for members in _lists(batches):
            names = sorted(members)
            sets = [np.frombuffer(members[n], "<u8") for n in names]
            found += [(max(names[a], names[b]), min(names[a], names[b])) for a, b in forest(sets, linked(sets), need)]
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    dealt = entries.select("value", "part", "member", "held").repartition("value", "part")
    found = dealt.sortWithinPartitions("value", "part").mapInArrow(work, "a binary, b binary")
    return found.distinct()


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], names=["a", "b"]
    )


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one task as stars around the smallest member of each component."""
    parent: dict[bytes, bytes] = {}

    def root(node: bytes) -> bytes:
        top = node
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one, other = root(a), root(b)
            if one != other:
                parent[max(one, other)] = min(one, other)
    stars = [(node, root(node)) for node in list(parent)]
    stars = [(node, top) for node, top in stars if node != top]
    for start in range(0, len(stars), 50_000):
        yield _edges(stars[start : start + 50_000])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) with a > b; the root is the smallest node.

    Small-star and large-star steps in turn. A task unites all edges dealt to it, which
    is at least the small star of each of its nodes. Each round is written to the shared
    folder; the number of rounds grows with the logarithm of the nodes.
    """
    edges = edges.select("a", "b")
    while True:
        stars = settled(edges.repartition("a").mapInArrow(_united, "a binary, b binary"))
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        least = least.select(F.col("a").alias("b"), F.least("a", "low").alias("low"))
        moved = settled(stars.join(least, "b").select("a", "b", "low"))
        loose = moved.groupBy("a").agg(
            (F.count(F.lit(1)) > 1).alias("many"), F.max(F.col("low") != F.col("b")).alias("moves")
        )
        if not loose.where("many or moves").take(1):
            break
        edges = moved.select("a", F.col("low").alias("b")).where("a != b").distinct()
    roots = moved.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return moved.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
