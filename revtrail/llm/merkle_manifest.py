"""Merkle manifest of a document table, and proofs by a recursive query.

Every row is a leaf: the SHA-256 of its five fields. Per language the leaves ascend by
doc_id, and runs of two become their digest until one node remains, the subroot; subroots,
by language, become the root in the same way. The built levels are stored as node rows
that carry their sibling and point to their parent. A Spark recursive query then takes
each leaf up the parent links, appends the siblings it meets and folds the digest it was given,
so a changed row is seen without reading any other row again.

Leaves are cut into blocks of neighbours, and a node is stored once for every block below
it. Nodes lie in buckets of blocks, so they are never moved, and a node near the root is
met in as many tasks as there are blocks, not in one. Spark hands the rows of a round to
the next through a shuffle, so a round climbs several levels.

Rows with equal doc_ids are leaves each, in the order of their digests. A null doc_id
comes first and is never changed by `tampered`. Null and empty fields differ. An empty
table has no rows and no root. Columns beyond the five are ignored. A text of any length
is one value of Spark; it is hashed where it is read and moves nowhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revtrail.llm.frames import partitions, settled, shared_folder

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels that one grouping builds; a block has two to the power of this many leaves.
BITS = 8
# Nodes of the tree over the languages begin at this level, and the bits of a place in a level.
TOP, PLACE = 64, 48


def digest(parts: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(parts, 256))


def as_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_text(**changed: Column) -> Column:
    """What a leaf hashes: every field with its size in bytes, `-` for null."""

    def field(name: str) -> Column:
        text = changed.get(name, F.col(name)).cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(sized, F.lit("-"))

    return F.concat(*[field(name) for name in FIELDS])


def tampered(modulus: int = 7) -> Column:
    """Documents that the check of the manifest changes."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == 0, F.lit(False))


def leaves(docs: DataFrame, modulus: int = 7) -> DataFrame:
    """A row per document with its digest and the one it has after tampering."""
    more = F.when(tampered(modulus), digest(leaf_text(n_chars=F.col("n_chars") + 1)))
    own = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), digest(leaf_text()).alias("leaf"), more.alias("given")
    )
    return own.withColumn("given", F.coalesce("given", "leaf"))


def numbered(
    rows: DataFrame, by: Sequence[str], order: Sequence[str], add: str | None = None, more: DataFrame | None = None
) -> DataFrame:
    """Rows with their place `pos` (from 0) in their group, the group's size `n`, and the sum
    `before` of the column `add` over the rows before them. `more` has further columns per group.

    The order must tell all rows apart. Rows are dealt by its ranges, and only counts per
    group and range are added up and joined, so a large group is never in one task.
    """
    spread = rows.repartitionByRange(partitions(rows), *by, *order)
    # Written down: another run of the same plan may draw other ranges.
    spread = settled(spread.withColumn("_part", F.spark_partition_id()))
    weight = F.col(add) if add else F.lit(0)
    local = Window.partitionBy("_part", *by).orderBy(*order)
    own = spread.select(
        "*", (F.row_number().over(local) - 1).alias("_at"), (F.sum(weight).over(local) - weight).alias("_sum")
    )
    ranges = spread.groupBy("_part", *by).agg(F.count(F.lit(1)).alias("_n"), F.sum(weight).alias("_w"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A group has as many rows here as there are ranges, at most.
    ranges = ranges.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_{c}") for c in by],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"),
        F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_less"),
        F.sum("_n").over(group).alias("n"),
    )
    others = [c for c in more.columns if c not in by] if more else []
    if more:
        ranges = ranges.join(more, reduce(lambda a, b: a & b, [F.col(f"_{c}").eqNullSafe(more[c]) for c in by])).drop(*by)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], F.col("_part") == F.col("_p"))
    return own.join(ranges, same).select(
        *rows.columns,
        (F.col("_first") + F.col("_at")).alias("pos"),
        "n",
        *([(F.col("_less") + F.col("_sum")).alias("before")] if add else []),
        *others,
    )


def _halved(count: Column, times: int) -> Column:
    """Nodes that are left of `count` after so many levels."""
    return F.shiftright(count + F.lit((1 << times) - 1), times)


def _id(level: int, place: Column) -> Column:
    return F.lit(level << PLACE) + place


def _parents(nodes: Column) -> Column:
    """The level above a run of neighbours that begins at an even place."""

    def parent(i: Column) -> Column:
        left, right = F.get(nodes, i * 2), F.get(nodes, i * 2 + 1)
        parts = F.concat(as_text(left["digest"]), F.coalesce(as_text(right["digest"]), F.lit("")))
        return F.struct(
            F.shiftright(left["pos"], 1).alias("pos"),
            digest(parts).alias("digest"),
            left["lo"].alias("lo"),
            F.coalesce(right["hi"], left["hi"]).alias("hi"),
        )

    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(nodes) + 1, 1) - 1), parent)


NODE = "id:bigint,parent:bigint,digest:binary,sibling:binary,is_left:boolean,lo:bigint,hi:bigint"


def _linked(nodes: Column, level: int, count: Column, top: bool) -> Column:
    """Node rows of one level; none where the tree has ended. The parent of the last run of a
    language's tree is a leaf of the tree above."""
    own = F.lit(False) if top else _halved(count, 1) == 1

    def row(x: Column, i: Column) -> Column:
        is_left = x["pos"] % 2 == 0
        return F.struct(
            _id(level, x["pos"]).alias("id"),
            F.when(own, _id(TOP, F.col("tree"))).otherwise(_id(level + 1, F.shiftright(x["pos"], 1))).alias("parent"),
            x["digest"].alias("digest"),
            F.get(nodes, F.when(is_left, i + 1).otherwise(i - 1))["digest"].alias("sibling"),
            is_left.alias("is_left"),
            x["lo"].alias("lo"),
            x["hi"].alias("hi"),
        )

    return F.when(count > 1, F.transform(nodes, row)).otherwise(F.array().cast(f"array<struct<{NODE}>>"))


def _raised(entries: DataFrame, level: int, top: bool) -> DataFrame:
    """Per run of neighbours the node rows of the levels `level` to `level + BITS - 1`, and the
    one node above them. Entries: tree, n (nodes of the tree at `level`), pos, digest, and the
    blocks `lo` to `hi` below."""
    run = F.array_sort(F.collect_list(F.struct("pos", "digest", "lo", "hi")))
    rows = entries.groupBy("tree", "n", F.shiftright("pos", BITS).alias("_run")).agg(run.alias("_0"))
    linked = []
    for k in range(BITS):
        nodes, count = F.col(f"_{k}"), _halved(F.col("n"), k)
        linked.append(_linked(nodes, level + k, count, top))
        rows = rows.withColumn(f"_{k + 1}", F.when(count > 1, _parents(nodes)).otherwise(nodes))
    # Before the select below gives `n` another meaning, which lambdas would see.
    rows = rows.withColumn("nodes", F.concat(*linked))
    return settled(rows.select("tree", _halved(F.col("n"), BITS).alias("n"), "nodes", F.col(f"_{BITS}").alias("last")))


def levels(entries: DataFrame, most: int, top: bool = False) -> tuple[DataFrame, DataFrame]:
    """Node rows of trees with at most `most` leaves, and the last node of each tree."""
    nodes, roots, level = [], [], TOP if top else 0
    while True:
        roots.append(entries.where("n = 1"))
        if most <= 1:
            break
        built = _raised(entries.where("n > 1"), level, top)
        nodes.append(built.select(F.inline("nodes")))
        entries = built.select("tree", "n", F.inline("last"))
        level, most = level + BITS, -(-most >> BITS)
    if not nodes:
        nodes.append(entries.sparkSession.createDataFrame([], NODE.replace(":", " ").replace(",", ", ")))
    return reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, roots)


@dataclass(frozen=True)
class Manifest:
    """Tables in buckets of `block`: leaves (row, doc_id, leaf, given, and the node `at` which
    they begin), and node rows, once for every block below them."""

    leaves: str
    nodes: str


def _bucketed(rows: DataFrame, name: str) -> str:
    spark = rows.sparkSession
    table = f"merkle_{name}_{uuid.uuid4().hex}"
    size = partitions(rows)
    writer = rows.repartition(size, "block").write.bucketBy(size, "block").sortBy("block")
    writer.option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table)
    return table


def build(docs: DataFrame, modulus: int = 7) -> Manifest | None:
    """Store the levels over all documents; nothing for an empty table."""
    own = settled(leaves(docs, modulus)).withColumn("row", F.monotonically_increasing_id())
    sizes = own.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.withColumn("blocks", F.shiftright(F.col("size") + ((1 << BITS) - 1), BITS))
    trees = settled(
        numbered(sizes, [], ["lang"], "blocks").select("lang", "size", F.col("pos").alias("tree"), "n", "before")
    )
    ends = trees.agg(F.max("size").alias("most"), F.max("n").alias("trees")).first()
    if ends["trees"] is None:
        return None
    first = F.col("before") + F.shiftright("pos", BITS)
    start = F.when(F.col("n") == 1, _id(TOP, F.col("tree"))).otherwise(F.col("pos"))
    placed = settled(
        numbered(own, ["lang"], ["doc_id", "leaf", "row"], more=trees.drop("n", "size")).select(
            "row", "doc_id", "leaf", "given", "tree", "n", "pos", first.alias("block"), start.alias("at")
        )
    )
    entries = placed.select("tree", "n", "pos", F.col("leaf").alias("digest"), F.col("block").alias("lo"), F.col("block").alias("hi"))
    low, subroots = levels(entries, ends["most"])
    upper = subroots.select(
        F.lit(-1).cast("long").alias("tree"), F.lit(ends["trees"]).cast("long").alias("n"), F.col("tree").alias("pos"), "digest", "lo", "hi"
    )
    high, root = levels(upper, ends["trees"], top=True)
    last = root.select(
        F.lit(TOP + (ends["trees"] - 1).bit_length() << PLACE).alias("id"),
        F.lit(None).cast("long").alias("parent"),
        "digest",
        F.lit(None).cast("binary").alias("sibling"),
        F.lit(True).alias("is_left"),
        "lo",
        "hi",
    )
    nodes = low.unionByName(high).unionByName(last)
    spread = nodes.select("*", F.explode(F.sequence("lo", "hi")).alias("block")).drop("lo", "hi")
    return Manifest(
        _bucketed(placed.select("block", "row", "doc_id", "leaf", "given", "at"), "leaves"), _bucketed(spread, "nodes")
    )


def _step(below: str, k: int, nodes: str) -> str:
    """One level up: the node `a`, its sibling, the folded digest, and the digests of roots met."""
    is_subroot = f"n.id BETWEEN {TOP << PLACE} AND {(TOP + 1 << PLACE) - 1}"
    pair = f"IF(n.is_left, concat(hex(f{k - 1}), hex(n.sibling)), concat(hex(n.sibling), hex(f{k - 1})))"
    return f"""
    SELECT q.*, n.parent AS a{k}, n.sibling AS s{k},
      CASE WHEN n.parent IS NULL THEN f{k - 1}
        WHEN n.sibling IS NULL THEN unhex(sha2(lower(hex(f{k - 1})), 256))
        ELSE unhex(sha2(lower({pair}), 256)) END AS f{k},
      CASE WHEN {is_subroot} THEN n.digest END AS u{k},
      CASE WHEN n.id IS NOT NULL AND n.parent IS NULL THEN n.digest END AS r{k}
    FROM ({below}) q {'LEFT' if k > 1 else 'INNER'} JOIN {nodes} n ON n.block = q.block AND n.id = q.a{k - 1}"""


def climb(leaves: str, nodes: str, height: int = BITS) -> str:
    """The recursive query. A round follows the parent links up by as many levels as a block is
    high, so a leaf goes through few rounds, each of which hands on one row a leaf."""
    up = "SELECT block, row, doc_id, step, at AS a0, folded AS f0 FROM climb"
    for k in range(1, height + 1):
        up = _step(up, k, nodes)
    met = {x: ", ".join(f"{x}{k}" for k in range(1, height + 1)) for x in "sur"}
    return f"""
    WITH RECURSIVE climb (block, row, doc_id, at, step, folded, siblings, leaf, subroot, root) AS (
      SELECT block, row, doc_id, at, 0, given, CAST(array() AS ARRAY<BINARY>), leaf, CAST(NULL AS BINARY), CAST(NULL AS BINARY)
      FROM {leaves}
      UNION ALL
      SELECT block, row, doc_id, a{height}, step + 1, f{height}, array_compact(array({met['s']})), CAST(NULL AS BINARY),
        coalesce({met['u']}), coalesce({met['r']})
      FROM ({up}))
    SELECT * FROM climb"""


@contextmanager
def _settings(spark: SparkSession, **wanted: str) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


PROOFS = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def proofs(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """Climb from every leaf with the digest it was given, and compare the end with the root."""
    # As many rows as there are leaves, times the height; both sides lie by block alone.
    limits = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    with _settings(spark, **limits):
        climbed = spark.sql(climb(manifest.leaves, manifest.nodes))
        ended = F.col("at").isNull()
        per_leaf = climbed.groupBy("row").agg(
            *[F.max(c).alias(c) for c in ("doc_id", "leaf", "subroot", "root")],
            F.max(F.when(ended, F.col("folded"))).alias("folded_root"),
            F.array_sort(F.collect_list(F.when(F.size("siblings") > 0, F.struct("step", "siblings")))).alias("met"),
        )
        siblings = F.array_join(F.transform(F.flatten("met.siblings"), as_text), "")
        found = per_leaf.select(
            "doc_id",
            *[as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
            F.sha2(siblings, 256).alias("proof_sha256"),
            as_text(F.col("folded_root")).alias("folded_root"),
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
        return settled(found)


def verified(docs: DataFrame, modulus: int = 7) -> DataFrame:
    """One row per document: its leaf, subroot and root, its proof, and where the climb of the
    tampered row ends."""
    spark = docs.sparkSession
    manifest = build(docs, modulus)
    if manifest is None:
        return spark.createDataFrame([], PROOFS)
    found = proofs(spark, manifest)
    for table in (manifest.leaves, manifest.nodes):
        spark.sql(f"DROP TABLE {table}")
    return found
