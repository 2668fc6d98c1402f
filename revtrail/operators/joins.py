"""Joins that hold up when one key carries a large part of the rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrail.params import Params


# Keys that a sketch reports at most, and those it keeps count of; both bound its size.
# A key below one in `TRACKED` rows is no larger than an ordinary task's share.
REPORTED, TRACKED = 1024, 16_384

# Prints of keys with more than `hot_rows` rows, and the number of parts to deal them to.
Heavy = Mapping[int, int]


def key_print(on: list[str]) -> Column:
    """One number per key of any type; a missing key has one too."""
    return F.xxhash64(*on)


def heavy_keys(rows: DataFrame, keys: Iterable[str], params: Params) -> dict[str, Heavy]:
    """The heavy values of each key column, in one job that reads the key columns alone.

    The counts come from heavy-hitter sketches of fixed size that every task fills with its
    own rows, so no key is shuffled, and the driver gets `REPORTED` numbers a column at
    most. They are estimates; they decide how rows are dealt, never what joins.
    """
    keys = list(keys)
    prints = rows.select(*[key_print([k]).alias(k) for k in keys])
    tops = prints.agg(*[F.expr(f"approx_top_k(`{k}`, {REPORTED}, {TRACKED})").alias(k) for k in keys]).first()
    return {
        k: {x["item"]: -(-x["count"] // params.hot_rows) for x in tops[k] or () if x["count"] > params.hot_rows}
        for k in keys
    }


def many_to_one(many: DataFrame, one: DataFrame, on: str, heavy: Heavy | None = None) -> DataFrame:
    """Left join of a fact to a table with at most one row per key.

    Where nothing is known of heavy keys, adaptive execution splits those it meets. Rows of
    known heavy keys are dealt to several parts by a hash of the whole row, and the one row
    of the other side is repeated for each part, which needs no statistics of the shuffle.
    """
    if not heavy:
        return many.join(one, on, "left")
    listed = many.sparkSession.createDataFrame(list(heavy.items()), "_print long, _parts int")
    parts = F.coalesce("_parts", F.lit(1))

    def counted(rows: DataFrame) -> DataFrame:
        # `REPORTED` rows at most.
        return rows.withColumn("_print", key_print([on])).join(F.broadcast(listed), "_print", "left")

    dealt = F.pmod(F.xxhash64(*many.columns), parts).cast("int")
    salted = counted(many).select(*many.columns, F.when(parts > 1, dealt).otherwise(0).alias("_part"))
    repeated = counted(one).select(*one.columns, F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    return salted.join(repeated, [on, "_part"], "left").drop("_part")


def label_lookup(rows: DataFrame, table: DataFrame, on: str, params: Params) -> DataFrame:
    """Left join to an aggregate per label, which is broadcast behind a check of its size.

    Labels are few by nature. Should they not be, the job stops and names the setting;
    `many_to_one` joins tables of any size.
    """
    count = F.count(F.lit(1)).over(Window.partitionBy())
    message = f"{on}: more labels than broadcast_rows={params.broadcast_rows}"
    fits = F.when(F.col("_labels") > params.broadcast_rows, F.raise_error(F.lit(message)).cast("boolean"))
    # One row per label in the window.
    checked = table.withColumn("_labels", count).where(F.coalesce(fits, F.lit(True))).drop("_labels")
    return rows.join(F.broadcast(checked), on, "left")
