"""Exact quantiles without gathering the values of a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Steps per unit of the natural logarithm: a bucket spans about 0.1 % of its value.
_STEPS = 1000
# Two places more than money: quarters of the step between neighbours are exact.
QUANTILE = "decimal(22,4)"


def _bucket(value: Column) -> Column:
    """Whole number that never falls as the value rises; a few ten thousand at most."""
    size = F.floor(F.log1p(F.abs(value.cast("double"))) * _STEPS)
    return F.when(value < 0, -size).otherwise(size)


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    tests = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a & b, tests)


def exact_quantiles(
    rows: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: Sequence[str] = (),
    times: str | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles of a money column, one output column per probability.

    The rows are first added up to distinct values per group, on the map side. Counts per
    value bucket, a bounded number a group, show which buckets hold the wanted ranks; only
    the distinct values of those buckets are put in order. Neither a large group nor a
    frequent value ends up in one task, and one way serves tables of every size.

    `times` names a column that says how often a row counts. Interpolation is done in
    decimals and keeps four places.
    """
    by = list(by)
    places = {name: Fraction(p).limit_denominator(1000) for name, p in probabilities.items()}
    values = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("decimal(18,2)").alias("_value"))
        .agg((F.sum(times) if times else F.count(F.lit(1))).alias("_n"))
        .withColumn("_bucket", _bucket(F.col("_value")))
    )
    counts = values.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_n"))
    rising = Window.partitionBy(*by).orderBy("_bucket")
    counts = counts.select(
        *by,
        "_bucket",
        (F.sum("_n").over(rising) - F.col("_n")).alias("_before"),
        F.sum("_n").over(rising).alias("_upto"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_total"),
    )

    def steps(p: Fraction) -> Column:
        """Place of the quantile in units of 1 / denominator."""
        return F.lit(p.numerator) * (F.col("_total") - 1)

    def ranks(p: Fraction) -> tuple[Column, Column]:
        low = F.floor(steps(p) / F.lit(p.denominator))
        return low, F.least(low + 1, F.col("_total") - 1)

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_before")) & (rank < F.col("_upto"))

    wanted = [holds(rank) for p in places.values() for rank in ranks(p)]
    targets = counts.where(reduce(lambda a, b: a | b, wanted)).drop("_upto")

    keys = [*by, "_bucket"]
    inside = (
        values.alias("v")
        .join(targets.alias("t"), _same("v", "t", keys))
        .select(*[F.col(f"t.{c}").alias(c) for c in keys], "_before", "_total", "_value", "_n")
    )
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys).orderBy("_value"))
    placed = inside.select(
        *by, "_total", "_value", upto.alias("_upto"), (upto - F.col("_n")).alias("_before")
    )
    found = placed.groupBy(*by).agg(
        F.max("_total").alias("_total"),
        *[
            F.max(F.when(holds(rank), F.col("_value"))).alias(f"_{side}_{name}")
            for name, p in places.items()
            for side, rank in zip(("low", "high"), ranks(p))
        ],
    )

    def between(name: str, p: Fraction) -> Column:
        parts = F.lit(p.denominator).cast("decimal(4,0)")
        over = F.pmod(steps(p), F.lit(p.denominator)).cast("decimal(4,0)")
        mixed = F.col(f"_low_{name}") * (parts - over) + F.col(f"_high_{name}") * over
        return (mixed / parts).cast(QUANTILE).alias(name)

    return found.select(*by, *[between(name, p) for name, p in places.items()])
