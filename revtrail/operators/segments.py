"""Customer archetypes by k-means on deal value, acquisition cost and days in stage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.numbers import MONEY, mean_of, round_double
from revtrail.operators.lineage import checkpointed
from revtrail.params import HIGH_VALUE, LONG_TAIL, MID_MARKET, Params

FEATURE_COLUMNS = ("arr_value", "cac", "days_in_stage")
# Value lost per day in stage when looking for the archetype that closes fast.
DAY_PENALTY = 1000


def standardized_features(deals: DataFrame) -> DataFrame:
    """Distance of each feature from its mean in population standard deviations."""
    stats = [
        f(F.col(c).cast("double")).alias(f"{kind}_{c}")
        for c in FEATURE_COLUMNS
        for kind, f in (("mean", F.avg), ("sd", F.stddev_pop))
    ]
    whole = deals.agg(*stats)
    rows = deals.withColumn("_stats", whole.select(F.struct(*whole.columns)).scalar())

    def z(c: str) -> Column:
        spread = F.nullif(F.col(f"_stats.sd_{c}"), F.lit(0.0))
        return (F.col(c).cast("double") - F.col(f"_stats.mean_{c}")) / spread

    return rows.select("deal_id", *[round_double(z(c), 6).alias(f"z_{c}") for c in FEATURE_COLUMNS])


# Scaled features are whole millionths of a standard deviation, so that every sum of
# them is exact and no result depends on how the rows are laid out.
_UNITS = 1_000_000


def scaled(deals: DataFrame) -> DataFrame:
    """Deals with whole-number scaled features `_x0`, `_x1`, ...; the rows are written down
    once for the passes over them. Deals without a value in a feature have none."""
    whole = deals.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(c).cast(MONEY)).alias(f"s_{c}") for c in FEATURE_COLUMNS],
        *[F.sum(F.col(c).cast("decimal(18,2)") * F.col(c).cast("decimal(18,2)")).alias(f"q_{c}") for c in FEATURE_COLUMNS],
        *[F.count(c).alias(f"n_{c}") for c in FEATURE_COLUMNS],
    )
    rows = deals.withColumn("_stats", whole.select(F.struct(*whole.columns)).scalar())

    def units(c: str) -> Column:
        n, total, squares = (F.col(f"_stats.{k}_{c}").cast("double") for k in ("n", "s", "q"))
        spread = F.sqrt(F.greatest(squares / n - (total / n) * (total / n), F.lit(0.0)))
        z = (F.col(c).cast("double") - total / n) / F.nullif(spread, F.lit(0.0))
        return F.when(F.col(c).isNotNull(), F.round(F.coalesce(z, F.lit(0.0)) * _UNITS).cast("long"))

    return checkpointed(
        rows.select(*deals.columns, *[units(c).alias(f"_x{i}") for i, c in enumerate(FEATURE_COLUMNS)])
    )


Centre = tuple[float, ...]


def _distance(centre: Centre) -> Column:
    parts = [(F.col(f"_x{i}") - F.lit(v)) * (F.col(f"_x{i}") - F.lit(v)) for i, v in enumerate(centre)]
    return reduce(lambda a, b: a + b, parts)


def nearest(centres: Sequence[Centre]) -> Column:
    """Number of the nearest centre, the first of equally near ones."""
    found = F.array(*[_distance(c) for c in centres])
    return (F.array_position(found, F.array_min(found)) - 1).cast("int")


def starting_centres(rows: DataFrame, params: Params) -> dict[int, list[Centre]]:
    """Distinct feature values in the order of a hash of the key, dealt to the starts in turn:
    the same for any layout."""
    features = [f"_x{i}" for i in range(len(FEATURE_COLUMNS))]
    order = F.min(F.xxhash64(F.col("deal_id"), F.lit(params.kmeans_seed))).alias("_draw")
    wanted = params.clusters * params.kmeans_starts
    chosen = rows.groupBy(*features).agg(order).orderBy("_draw", *features).limit(wanted).collect()
    points = [tuple(float(r[f]) for f in features) for r in chosen]
    dealt = [points[i : i + params.clusters] for i in range(0, len(points), params.clusters)]
    return {s: centres for s, centres in enumerate(dealt) if not s or len(centres) == params.clusters}


_SUMS = "start int, cluster int, n long, cost long, x0 long, x1 long, x2 long"


def _moved(rows: DataFrame, starts: dict[int, list[Centre]]) -> dict[int, tuple[list[Centre], int]]:
    """One pass for all starts: their next centres, and the cost of the present ones.

    A task adds up whole numbers per start and cluster; plain arrays spare compiling a new
    expression for every set of centres.
    """
    features = [f"_x{i}" for i in range(len(FEATURE_COLUMNS))]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            out = []
            for start, centres in starts.items():
                away = ((points[:, None, :] - np.asarray(centres)[None]) ** 2).sum(axis=2)
                chosen = away.argmin(axis=1)
                cost = np.rint(away.min(axis=1) / _UNITS).astype(np.int64)
                for cluster in range(len(centres)):
                    own = chosen == cluster
                    out.append((start, cluster, int(own.sum()), int(cost[own].sum()), *points[own].sum(axis=0).tolist()))
            names = [part.split()[0] for part in _SUMS.split(", ")]
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names
            )

    sums = rows.select(*features).mapInArrow(add_up, _SUMS).groupBy("start", "cluster")
    sums = sums.agg(*[F.sum(c).alias(c) for c in ("n", "cost", "x0", "x1", "x2")])
    # Starts times clusters rows.
    found = {s: (list(centres), 0) for s, centres in starts.items()}
    for r in sums.collect():
        centres, cost = found[r["start"]]
        if r["n"]:
            centres[r["cluster"]] = tuple(r[f"x{i}"] / r["n"] for i in range(len(features)))
        found[r["start"]] = centres, cost + r["cost"]
    return found


def _shift(before: list[Centre], after: list[Centre]) -> float:
    """Longest way of a centre along one feature."""
    return max(abs(a - b) for one, other in zip(before, after) for a, b in zip(one, other))


def _followed(rows: DataFrame, starts: dict[int, list[Centre]], rest: float, rounds: int) -> dict[int, list[Centre]]:
    """Centres moved until none of their start goes further than `rest` in a round."""
    moving, done = dict(starts), {}
    for _ in range(rounds):
        if not moving:
            break
        after = {s: centres for s, (centres, _) in _moved(rows, moving).items()}
        done |= {s: c for s, c in after.items() if _shift(moving[s], c) <= rest}
        moving = {s: c for s, c in after.items() if s not in done}
    return done | moving


def best_centres(rows: DataFrame, params: Params) -> list[Centre]:
    """Centres with the least cost over all starts, followed until they rest.

    All starts move together, one pass a round, until they nearly rest; then the cheapest
    goes on alone.
    """
    starts = starting_centres(rows, params)
    if not starts:
        return []
    near = _followed(rows, starts, params.kmeans_tolerance * _UNITS, params.kmeans_rounds)
    costs = {s: cost for s, (_, cost) in _moved(rows, near).items()}
    best = min(costs, key=lambda s: (costs[s], s))
    found = _followed(rows, {best: near[best]}, 0.0, params.kmeans_rounds)[best]
    # Numbered by falling features, so that numbers do not depend on the start.
    return sorted(found, reverse=True)


def assigned_to(rows: DataFrame, centres: Sequence[Centre]) -> DataFrame:
    """Scaled rows with the number of their nearest centre."""
    features = [f"_x{i}" for i in range(len(FEATURE_COLUMNS))]
    kept = [c for c in rows.columns if c not in features]
    number = nearest(centres) if centres else F.lit(None).cast("int")
    return rows.select(*kept, number.alias("cluster"))


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """Mean raw features per cluster."""
    return assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_deals"),
        *[mean_of(F.col(c)).alias(f"mean_{c}") for c in FEATURE_COLUMNS],
    )


def name_clusters(profile: DataFrame) -> DataFrame:
    """Archetype of each cluster from its profile: one row per cluster, so a few rows.

    The highest value after a penalty per day closes fast; the lowest value is the
    long tail; the rest is standard. If that leaves a name unused, clusters are named
    by falling value instead.
    """
    whole = Window.partitionBy()
    score = F.col("mean_arr_value") - DAY_PENALTY * F.col("mean_days_in_stage")
    ranked = profile.select(
        "*",
        F.row_number().over(whole.orderBy(score.desc(), F.col("cluster"))).alias("_fast"),
        F.row_number().over(whole.orderBy("mean_arr_value", "cluster")).alias("_small"),
        F.row_number()
        .over(whole.orderBy(F.desc("mean_arr_value"), F.col("cluster")))
        .alias("_large"),
        F.count(F.lit(1)).over(whole).alias("_k"),
    )
    by_role = (
        F.when(F.col("_fast") == 1, HIGH_VALUE)
        .when(F.col("_small") == 1, LONG_TAIL)
        .otherwise(MID_MARKET)
    )
    by_value = (
        F.when(F.col("_large") == 1, HIGH_VALUE)
        .when(F.col("_large") == 2, MID_MARKET)
        .otherwise(LONG_TAIL)
    )
    clash = F.max((F.col("_fast") == 1) & (F.col("_small") == 1)).over(whole)
    label = F.when(clash | (F.col("_k") < 3), by_value).otherwise(by_role)
    return ranked.withColumn("cluster_label", label).drop("_fast", "_small", "_large", "_k")


def with_labels(assigned: DataFrame) -> DataFrame:
    """Deals with the archetype of their cluster."""
    names = name_clusters(cluster_profile(assigned)).select("cluster", "cluster_label")
    # One row per cluster.
    return assigned.join(F.broadcast(names), "cluster")


def kmeans_segments(deals: DataFrame, params: Params) -> DataFrame:
    """Deals with their k-means cluster and its archetype.

    Deals that lack a feature, such as those without an opportunity, are set apart: they
    belong to no cluster and have no archetype.
    """
    rows = scaled(deals)
    whole = reduce(lambda a, b: a & b, [F.col(f"_x{i}").isNotNull() for i in range(len(FEATURE_COLUMNS))])
    named = with_labels(assigned_to(rows.where(whole), best_centres(rows.where(whole), params)))
    apart = rows.where(~whole).select(*deals.columns)
    return named.unionByName(apart, allowMissingColumns=True)


def cluster_mix(segments: DataFrame) -> DataFrame:
    """Deals per customer segment and archetype, with the archetype's fixed colour."""
    label = F.col("cluster_label")
    colour = F.when(label == HIGH_VALUE, "green").when(label == MID_MARKET, "blue")
    counts = segments.groupBy("customer_segment", "cluster_label").agg(
        F.count("deal_id").alias("n_deals")
    )
    return counts.withColumn("colour", colour.otherwise("grey"))
