"""Deal features: age, stalled flag, size band, cost efficiency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.functions.deals import days_since, is_open
from revtrail.functions.numbers import rounded_ratio
from revtrail.operators.cleaning import stage_averages
from revtrail.operators.joins import label_lookup
from revtrail.operators.quantiles import exact_quantiles
from revtrail.params import SIZE_BANDS, Params


def with_pipeline_age(opps: DataFrame, params: Params) -> DataFrame:
    """Days since creation of open opportunities; null for decided ones."""
    age = F.when(is_open(F.col("stage")), days_since(params.as_of, F.col("created_date")))
    return opps.withColumn("days_since_created", age)


def with_stalled_flag(opps: DataFrame, raw_opps: DataFrame, params: Params) -> DataFrame:
    """Open for longer than a multiple of the average days in the current stage.

    Cleaning drops no opportunity and leaves stage and days alone, so the averages are
    taken from the raw rows, which need no join.
    """
    averages = stage_averages(raw_opps).select("stage", "avg_days")
    late = F.col("days_since_created") > params.stall_multiplier * F.col("avg_days")
    flag = F.coalesce(is_open(F.col("stage")) & late, F.lit(False))
    return label_lookup(opps, averages, "stage", params).withColumn("is_stalled", flag).drop("avg_days")


def size_edges(counts: DataFrame) -> DataFrame:
    """Quartiles of the deal value, from how often (`times`) each value occurs."""
    return exact_quantiles(counts, "arr_value", {"first": 0.25, "second": 0.5, "third": 0.75}, (), "times")


def arr_times(opps: DataFrame) -> DataFrame:
    return opps.groupBy("arr_value").agg(F.count(F.lit(1)).alias("times"))


def with_size_band(opps: DataFrame, counts: DataFrame) -> DataFrame:
    """Quartile of the deal value over all opportunities; equal values share a band."""
    edges = size_edges(counts).select(F.struct("first", "second", "third")).scalar()
    arr = F.col("arr_value")
    banded = opps.withColumn("_edges", edges)
    band = (
        F.when(arr <= F.col("_edges.first"), SIZE_BANDS[0])
        .when(arr <= F.col("_edges.second"), SIZE_BANDS[1])
        .when(arr <= F.col("_edges.third"), SIZE_BANDS[2])
        .when(arr.isNotNull(), SIZE_BANDS[3])
    )
    return banded.withColumn("deal_size_band", band).drop("_edges")


def with_cac_efficiency(deals: DataFrame) -> DataFrame:
    """Deal value per unit of acquisition cost."""
    return deals.withColumn(
        "cac_efficiency", rounded_ratio(F.col("arr_value"), F.col("cac"), 2, even=True)
    )


def stalled_summary(opps: DataFrame) -> DataFrame:
    stalled = F.col("is_stalled")
    return opps.agg(
        F.count_if(is_open(F.col("stage"))).alias("open_deals"),
        F.count_if(stalled).alias("stalled_deals"),
        F.sum(F.when(stalled, F.col("arr_value"))).alias("stalled_arr"),
    )
