"""The analytical questions asked of the cleaned tables."""

from __future__ import annotations

from collections.abc import Mapping

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.dates import month_label, quarter_name
from revtrail.functions.deals import (
    days_since,
    is_decided,
    is_lost,
    is_open,
    is_won,
    weighted_points,
)
from revtrail.functions.numbers import percent, ratio, round_half_up, rounded_mean, rounded_ratio
from revtrail.operators.joins import Heavy, many_to_one
from revtrail.params import QUALIFIED, STAGES, Params


def _funnel_rates(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(
        *keys,
        "leads",
        "qualified",
        "opps",
        "won",
        percent(F.col("qualified"), F.col("leads")).alias("lead_to_qual_pct"),
        percent(F.col("won"), F.col("opps")).alias("opp_to_won_pct"),
        percent(F.col("won"), F.col("leads")).alias("lead_to_won_pct"),
    )


def _per_lead(opps: DataFrame, leads: DataFrame) -> DataFrame:
    """Leads with their number of opportunities and wins.

    Opportunities are counted per lead before the join, so a lead with very many of
    them enters the join as one row, and counting and joining share one partitioning.
    """
    counted = opps.groupBy("lead_id").agg(
        F.count("opp_id").alias("opps"), F.count_if(is_won(F.col("stage"))).alias("won")
    )
    return leads.join(counted, "lead_id", "left")


def _funnel_counts():
    return (
        F.count(F.lit(1)).alias("leads"),
        F.count_if(F.col("lead_status") == QUALIFIED).alias("qualified"),
        F.coalesce(F.sum("opps"), F.lit(0)).alias("opps"),
        F.coalesce(F.sum("won"), F.lit(0)).alias("won"),
    )


def funnel_by_source(leads: DataFrame, opps: DataFrame) -> DataFrame:
    """Leads, qualified leads, opportunities and wins per lead source, with rates."""
    counts = _per_lead(opps, leads).groupBy("lead_source").agg(*_funnel_counts())
    return _funnel_rates(counts, "lead_source").orderBy(F.desc("leads"), "lead_source")


def funnel_overall(leads: DataFrame, opps: DataFrame) -> DataFrame:
    return _funnel_rates(_per_lead(opps, leads).agg(*_funnel_counts()))


def stage_velocity(opps: DataFrame) -> DataFrame:
    """Rows, average days and share of the pipeline per stage, in funnel order."""
    per_stage = opps.groupBy("stage").agg(
        F.count(F.lit(1)).alias("opp_count"),
        rounded_mean(F.col("days_in_stage"), 1).alias("avg_days_in_stage"),
    )
    position = reduce(
        lambda found, at: F.when(F.col("stage") == at[1], at[0]).otherwise(found),
        enumerate(STAGES),
        F.lit(len(STAGES)),
    )
    # The window runs over one row per stage.
    everything = F.sum("opp_count").over(Window.partitionBy())
    return per_stage.withColumn("pct_of_pipeline", percent(F.col("opp_count"), everything)).orderBy(
        position
    )


def pipeline_coverage(opps: DataFrame, params: Params) -> DataFrame:
    """Open pipeline against the quarterly target."""
    total = F.sum("arr_value")
    target = F.lit(params.quarterly_target)
    return opps.where(is_open(F.col("stage"))).agg(
        round_half_up(total, 0).alias("open_pipeline_arr"),
        F.max(target).alias("quarterly_target"),
        rounded_ratio(total, F.max(target), 2).alias("coverage_ratio"),
    )


def win_rate_by_rep(opps: DataFrame, reps: DataFrame) -> DataFrame:
    """Won and lost deals per owner, best first. Names join after the counting."""
    stage = F.col("stage")
    counts = opps.groupBy("owner_id").agg(
        F.count_if(is_won(stage)).alias("won"),
        F.count_if(is_lost(stage)).alias("lost"),
        F.count_if(is_decided(stage)).alias("decided"),
    )
    return (
        counts.join(reps.select("owner_id", "rep_name"), "owner_id", "left")
        .select(
            "owner_id",
            "rep_name",
            "won",
            "lost",
            percent(F.col("won"), F.col("decided")).alias("win_rate_pct"),
            ratio(F.col("won"), F.col("decided")).alias("win_rate"),
        )
        .orderBy(F.desc_nulls_last("win_rate_pct"), "owner_id")
    )


def arr_cac_by_segment_source(
    deals: DataFrame,
    opps: DataFrame,
    leads: DataFrame,
    heavy: Mapping[str, Heavy] | None = None,
) -> DataFrame:
    """Average deal value and cost per customer segment and lead source.

    Deals without an opportunity, or whose opportunity has no lead, do not count. `heavy`
    are the heavy values of `opp_id` and `lead_id`, if known.
    """
    heavy = heavy or {}
    owners = opps.select("opp_id", "lead_id", F.lit(True).alias("_opp"))
    sources = leads.select("lead_id", "lead_source", F.lit(True).alias("_lead"))
    rows = deals.select("opp_id", "customer_segment", "arr_value", "cac")
    linked = many_to_one(rows, owners, "opp_id", heavy.get("opp_id")).where("_opp")
    # Deals spread over leads as the opportunities do.
    sourced = many_to_one(linked, sources, "lead_id", heavy.get("lead_id")).where("_lead")
    return (
        sourced.groupBy("customer_segment", "lead_source")
        .agg(
            F.count(F.lit(1)).alias("deals"),
            rounded_mean(F.col("arr_value"), 0).alias("avg_arr"),
            rounded_mean(F.col("cac"), 0).alias("avg_cac"),
        )
        .orderBy("customer_segment", F.desc("avg_arr"), "lead_source")
    )


def rolling_3mo_arr(deals: DataFrame) -> DataFrame:
    """Closed value per month and over the last three months that had deals."""
    monthly = deals.groupBy(month_label(F.col("close_date")).alias("ym")).agg(
        F.sum("arr_value").alias("arr")
    )
    # The window runs over one row per month.
    recent = Window.orderBy("ym").rowsBetween(-2, 0)
    return monthly.select(
        "ym",
        round_half_up(F.col("arr"), 0).alias("monthly_arr"),
        round_half_up(F.sum("arr").over(recent), 0).alias("rolling_3mo_arr"),
    ).orderBy("ym")


def forecast_by_quarter(opps: DataFrame) -> DataFrame:
    """Probability-weighted open pipeline by quarter of creation."""
    day = F.col("created_date")
    points = F.sum(weighted_points(F.col("arr_value"), F.col("close_probability")))
    return (
        opps.where(is_open(F.col("stage")))
        .groupBy(F.year(day).alias("yr"), quarter_name(day).alias("qtr"))
        .agg(rounded_ratio(points, F.lit(100), 0).alias("forecast_arr"))
        .orderBy("yr", "qtr")
    )


def top_open_deals(opps: DataFrame, params: Params, n: int = 10) -> DataFrame:
    """The largest open deals and how long they have been open."""
    return (
        opps.where(is_open(F.col("stage")))
        .orderBy(F.desc_nulls_last("arr_value"), "opp_id")
        .limit(n)
        .select(
            "opp_id",
            "owner_id",
            "stage",
            round_half_up(F.col("arr_value"), 0).alias("arr_value"),
            days_since(params.as_of, F.col("created_date")).alias("days_open"),
        )
    )
