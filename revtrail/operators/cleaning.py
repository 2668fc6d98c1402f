"""Cleaned lead, opportunity and deal tables."""

from __future__ import annotations

from collections.abc import Iterable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.functions.deals import blank_to, canonical_label, is_won, segment_of
from revtrail.functions.numbers import MONEY
from revtrail.operators.joins import Heavy, many_to_one
from revtrail.operators.quantiles import exact_quantiles
from revtrail.params import CLOSED_WON, NEW, QUALIFIED, Params

LEAD_ATTRIBUTES = ("lead_source", "industry", "company_size", "region", "lead_status")
OPPORTUNITY_COLUMNS = (
    "opp_id",
    "lead_id",
    "stage",
    "arr_value",
    "arr_imputed_flag",
    "created_date",
    "close_date",
    "close_date_imputed_flag",
    "days_in_stage",
    "owner_id",
    "close_probability",
    "industry",
    "company_size",
)


def leads_clean(leads: DataFrame, params: Params) -> DataFrame:
    """One row per lead: the earliest, with a canonical source and a status.

    Written as an aggregate, not as a ranked window: copies of a lead collapse before
    the shuffle, and Spark knows afterwards that `lead_id` is unique, so it drops joins
    to this table whose columns nobody reads. Remaining ties are broken by all other
    columns.
    """
    rest = [c for c in leads.columns if c not in ("lead_id", "created_date")]
    first = leads.groupBy("lead_id").agg(F.min(F.struct("created_date", *rest)).alias("first"))
    return first.select(
        "lead_id",
        "first.created_date",
        canonical_label(F.col("first.lead_source"), params.lead_sources).alias("lead_source"),
        "first.industry",
        "first.company_size",
        "first.region",
        blank_to(F.col("first.lead_status"), NEW).alias("lead_status"),
    )


def qualified_only(leads: DataFrame) -> DataFrame:
    return leads.where(F.col("lead_status") == QUALIFIED)


def stage_averages(opps: DataFrame) -> DataFrame:
    return opps.groupBy("stage").agg(
        F.avg("days_in_stage").alias("avg_days"), F.count(F.lit(1)).alias("n_opps")
    )


GROUPS = ["industry", "company_size"]


def arr_counts(opps: DataFrame, leads: DataFrame, params: Params, heavy: Heavy | None = None) -> DataFrame:
    """How often (`times`) each deal value occurs per industry and company size of the lead.

    Everything that is asked about the values comes from these counts: the medians, the
    values that are filled in, and the quartiles over all of them. Whoever asks more than
    once writes them down first.
    """
    one = leads_clean(leads, params).select("lead_id", *GROUPS)
    rows = many_to_one(opps.select("lead_id", "arr_value"), one, "lead_id", heavy)
    return rows.groupBy(*GROUPS, "arr_value").agg(F.count(F.lit(1)).alias("times"))


def arr_medians(counts: DataFrame) -> DataFrame:
    """Exact median deal value per industry and company size, to four places."""
    return exact_quantiles(counts, "arr_value", {"median_arr": 0.5}, GROUPS, "times")


def known_medians(counts: DataFrame) -> DataFrame:
    """Medians of the groups that fill in values: those of leads with both attributes."""
    return arr_medians(counts.where(" and ".join(f"{c} is not null" for c in GROUPS)))


def filled_counts(counts: DataFrame) -> DataFrame:
    """How often each deal value occurs once missing ones are filled in."""
    filled = counts.join(known_medians(counts), GROUPS, "left")
    return filled.select(F.coalesce("arr_value", F.col("median_arr").cast(MONEY)).alias("arr_value"), "times")


def impute_arr(
    opps: DataFrame, leads: DataFrame, counts: DataFrame, params: Params, heavy: Heavy | None = None
) -> DataFrame:
    """Fill missing deal values with the median of the lead's industry and size.

    A group without any known value, and an opportunity without a lead, stay null. Only
    rows without a value meet leads and medians here; halves of a cent are rounded up.
    """
    kept = [c for c in opps.columns if c != "arr_value"]
    full = opps.where("arr_value is not null").select(*kept, "arr_value", F.lit(0).alias("arr_imputed_flag"))
    missing = opps.where("arr_value is null").drop("arr_value")
    if not set(GROUPS) <= set(opps.columns):
        one = leads_clean(leads, params).select("lead_id", *GROUPS)
        missing = many_to_one(missing.drop(*GROUPS), one, "lead_id", heavy)
    # One row per group; adaptive execution broadcasts them if they are few, or splits a large group.
    filled = missing.join(known_medians(counts), GROUPS, "left").select(
        *kept, F.col("median_arr").cast(MONEY).alias("arr_value"), F.lit(1).alias("arr_imputed_flag")
    )
    return full.unionByName(filled)


def impute_close_date(opps: DataFrame, raw_opps: DataFrame) -> DataFrame:
    """Close won deals without a date after the average days won deals take."""
    cycle = (
        raw_opps.where(is_won(F.col("stage")))
        .groupBy("stage")
        .agg(F.round(F.avg("days_in_stage")).cast("int").alias("cycle"))
    )
    missing = (F.col("stage") == CLOSED_WON) & F.col("close_date").isNull()
    kept = [c for c in opps.columns if c != "close_date"]
    # One row at most: the average of the single stage that is filled in.
    return opps.join(F.broadcast(cycle), "stage", "left").select(
        *kept,
        F.when(missing, F.date_add("created_date", F.col("cycle")))
        .otherwise(F.col("close_date"))
        .alias("close_date"),
        F.when(missing, 1).otherwise(0).alias("close_date_imputed_flag"),
    )


def opportunities_clean(
    opps: DataFrame,
    leads: DataFrame,
    params: Params,
    columns: Iterable[str] = OPPORTUNITY_COLUMNS,
    heavy: Heavy | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Opportunities with lead attributes and filled-in values and dates.

    `columns` may name any cleaned column and any lead attribute; steps that feed none
    of them are left out of the plan. Averages and medians come from the raw rows. `heavy`
    are the heavy values of `lead_id`, if known, and `counts` the `arr_counts`, if written down.
    """
    columns = list(columns)
    wanted = set(columns)
    fill_arr = wanted & {"arr_value", "arr_imputed_flag"}
    fill_date = wanted & {"close_date", "close_date_imputed_flag"}
    attributes = wanted & set(LEAD_ATTRIBUTES)
    if fill_arr and attributes:
        attributes |= set(GROUPS)

    rows = opps
    if attributes:
        one = leads_clean(leads, params).select("lead_id", *sorted(attributes))
        rows = many_to_one(rows, one, "lead_id", heavy)
    if fill_arr:
        counts = arr_counts(opps, leads, params, heavy) if counts is None else counts
        rows = impute_arr(rows, leads, counts, params, heavy)
    if fill_date:
        rows = impute_close_date(rows, opps)
    return rows.select(*columns)


def closed_deals_clean(deals: DataFrame, params: Params) -> DataFrame:
    """Deals with a positive acquisition cost and a segment."""
    return deals.where(F.col("cac") > 0).withColumn(
        "customer_segment",
        F.coalesce("customer_segment", segment_of(F.col("arr_value"), params.segment_edges)),
    )


def closed_deals_build(opps_clean: DataFrame, params: Params) -> DataFrame:
    """Won opportunities, cleaned and with their lead's source, as deals.

    No deal closes after the last day of the calendar. A deal without a value has no segment.
    """
    won = opps_clean.where(is_won(F.col("stage")))
    close, arr = F.col("close_date"), F.col("arr_value")
    return won.select(
        F.col("opp_id").alias("deal_id"),
        "opp_id",
        "arr_value",
        F.when(close.isNotNull(), F.least(close, F.lit(params.last_day))).alias("close_date"),
        F.when(arr.isNotNull(), segment_of(arr, params.segment_edges)).alias("customer_segment"),
        "lead_source",
    )
