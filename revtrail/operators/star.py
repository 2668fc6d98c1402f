"""Wide views of the two facts with the attributes their dimensions lend them.

    R1  opportunities.lead_id      -> leads
    R2  opportunities.owner_id     -> reps
    R3  opportunities.close_date   -> dates   (default date role)
    R4  opportunities.created_date -> dates   (date role "created")
    R5  deals.opp_id               -> opportunities
    R6  deals.close_date           -> dates

A view is built for a list of columns and takes part only in the joins these columns
need. All joins are left joins: facts without a partner keep null attributes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.functions.dates import CALENDAR
from revtrail.operators.cleaning import LEAD_ATTRIBUTES, OPPORTUNITY_COLUMNS
from revtrail.operators.features import with_cac_efficiency
from revtrail.operators.joins import many_to_one

FEATURES = ("days_since_created", "is_stalled", "deal_size_band")
REP_ATTRIBUTES = ("rep_name", "team", "rep_region", "annual_quota")
DATE_ATTRIBUTES = tuple(CALENDAR)
DATE_ROLES = {"close": "close_date", "created": "created_date"}

# The model has no date relationship on leads, so their date has a name of its own.
LEAD_VIEW = ("lead_id", "lead_created_date", *LEAD_ATTRIBUTES)
OPPORTUNITY_VIEW = tuple(
    dict.fromkeys(
        (
            *OPPORTUNITY_COLUMNS,
            *LEAD_ATTRIBUTES,
            *FEATURES,
            *REP_ATTRIBUTES,
            *DATE_ATTRIBUTES,
            "customer_segment",
        )
    )
)
DEAL_COLUMNS = (
    "deal_id",
    "opp_id",
    "arr_value",
    "close_date",
    "customer_segment",
    "cac",
    "renewal_flag",
)
# What a deal takes over from its opportunity by R5.
LINKED = ("lead_id", "owner_id", "stage", "days_in_stage", "created_date", "close_probability", *FEATURES)
DEAL_VIEW = (
    *DEAL_COLUMNS,
    "cac_efficiency",
    *LINKED,
    *LEAD_ATTRIBUTES,
    *REP_ATTRIBUTES,
    *DATE_ATTRIBUTES,
    "cluster_label",
)

SEGMENTED_COLUMNS = (*DEAL_COLUMNS, "cac_efficiency", "days_in_stage", "cluster_label")

def _unknown(columns: set[str], known: Iterable[str], view: str) -> None:
    missing = sorted(columns - set(known))
    if missing:
        raise ValueError(f"{view} has no column {', '.join(missing)}")


def _with_reps(ds, rows: DataFrame, attributes: list[str]) -> DataFrame:
    reps = ds.reps.select("owner_id", *attributes)
    return many_to_one(rows, reps, "owner_id", ds.heavy.get("owner_id"))


def _with_dates(ds, rows: DataFrame, day: str, attributes: list[str]) -> DataFrame:
    days = ds.dim_date.select(F.col("date").alias(day), *attributes)
    # As many rows as the calendar in the settings has days.
    return rows.join(F.broadcast(days), day, "left")


def segment_of_opportunity(ds) -> DataFrame:
    """One segment per opportunity: that of its largest deal, of equal ones the first by id."""
    place = F.struct(-F.coalesce("arr_value", F.lit(-1)), "deal_id")
    return ds.deals_clean.groupBy("opp_id").agg(F.min_by("customer_segment", place).alias("customer_segment"))


def opportunity_view(ds, columns: Iterable[str], date_role: str = "close") -> DataFrame:
    columns = list(dict.fromkeys(columns))
    wanted = set(columns)
    _unknown(wanted, OPPORTUNITY_VIEW, "the opportunity view")
    day = DATE_ROLES[date_role]
    reps = [c for c in REP_ATTRIBUTES if c in wanted]
    dates = [c for c in DATE_ATTRIBUTES if c in wanted]

    base = wanted & {*OPPORTUNITY_COLUMNS, *LEAD_ATTRIBUTES, *FEATURES}
    if reps:
        base.add("owner_id")
    if dates:
        base.add(day)
    if "customer_segment" in wanted:
        base.add("opp_id")
    rows = ds.opportunity_base(sorted(base) or ["opp_id"])
    if reps:
        rows = _with_reps(ds, rows, reps)
    if dates:
        rows = _with_dates(ds, rows, day, dates)
    if "customer_segment" in wanted:
        # The key of the fact itself, of which `relationship_integrity` checks that it is unique.
        rows = rows.join(segment_of_opportunity(ds), "opp_id", "left")
    return rows.select(*columns)


def deal_view(ds, columns: Iterable[str]) -> DataFrame:
    columns = list(dict.fromkeys(columns))
    wanted = set(columns)
    _unknown(wanted, DEAL_VIEW, "the deal view")
    leads = [c for c in LEAD_ATTRIBUTES if c in wanted]
    reps = [c for c in REP_ATTRIBUTES if c in wanted]
    dates = [c for c in DATE_ATTRIBUTES if c in wanted]
    linked = wanted & set(LINKED)
    if leads:
        linked.add("lead_id")
    if reps:
        linked.add("owner_id")
    if "cluster_label" in wanted:
        linked.add("days_in_stage")

    rows = ds.deals_clean
    if "cac_efficiency" in wanted:
        rows = with_cac_efficiency(rows)
    if linked:
        # Cleaning leaves all but the features alone, so the raw rows serve the others.
        whole = linked & set(FEATURES)
        one = ds.opportunity_view(["opp_id", *sorted(linked)]) if whole else ds.opportunities
        rows = many_to_one(rows, one.select("opp_id", *sorted(linked)), "opp_id", ds.heavy.get("opp_id"))
    if leads:
        # Deals spread over leads and reps as the opportunities do.
        one = ds.leads_clean.select("lead_id", *leads)
        rows = many_to_one(rows, one, "lead_id", ds.heavy.get("lead_id"))
    if reps:
        rows = _with_reps(ds, rows, reps)
    if dates:
        rows = _with_dates(ds, rows, "close_date", dates)
    if "cluster_label" in wanted:
        labels = ds.deal_clusters.select("deal_id", "cluster_label")
        rows = rows.join(labels, "deal_id", "left")
    return rows.select(*columns)


def lead_view(ds, columns: Iterable[str]) -> DataFrame:
    columns = list(dict.fromkeys(columns))
    _unknown(set(columns), LEAD_VIEW, "the lead view")
    return ds.leads_clean.withColumnRenamed("created_date", "lead_created_date").select(*columns)
