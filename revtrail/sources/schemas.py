"""Explicit column types of every table; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from revtrail.functions.numbers import MONEY


def _schema(text: str) -> StructType:
    return StructType.fromDDL(text)


LEADS = (
    "lead_id string, created_date date, lead_source string, industry string, "
    "company_size string, region string, lead_status string"
)
OPPORTUNITIES = (
    f"opp_id string, lead_id string, stage string, arr_value {MONEY}, created_date date, "
    "close_date date, days_in_stage int, owner_id string, close_probability int"
)
CLOSED_DEALS = (
    f"deal_id string, opp_id string, arr_value {MONEY}, close_date date, "
    f"customer_segment string, cac {MONEY}, renewal_flag boolean"
)
OPPORTUNITIES_CLEAN = (
    f"opp_id string, lead_id string, stage string, arr_value {MONEY}, arr_imputed_flag int, "
    "created_date date, close_date date, close_date_imputed_flag int, days_in_stage int, "
    "owner_id string, close_probability int, industry string, company_size string"
)
OPPORTUNITIES_MODELLED = (
    f"{OPPORTUNITIES_CLEAN}, days_since_created int, is_stalled boolean, deal_size_band string"
)
CLOSED_DEALS_SEGMENTED = (
    f"{CLOSED_DEALS}, cac_efficiency double, days_in_stage int, cluster_label string"
)
FORECAST_SUMMARY = (
    "quarter string, forecast_arr double, target int, variance_abs double, variance_pct double"
)
DIM_DATE = (
    "date date, year int, quarter string, month_num int, month_name string, week_num int, "
    "is_weekday boolean"
)
DIM_REP = "owner_id string, rep_name string, team string, rep_region string, annual_quota int"

TABLES = {
    "leads": LEADS,
    "opportunities": OPPORTUNITIES,
    "closed_deals": CLOSED_DEALS,
    "leads_clean": LEADS,
    "opportunities_clean": OPPORTUNITIES_CLEAN,
    "closed_deals_clean": CLOSED_DEALS,
    "opportunities_modelled": OPPORTUNITIES_MODELLED,
    "closed_deals_segmented": CLOSED_DEALS_SEGMENTED,
    "forecast_summary": FORECAST_SUMMARY,
    "dim_date": DIM_DATE,
    "dim_rep": DIM_REP,
}


def schema_of(table: str) -> StructType:
    return _schema(TABLES[table])


def typed(rows: DataFrame, table: str) -> DataFrame:
    """Text columns to the types of a table.

    Empty text is null. A value that does not parse fails the job instead of turning
    into a null silently.
    """
    columns = []
    for field in schema_of(table).fields:
        text = F.col(field.name).cast("string")
        if not isinstance(field.dataType, StringType):
            text = F.trim(text)
        columns.append(F.nullif(text, F.lit("")).cast(field.dataType).alias(field.name))
    return rows.select(*columns)
