"""Sales tables derived from the TPC-H-like test data, with planted defects.

Customers play leads, orders play opportunities, won orders play closed deals and
suppliers play sales reps. Every rule covers the whole table. The defects (duplicate
leads, untidy labels, missing values) are planted by key arithmetic so that each engine
plants the same ones.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrail.functions.numbers import MONEY
from revtrail.params import Params

FIXTURE_PARAMS = Params(
    as_of=date(2001, 8, 2),
    # Narrower than the data: some orders lie outside and are orphans of the calendar.
    first_day=date(1995, 2, 1),
    last_day=date(2001, 9, 30),
    segment_edges=(100_000, 300_000),
    lead_sources=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
)


# Declared, so that no job has to read file footers before a query is planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _geography(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = _table(spark, folder, "nation"), _table(spark, folder, "region")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).select("n_nationkey", "r_name")


LEAD_RULES = (
    "c_custkey AS lead_id",
    "created_date",
    # Planted defect: untidy labels.
    "CASE WHEN c_custkey % 7 = 0 THEN concat('  ', lower(c_mktsegment), ' ') "
    "ELSE c_mktsegment END AS lead_source",
    "concat('Industry ', c_nationkey % 6 + 1) AS industry",
    "CASE WHEN c_acctbal < 1000 THEN 'Size 1' WHEN c_acctbal < 4000 THEN 'Size 2' "
    "WHEN c_acctbal < 7000 THEN 'Size 3' WHEN c_acctbal < 9000 THEN 'Size 4' "
    "ELSE 'Size 5' END AS company_size",
    "r_name AS region",
    # The statuses that cleaning and measures refer to. Planted defects:
    # blank and missing ones.
    "CASE WHEN c_custkey % 25 <= 5 THEN 'New' WHEN c_custkey % 25 <= 12 THEN 'Contacted' "
    "WHEN c_custkey % 25 <= 19 THEN 'Qualified' WHEN c_custkey % 25 <= 22 THEN 'Disqualified' "
    "WHEN c_custkey % 25 = 23 THEN ' ' END AS lead_status",
    # Planted defect: every twentieth lead arrives twice.
    "explode(sequence(1, IF(c_custkey % 20 = 3, 2, 1))) AS copy",
)


def leads(spark: SparkSession, folder: str) -> DataFrame:
    first_order = (
        _table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.expr("min(CAST(o_orderdate AS date)) AS created_date"))
    )
    return (
        _table(spark, folder, "customer")
        .join(_geography(spark, folder), F.expr("c_nationkey = n_nationkey"))
        .join(first_order, "c_custkey", "left")
        .selectExpr(*LEAD_RULES)
        .drop("copy")
    )


# Filtering on this rather than on the stage lets the scan skip orders by status.
WON = "o_orderstatus = 'F' AND o_orderkey % 20 < 11"
STAGE = (
    f"CASE WHEN {WON} THEN 'Closed Won' "
    "WHEN o_orderstatus = 'F' THEN 'Closed Lost' "
    "WHEN o_orderstatus = 'O' THEN IF(o_orderkey % 2 = 0, 'Discovery', 'Evaluation') "
    "ELSE IF(o_orderkey % 2 = 0, 'Proposal', 'Negotiation') END AS stage"
)
CLOSE_DAY = "date_add(CAST(o_orderdate AS date), CAST(20 + (o_orderkey * 7) % 140 AS int))"

OPPORTUNITY_RULES = (
    "o_orderkey AS opp_id",
    "o_custkey AS lead_id",
    "stage",
    # Planted defect: missing values.
    f"CASE WHEN o_orderkey % 50 <> 7 THEN CAST(o_totalprice AS {MONEY}) END AS arr_value",
    "CAST(o_orderdate AS date) AS created_date",
    # Planted defect: won deals without a date.
    "CASE WHEN stage = 'Closed Lost' OR (stage = 'Closed Won' AND o_orderkey % 33 <> 5) "
    f"THEN {CLOSE_DAY} END AS close_date",
    "coalesce(CAST(quantity AS int), 1) AS days_in_stage",
    "owner_id",
    "CAST(CASE stage WHEN 'Discovery' THEN 10 + o_orderkey % 16 "
    "WHEN 'Evaluation' THEN 25 + o_orderkey % 21 WHEN 'Proposal' THEN 45 + o_orderkey % 21 "
    "WHEN 'Negotiation' THEN 65 + o_orderkey % 21 WHEN 'Closed Won' THEN 100 ELSE 0 END AS int) "
    "AS close_probability",
)


def _by_order(spark: SparkSession, folder: str, *totals: str) -> DataFrame:
    lines = _table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    return lines.agg(*[F.expr(total) for total in totals])


def opportunities(spark: SparkSession, folder: str) -> DataFrame:
    lines = _by_order(
        spark, folder, "max(l_quantity) AS quantity", "min(l_suppkey) AS owner_id"
    )
    return (
        _table(spark, folder, "orders")
        .selectExpr("*", STAGE)
        .join(lines, "o_orderkey", "left")
        .selectExpr(*OPPORTUNITY_RULES)
    )


DEAL_RULES = (
    "o_orderkey AS deal_id",
    "o_orderkey AS opp_id",
    f"CAST(o_totalprice AS {MONEY}) AS arr_value",
    f"{CLOSE_DAY} AS close_date",
    # Planted defect: missing segments.
    "CASE WHEN o_orderkey % 40 = 1 THEN NULL WHEN o_totalprice < 100000 THEN 'SMB' "
    "WHEN o_totalprice < 300000 THEN 'Mid-Market' ELSE 'Enterprise' END AS customer_segment",
    "cac",
    "o_orderkey % 5 = 0 AS renewal_flag",
)
# Summed in hundredths of a cent, which is exact and needs no decimal arithmetic per row.
COST = (
    "CAST(CAST(sum(CAST(round(l_extendedprice * 100) AS bigint) * "
    f"CAST(round(l_tax * 100) AS bigint)) AS decimal(24,0)) / 10000 AS {MONEY}) AS cac"
)


def closed_deals(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "orders")
        .where(WON)
        .join(_by_order(spark, folder, COST), "o_orderkey", "left")
        .selectExpr(*DEAL_RULES)
    )


REP_RULES = (
    "s_suppkey AS owner_id",
    "s_name AS rep_name",
    "element_at(array('Enterprise', 'Mid-Market', 'SMB'), CAST(s_suppkey % 3 + 1 AS int)) AS team",
    "r_name AS rep_region",
    "element_at(array(1200000, 800000, 500000), CAST(s_suppkey % 3 + 1 AS int)) AS annual_quota",
)


def reps(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "supplier")
        .join(_geography(spark, folder), F.expr("s_nationkey = n_nationkey"))
        .selectExpr(*REP_RULES)
    )
