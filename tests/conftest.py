import os
import sys
import tempfile
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoint-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def D(text):
    return None if text is None else date.fromisoformat(text)


def M(value):
    return None if value is None else Decimal(str(value))


LEADS = (
    "lead_id string, created_date date, lead_source string, industry string, "
    "company_size string, region string, lead_status string"
)
OPPS = (
    "opp_id string, lead_id string, stage string, arr_value decimal(18,2), created_date date, "
    "close_date date, days_in_stage int, owner_id string, close_probability int"
)
DEALS = (
    "deal_id string, opp_id string, arr_value decimal(18,2), close_date date, "
    "customer_segment string, cac decimal(18,2), renewal_flag boolean"
)
REPS = "owner_id string, rep_name string, team string, rep_region string, annual_quota int"


@pytest.fixture
def make(spark):
    """Small tables from dictionaries; columns left out are null."""

    def build(schema, rows):
        names = [part.strip().split(" ")[0] for part in schema.split(", ")]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return build


@pytest.fixture
def business(spark, make):
    """Two leads, one of them twice, five opportunities and two deals."""
    from revtrail import Dataset, Params

    def lead(i, source, status, region="EMEA", industry="SaaS", day="2025-01-01"):
        return dict(
            lead_id=i,
            created_date=D(day),
            lead_source=source,
            industry=industry,
            company_size="1-10",
            region=region,
            lead_status=status,
        )

    def opp(i, lead_id, stage, arr, created, closed, days, owner, p):
        return dict(
            opp_id=i,
            lead_id=lead_id,
            stage=stage,
            arr_value=M(arr),
            created_date=D(created),
            close_date=D(closed),
            days_in_stage=days,
            owner_id=owner,
            close_probability=p,
        )

    leads = make(
        LEADS,
        [
            lead("L1", " paid ads ", "Qualified"),
            lead("L1", " paid ads ", "Qualified"),
            lead("L2", "Partner", " ", "APAC", "FinTech"),
        ],
    )
    opps = make(
        OPPS,
        [
            opp("O1", "L1", "Closed Won", 100, "2025-02-01", "2025-03-01", 10, "R1", 100),
            opp("O2", "L1", "Closed Won", None, "2025-02-10", None, 11, "R1", 100),
            opp("O3", "L2", "Closed Lost", 300, "2025-02-20", "2025-05-15", 5, "R2", 0),
            opp("O4", "L2", "Proposal", 500, "2025-01-01", None, 20, "R2", 50),
            opp("O5", "L9", "Proposal", 200, "2025-05-31", None, 40, None, 60),
        ],
    )
    deals = make(
        DEALS,
        [
            dict(deal_id="D1", opp_id="O1", arr_value=M(110), close_date=D("2025-03-01"),
                 customer_segment="SMB", cac=M(10), renewal_flag=True),
            dict(deal_id="D2", opp_id="O2", arr_value=M(30_000), close_date=D("2025-04-01"),
                 cac=M(0), renewal_flag=False),
        ],
    )
    reps = make(
        REPS,
        [
            dict(owner_id="R1", rep_name="Ann", team="SMB", rep_region="EMEA", annual_quota=300),
            dict(owner_id="R2", rep_name="Bob", team="Enterprise", rep_region="EMEA", annual_quota=1),
            dict(owner_id="R3", rep_name="Cy", team="SMB", rep_region="APAC", annual_quota=5),
        ],
    )
    return Dataset.of(leads, opps, deals, reps, Params(as_of=D("2025-06-01"), first_day=D("2025-01-01"), last_day=D("2025-05-31")))
