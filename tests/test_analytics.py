import pytest
from conftest import DEALS, D, M

from revtrail.operators import analytics, features, forecast, quality
from revtrail.params import Params


def test_funnel(business):
    rows = analytics.funnel_by_source(business.leads_clean, business.opportunities).collect()
    found = {r["lead_source"]: r for r in rows}
    assert (found["Paid Ads"]["opps"], found["Paid Ads"]["won"]) == (2, 2)
    assert found["Paid Ads"]["lead_to_won_pct"] == 200.0
    assert (found["Partner"]["opps"], found["Partner"]["opp_to_won_pct"]) == (2, 0.0)
    overall = analytics.funnel_overall(business.leads_clean, business.opportunities).first()
    assert (overall["leads"], overall["qualified"], overall["opps"]) == (2, 1, 4)


def test_velocity_keeps_funnel_order(business):
    rows = analytics.stage_velocity(business.opportunities).collect()
    assert [r["stage"] for r in rows] == ["Proposal", "Closed Won", "Closed Lost"]
    assert [r["avg_days_in_stage"] for r in rows] == [30.0, 10.5, 5.0]
    assert [r["pct_of_pipeline"] for r in rows] == [40.0, 40.0, 20.0]


def test_coverage(business):
    row = analytics.pipeline_coverage(business.opportunities, Params(quarterly_target=100)).first()
    assert (row["open_pipeline_arr"], row["coverage_ratio"]) == (700.0, 7.0)


def test_win_rate_without_decided_deals(business):
    found = {
        r["owner_id"]: r for r in analytics.win_rate_by_rep(business.opportunities, business.reps).collect()
    }
    assert found["R1"]["win_rate_pct"] == 100.0 and found["R1"]["rep_name"] == "Ann"
    assert found["R2"]["win_rate"] == 0.0
    assert found[None]["win_rate_pct"] is None and found[None]["won"] == 0


def test_segment_and_source(business):
    rows = analytics.arr_cac_by_segment_source(
        business.deals_clean, business.opportunities, business.leads_clean, business.params
    ).collect()
    assert [tuple(r) for r in rows] == [("SMB", "Paid Ads", 1, 110.0, 10.0)]


def deal(day, arr):
    return dict(deal_id=day, opp_id=day, arr_value=M(arr), close_date=D(day), cac=M(1))


def test_rolling_sum_counts_months_with_deals(make):
    deals = make(
        DEALS,
        [deal("2025-01-03", 1), deal("2025-01-30", 1), deal("2025-02-01", 10), deal("2025-04-01", 100),
         deal("2025-05-01", 1000)],
    )
    rows = analytics.rolling_3mo_arr(deals).collect()
    assert [(r["ym"], r["rolling_3mo_arr"]) for r in rows] == [
        ("2025-01", 2.0),
        ("2025-02", 12.0),
        ("2025-04", 112.0),
        ("2025-05", 1110.0),
    ]


def test_published_monthly_values(make):
    """A few published months: 123,100 then 194,100, 317,000 and 374,100."""
    deals = make(
        DEALS,
        [deal("2024-08-01", 123_100), deal("2024-09-01", 194_100), deal("2024-10-01", 317_000),
         deal("2024-11-01", 374_100)],
    )
    rolling = [r["rolling_3mo_arr"] for r in analytics.rolling_3mo_arr(deals).collect()]
    assert rolling == [123_100.0, 317_200.0, 634_200.0, 885_200.0]


def test_top_open_deals(business):
    rows = analytics.top_open_deals(business.opportunities, business.params, n=1).collect()
    assert [tuple(r) for r in rows] == [("O4", "R2", "Proposal", 500.0, 151)]


def test_forecast(business):
    opps = business.opportunities
    assert [tuple(r) for r in analytics.forecast_by_quarter(opps).collect()] == [
        (2025, "Q1", 250.0),
        (2025, "Q2", 120.0),
    ]
    monthly = forecast.forecast_monthly(opps, Params(quarterly_target=300)).collect()
    assert [tuple(r) for r in monthly] == [
        ("2025-01", 250.0, 212.5, 287.5, 100.0, 250.0),
        ("2025-05", 120.0, 102.0, 138.0, 100.0, 370.0),
    ]
    quarterly = forecast.forecast_summary(opps, Params(quarterly_target=200)).collect()
    assert [tuple(r) for r in quarterly] == [
        ("2025-Q1", 250.0, 200, 50.0, 25.0),
        ("2025-Q2", 120.0, 200, -80.0, -40.0),
    ]


def test_published_quarter(make, spark):
    """A quarter of 291,052 against 1,200,000 is 75.7 per cent short."""
    opps = spark.createDataFrame(
        [("Proposal", M(291_052), 100, D("2024-06-01"))],
        "stage string, arr_value decimal(18,2), close_probability int, created_date date",
    )
    row = forecast.forecast_summary(opps, Params()).first()
    assert (row["quarter"], row["variance_abs"], row["variance_pct"]) == ("2024-Q2", -908_948.0, -75.7)


def test_stalled_flag(spark):
    """Older than one and a half times the stage average; equal is not older."""
    rows = [
        ("equal", "Proposal", D("2025-05-02"), 20),  # 30 days, average 20
        ("older", "Proposal", D("2025-05-01"), 20),
        ("future", "Proposal", D("2025-07-01"), 20),
        ("done", "Closed Won", D("2020-01-01"), 1),
        ("undated", "Proposal", None, 20),
    ]
    opps = spark.createDataFrame(rows, "opp_id string, stage string, created_date date, days_in_stage int")
    params = Params(as_of=D("2025-06-01"))
    flagged = features.with_stalled_flag(features.with_pipeline_age(opps, params), opps, params)
    found = {r["opp_id"]: (r["days_since_created"], r["is_stalled"]) for r in flagged.collect()}
    assert found == {
        "equal": (30, False),
        "older": (31, True),
        "future": (-30, False),
        "done": (None, False),
        "undated": (None, False),
    }


def test_size_bands_never_split_equal_values(spark):
    opps = spark.createDataFrame(
        [(M(v),) for v in (1, 2, 3, 10, 10, 4, 5)] + [(None,)], "arr_value decimal(18,2)"
    )
    rows = features.with_size_band(opps, features.arr_times(opps)).collect()
    bands = {(r["arr_value"], r["deal_size_band"]) for r in rows}
    assert bands == {
        (M("1.00"), "Q1"),
        (M("2.00"), "Q1"),
        (M("3.00"), "Q2"),
        (M("4.00"), "Q2"),
        (M("5.00"), "Q3"),
        (M("10.00"), "Q4"),
        (None, None),
    }


def test_cost_efficiency_rounds_half_to_even(spark):
    deals = spark.createDataFrame(
        [(M(8900), M(3260)), (M(51_300), M(1180)), (M("0.285"), M(1)), (M(1), M(8)), (M(3), M(8)), (M(1), M(0))],
        "arr_value decimal(18,3), cac decimal(18,2)",
    )
    found = [r["cac_efficiency"] for r in features.with_cac_efficiency(deals).collect()]
    assert found == [2.73, 43.47, 0.28, 0.12, 0.38, None]


def test_integrity(business):
    rows = quality.relationship_integrity(
        business.opportunities, business.deals_clean, business.leads, business.reps, business.dim_date
    ).collect()
    found = {r["relationship"]: tuple(r)[1:] for r in rows}
    # lead L1 is there twice, opportunity O5 belongs to an unknown lead
    assert found["R1"] == (1, 1, 1)
    assert found["R2"] == found["R3"] == found["R5"] == (0, 0, 0)


def test_profile(business):
    tables = {
        "leads": business.leads,
        "opportunities": business.opportunities,
        "closed_deals": business.closed_deals,
    }
    found = {(r["tbl"], r["col"]): r["n_null"] for r in quality.null_profile(tables).collect()}
    assert found == {
        ("leads", "lead_status"): 0,
        ("opportunities", "arr_value"): 1,
        ("opportunities", "close_date"): 3,
        ("closed_deals", "cac"): 0,
        ("closed_deals", "customer_segment"): 1,
    }
    assert [tuple(r) for r in quality.duplicate_keys(business.leads, "lead_id").collect()] == [("L1", 2)]
    assert quality.duplicate_key_total(business.leads, "lead_id").first()[0] == 1
    assert [r[0] for r in quality.won_missing_close_date(business.opportunities).collect()] == ["O2"]
    outliers = quality.arr_outliers(business.opportunities, Params(outlier_bounds=(150, 400)))
    assert [r["opp_id"] for r in outliers.collect()] == ["O1", "O4"]
    audit = quality.imputation_audit(business.opportunities_clean()).first()
    assert tuple(audit) == (1, 1, 0)


def test_fractions_are_rounded_once(spark):
    from revtrail.functions.numbers import rounded_ratio

    cases = [
        # above, below, half up, half even
        ("71250003", "10000000", 7.13, 7.13),
        ("71349999999999", "10000000000000", 7.13, 7.13),
        ("7.125", "1", 7.13, 7.12),
        ("7.135", "1", 7.14, 7.14),
        ("-7.125", "1", -7.13, -7.12),
        ("1", "-8", -0.13, -0.12),
        ("1", "0", None, None),
        (None, "1", None, None),
    ]
    rows = spark.createDataFrame([(a, b) for a, b, _, _ in cases], "a string, b string").selectExpr(
        "CAST(a AS decimal(22,4)) AS a", "CAST(b AS decimal(18,4)) AS b"
    )
    from pyspark.sql import functions as F

    found = rows.select(rounded_ratio(F.col("a"), F.col("b"), 2), rounded_ratio(F.col("a"), F.col("b"), 2, even=True))
    assert [tuple(r) for r in found.collect()] == [(u, e) for _, _, u, e in cases]
