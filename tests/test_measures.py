import dataclasses

import pytest
from conftest import SF_DIR, D

from revtrail.operators import measures, star
from revtrail.operators.measures import MEASURES, Between, evaluate
from revtrail.params import LONG_TAIL
from revtrail.plans import report
from revtrail.plans.dataset import Dataset


def one(rows):
    return rows.first().asDict()


def test_all_measures_without_axis(business):
    row = one(measures.measures_all(business))
    assert set(row) == set(MEASURES)
    assert (row["total_leads"], row["qualified_leads"], row["lead_qualified_rate"]) == (2, 1, 0.5)
    assert (row["total_opportunities"], row["closed_won_count"]) == (5, 2)
    assert row["win_rate"] == pytest.approx(2 / 3)
    # O2 takes the median value 100 and closes 11 days (10.5 rounded up) after creation
    assert float(row["closed_won_arr"]) == 200 and row["avg_deal_size"] == 100
    assert row["avg_days_to_close"] == pytest.approx((28 + 11) / 2)
    assert float(row["open_pipeline_arr"]) == 700
    assert row["forecast_arr"] == 370 and row["forecast_variance"] == 370 - 1_200_000
    assert (row["avg_cac"], row["cac_efficiency"]) == (10.0, 20.0)
    # O4 is 151 days old at an average of 30 days in stage
    assert (row["stalled_count"], float(row["stalled_arr"])) == (1, 500)
    assert float(row["segment_arr"]) == 110
    # the calendar ends on 2025-05-31: March counts for three months, not for the quarter
    assert float(row["rolling_3m_arr"]) == 100 and row["qtd_arr"] is None


def test_additive_measures_sum_to_the_total(business):
    names = ["closed_won_count", "closed_won_arr", "open_pipeline_arr", "stalled_count"]
    total = one(evaluate(business, names))
    for axis in (["region"], ["stage"], ["team", "lead_source"], ["year", "quarter"]):
        rows = evaluate(business, names, axis).collect()
        for name in names:
            assert sum(r[name] or 0 for r in rows) == total[name], (axis, name)


def test_replaced_context_repeats_the_total(business):
    names = ["closed_won_count", "total_opportunities"]
    respect = {r["stage"]: tuple(r)[1:] for r in evaluate(business, names, ["stage"]).collect()}
    assert respect == {"Closed Won": (2, 2), "Closed Lost": (0, 1), "Proposal": (0, 2)}
    replace = evaluate(business, names, ["stage"], context="replace").collect()
    assert {r["stage"]: tuple(r)[1:] for r in replace} == {
        "Closed Won": (2, 2),
        "Closed Lost": (2, 1),
        "Proposal": (2, 2),
    }


def test_filters_reach_only_what_they_can(business):
    filters = {"team": ["SMB"], "close_date": Between(D("2025-03-01"), D("2025-03-31"))}
    row = one(evaluate(business, ["total_leads", "closed_won_count", "avg_cac"], filters=filters))
    assert row == {"total_leads": 2, "closed_won_count": 1, "avg_cac": 10.0}


def test_archetypes_slice_the_deals(spark):
    ds = Dataset.from_testdata(spark, SF_DIR)
    ds.params = dataclasses.replace(ds.params, kmeans_starts=2)
    total = one(evaluate(ds, ["segment_arr"]))["segment_arr"]
    rows = evaluate(ds, ["segment_arr"], ["cluster_label"]).collect()
    assert len(rows) == 3 and sum(r["segment_arr"] for r in rows) == total
    tail = one(evaluate(ds, ["segment_arr"], filters={"cluster_label": [LONG_TAIL]}))
    assert tail["segment_arr"] in {r["segment_arr"] for r in rows if r["cluster_label"] == LONG_TAIL}


def test_unreachable_axis(business):
    with pytest.raises(ValueError, match="does not reach the leads"):
        evaluate(business, ["total_leads"], ["team"])
    with pytest.raises(ValueError, match="no column"):
        star.opportunity_view(business, ["nothing"])


def test_facts_do_not_multiply_each_other(business):
    rows = {r["lead_source"]: r for r in evaluate(business, ["cac_efficiency", "avg_cac"], ["lead_source"]).collect()}
    assert rows["Paid Ads"]["cac_efficiency"] == 20.0
    assert rows["Partner"]["cac_efficiency"] is None and rows["Partner"]["avg_cac"] is None


def test_rolling_by_calendar_and_quarter_to_date(business):
    rolling = {r["month"]: r["rolling_3m_arr"] and float(r["rolling_3m_arr"]) for r in measures.rolling_closed_arr(business).collect()}
    assert rolling == {"2025-01": None, "2025-02": 100.0, "2025-03": 200.0, "2025-04": 200.0, "2025-05": 100.0}
    qtd = {r["date"]: r["qtd_arr"] and float(r["qtd_arr"]) for r in measures.quarter_to_date_arr(business).collect()}
    assert len(qtd) == 151 and qtd[D("2025-02-20")] is None and qtd[D("2025-05-31")] is None
    assert qtd[D("2025-02-21")] == qtd[D("2025-02-28")] == 100.0 and qtd[D("2025-03-01")] == qtd[D("2025-03-31")] == 200.0


def test_time_measures_follow_axis_and_filter(business):
    names = ["rolling_3m_arr", "qtd_arr"]
    march = {"close_date": Between(D("2025-03-01"), D("2025-03-15"))}
    row = one(evaluate(business, names, filters=march))
    # the filter moves the last day; the days before it count
    assert (float(row["rolling_3m_arr"]), float(row["qtd_arr"])) == (200, 200)
    by_quarter = {r["quarter"]: tuple(v and float(v) for v in tuple(r)[1:]) for r in evaluate(business, names, ["quarter"]).collect()}
    assert by_quarter == {"Q1": (200.0, 200.0), "Q2": (100.0, None)}
    by_team = {r["team"]: float(r["rolling_3m_arr"]) for r in evaluate(business, ["rolling_3m_arr"], ["team"], march).collect()}
    assert by_team == {"SMB": 200.0}


def test_filters_that_reach_nothing_are_errors(business):
    with pytest.raises(ValueError, match="no_such_column"):
        evaluate(business, ["closed_won_count"], filters={"no_such_column": ["x"]})
    # the leads have no date of the calendar; their own has its own name
    row = one(evaluate(business, ["total_leads", "total_opportunities"], filters={"created_date": [D("2025-01-01")]}))
    assert row == {"total_leads": 2, "total_opportunities": 1}
    row = one(evaluate(business, ["total_leads"], filters={"lead_created_date": [D("2025-01-02")]}))
    assert row == {"total_leads": 0}


def test_opportunity_attributes_reach_the_deals(business):
    everything = one(evaluate(business, ["avg_cac"]))
    assert everything == {"avg_cac": 10.0}
    assert one(evaluate(business, ["avg_cac"], filters={"deal_size_band": ["Q4"]})) == {"avg_cac": None}
    assert one(evaluate(business, ["avg_cac"], filters={"close_probability": [100]})) == {"avg_cac": 10.0}
    assert one(evaluate(business, ["avg_cac"], filters={"is_stalled": [True]})) == {"avg_cac": None}


def test_deals_do_not_multiply_their_opportunity(make, business):
    from conftest import DEALS, M

    deals = make(
        DEALS,
        [
            dict(deal_id="D1", opp_id="O1", arr_value=M(10), customer_segment="SMB", cac=M(1)),
            dict(deal_id="D2", opp_id="O1", arr_value=M(90), customer_segment="Enterprise", cac=M(1)),
        ],
    )
    ds = Dataset.of(business.leads, business.opportunities, deals, business.reps, business.params)
    view = ds.opportunity_view(["opp_id", "customer_segment"]).collect()
    assert len(view) == 5 and {r["opp_id"]: r["customer_segment"] for r in view}["O1"] == "Enterprise"
    total = one(evaluate(ds, ["closed_won_arr"], filters={"customer_segment": ["SMB", "Enterprise"]}))
    assert total == one(evaluate(ds, ["closed_won_arr"], filters={"customer_segment": ["SMB"]}))
    assert float(total["closed_won_arr"]) == 100
    rows = {r[0]: float(r[1]) for r in evaluate(ds, ["closed_won_arr"], ["customer_segment"]).where("closed_won_arr is not null").collect()}
    assert rows == {"Enterprise": 100.0, None: 100.0}


def test_segments_with_total(business):
    found = {r[0]: float(r[1]) for r in measures.arr_by_segment(business).collect()}
    assert found == {"SMB": 110.0, "Total": 110.0}


def test_cohorts_use_the_creation_date(business):
    found = {r[0]: r[1] and float(r[1]) for r in measures.cohort_won_arr(business).collect()}
    assert found == {"2025-Q1": 200.0, "2025-Q2": None}


def test_report_rows(business):
    steps = {r["step"]: (r["n"], r["pct_of_previous"]) for r in report.funnel_steps(business).collect()}
    assert steps == {
        "Leads": (2, None),
        "Qualified": (1, 50.0),
        "Opportunities": (5, 500.0),
        "Closed Won": (2, 40.0),
    }
    quota = {r["rep_name"]: (float(r["closed_won_arr"]), r["quota_met"]) for r in report.rep_quota_attainment(business).collect()}
    assert quota == {"Ann": (200.0, False), "Bob": (0.0, False), "Cy": (0.0, False)}
    colours = report.exec_kpis(business).first()
    assert (colours["win_rate_colour"], colours["coverage_colour"]) == ("green", "red")
    best = {r["lead_source"]: r["is_best"] for r in report.conversion_by_source(business).collect()}
    assert best == {"Paid Ads": True, "Partner": False, None: False}
    board = {r["rep_name"]: r["win_rate_scale"] for r in report.rep_leaderboard(business).collect()}
    assert board == {"Ann": 1.0, "Bob": 0.0, None: None}
    stages = {r["stage"] for r in report.coverage_by_stage(business).collect()}
    assert stages == {"Proposal"}
