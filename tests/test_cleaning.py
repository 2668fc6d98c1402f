from conftest import DEALS, LEADS, OPPS, D, M

from revtrail.operators import cleaning
from revtrail.params import Params

PARAMS = Params()


def lead(i="L1", day="2025-01-01", source="Partner", status="Qualified", **other):
    return dict(lead_id=i, created_date=D(day), lead_source=source, lead_status=status, **other)


def test_first_row_per_lead_is_kept(make):
    rows = make(
        LEADS,
        [
            lead(day="2025-01-05", source="Event"),
            lead(day="2025-01-02", source="Referral"),
            lead(day="2025-01-02", source="Referral"),
            lead("L2"),
        ],
    )
    clean = {r["lead_id"]: r for r in cleaning.leads_clean(rows, PARAMS).collect()}
    assert len(clean) == 2
    assert clean["L1"]["lead_source"] == "Referral"
    assert clean["L1"]["created_date"] == D("2025-01-02")


def test_labels_and_statuses(make):
    cases = {
        "a": (" paid ads ", None, "Paid Ads", "New"),
        "b": ("OUTBOUND SDR", "", "Outbound SDR", "New"),
        "c": ("  Cold Call ", "  ", "Cold Call", "New"),
        "d": ("organic search", " Contacted ", "Organic Search", "Contacted"),
        "e": (None, "New", None, "New"),
    }
    rows = make(LEADS, [lead(k, source=c[0], status=c[1]) for k, c in cases.items()])
    for r in cleaning.leads_clean(rows, PARAMS).collect():
        assert (r["lead_source"], r["lead_status"]) == cases[r["lead_id"]][2:]


def group(i, arr, industry, size="1-10", **other):
    lead_row = lead(f"L{i}", industry=industry, company_size=size)
    opp = dict(
        opp_id=f"O{i}",
        lead_id=f"L{i}",
        stage="Proposal",
        arr_value=M(arr),
        created_date=D("2025-01-01"),
        days_in_stage=1,
    )
    return lead_row, {**opp, **other}


def test_medians_fill_missing_values(make):
    known = {"one": [7], "two": [1, 2], "three": [9, 1, 5], "four": [1, 2, 4, 100], "none": []}
    pairs, i = [], 0
    for industry, values in known.items():
        for value in [*values, None]:
            pairs.append(group(i, value, industry))
            i += 1
    leads = make(LEADS, [p[0] for p in pairs])
    orphan = dict(opp_id="X", lead_id="nobody", stage="Proposal", days_in_stage=1)
    opps = make(OPPS, [*[p[1] for p in pairs], orphan])
    for hot in (10**6, 1):
        rows = cleaning.opportunities_clean(opps, leads, Params(hot_rows=hot)).collect()
        assert len(rows) == i + 1
        filled = {r["industry"]: r["arr_value"] for r in rows if r["arr_imputed_flag"] == 1}
        assert filled == {
            "one": M("7.00"),
            "two": M("1.50"),
            "three": M("5.00"),
            "four": M("3.00"),
            "none": None,
            None: None,
        }


def test_half_cents_round_up(make):
    pairs, expected = [], {}
    for n, cents in enumerate([(101, 102), (803_605, 803_606), (1, 2), (12_345_677, 12_345_678)]):
        low, high = cents
        pairs += [group(f"{n}a", low / 100, f"i{n}"), group(f"{n}b", high / 100, f"i{n}"), group(f"{n}c", None, f"i{n}")]
        expected[f"i{n}"] = M(high / 100)
    rows = cleaning.opportunities_clean(
        make(OPPS, [p[1] for p in pairs]), make(LEADS, [p[0] for p in pairs]), PARAMS
    ).where("arr_imputed_flag = 1")
    assert {r["industry"]: r["arr_value"] for r in rows.collect()} == expected


def test_close_dates_of_won_deals_are_filled(make):
    def opp(i, stage, closed, days):
        return dict(opp_id=i, lead_id="L", stage=stage, created_date=D("2025-01-01"),
                    close_date=D(closed), days_in_stage=days)

    opps = make(
        OPPS,
        [
            opp("a", "Closed Won", None, 2),
            opp("b", "Closed Won", "2025-02-01", 3),
            opp("c", "Proposal", None, 90),
            opp("d", "Closed Lost", None, 90),
        ],
    )
    leads = make(LEADS, [lead("L")])
    clean = {r["opp_id"]: r for r in cleaning.opportunities_clean(opps, leads, PARAMS).collect()}
    # the average of 2.5 days rounds up to 3
    assert clean["a"]["close_date"] == D("2025-01-04")
    assert clean["a"]["close_date_imputed_flag"] == 1
    assert clean["b"]["close_date"] == D("2025-02-01")
    assert clean["c"]["close_date"] is None and clean["d"]["close_date"] is None
    assert sum(r["close_date_imputed_flag"] for r in clean.values()) == 1


def test_only_requested_columns_are_computed(make):
    opps = make(OPPS, [dict(opp_id="a", lead_id="L", stage="Proposal", days_in_stage=3)])
    leads = make(LEADS, [lead("L")])
    rows = cleaning.opportunities_clean(opps, leads, PARAMS, ["stage", "days_in_stage"])
    assert rows.columns == ["stage", "days_in_stage"]
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_segments_and_costs(make):
    def deal(i, arr, segment=None, cac="1"):
        return dict(deal_id=i, opp_id=i, arr_value=M(arr), customer_segment=segment, cac=M(cac))

    rows = make(
        DEALS,
        [
            deal("a", "24999.99"),
            deal("b", 25_000),
            deal("c", "99999.99"),
            deal("d", 100_000),
            deal("e", 1, "Enterprise"),
            deal("f", 1, "SMB", 0),
            deal("g", 1, "SMB", -5),
            deal("h", 1, "SMB", None),
        ],
    )
    found = {r["deal_id"]: r["customer_segment"] for r in cleaning.closed_deals_clean(rows, PARAMS).collect()}
    assert found == {
        "a": "SMB",
        "b": "Mid-Market",
        "c": "Mid-Market",
        "d": "Enterprise",
        "e": "Enterprise",
    }


def test_deals_from_won_opportunities(make):
    def won(i, lead_id, arr, closed="2025-03-03"):
        return dict(opp_id=i, lead_id=lead_id, stage="Closed Won", arr_value=M(arr), days_in_stage=1,
                    created_date=D("2025-01-01"), close_date=D(closed))

    opps = make(
        OPPS,
        [won("a", "L", 10, "2025-09-09"), won("b", "M", 30_000), won("c", "L", None), won("d", "M", None),
         dict(opp_id="e", lead_id="L", stage="Proposal", arr_value=M(10))],
    )
    leads = make(LEADS, [lead("L", source="event", industry="SaaS", company_size="1-10")])
    params = Params(last_day=D("2025-06-30"))
    clean = cleaning.opportunities_clean(opps, leads, params, ["opp_id", "stage", "arr_value", "close_date", "lead_source"])
    found = {r["deal_id"]: r for r in cleaning.closed_deals_build(clean, params).collect()}
    assert set(found) == {"a", "b", "c", "d"}
    assert found["a"]["close_date"] == D("2025-06-30") and found["a"]["lead_source"] == "Event"
    assert found["b"]["customer_segment"] == "Mid-Market" and found["b"]["lead_source"] is None
    # the median of the lead's group, and no segment where no value is known
    assert (found["c"]["arr_value"], found["c"]["customer_segment"]) == (M(10), "SMB")
    assert (found["d"]["arr_value"], found["d"]["customer_segment"]) == (None, None)


def test_qualified_only(make):
    rows = make(LEADS, [lead("a"), lead("b", status="New")])
    assert [r["lead_id"] for r in cleaning.qualified_only(rows).collect()] == ["a"]
