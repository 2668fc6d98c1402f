import pytest
from conftest import SF_DIR, D, M

from revtrail.operators.quality import row_counts
from revtrail.plans import registry
from revtrail.plans.dataset import Dataset
from revtrail.sources import dimensions, files
from revtrail.sources.schemas import TABLES, schema_of, typed


def test_date_dimension(spark):
    settings = D("2024-06-01"), D("2026-05-31")

    def spine(*tables):
        rows = [spark.createDataFrame([(d and D(d),) for d in days], "date date") for days in tables]
        return {r["date"]: r for r in dimensions.date_spine(rows, *settings).collect()}

    days = spine(["2024-05-02", None], ["2026-07-01", "2025-01-01"])
    assert len(days) == 730 and len(spine([None], [])) == 730
    own = spine(["2025-02-03", None], ["2025-01-30"])
    assert (min(own), max(own), len(own)) == (D("2025-01-30"), D("2025-02-03"), 5)
    assert spine(["2027-01-01"], []) == {}
    edge = days[D("2024-12-30")]
    assert (edge["year"], edge["quarter"], edge["week_num"], edge["is_weekday"]) == (2024, "Q4", 1, True)
    first = days[D("2024-06-01")]
    assert (first["month_name"], first["is_weekday"], first["quarter_label"]) == ("June", False, "2024-Q2")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc"])
def test_tables_survive_a_round_trip(business, spark, tmp_path, fmt):
    tables = {
        "leads": business.leads,
        "opportunities": business.opportunities,
        "closed_deals": business.closed_deals,
        "dim_rep": business.reps,
    }
    files.write_outputs(tables, str(tmp_path), fmt)
    again = Dataset.from_files(spark, str(tmp_path), business.params, fmt)
    assert again.opportunities.schema == schema_of("opportunities")
    assert again.opportunities.exceptAll(business.opportunities).count() == 0
    assert again.closed_deals.exceptAll(business.closed_deals).count() == 0
    assert again.leads.count() == 3
    loaded = files.load_tables(spark, str(tmp_path), ["closed_deals"], fmt, pattern="{table}")
    assert spark.table("closed_deals").count() == loaded["closed_deals"].count() == 2


def test_partitioned_and_bucketed_tables(business, spark, tmp_path):
    path = str(tmp_path / "deals")
    files.write_table(business.deals_clean, path, partition_by=["customer_segment"])
    assert spark.read.parquet(path).where("customer_segment = 'SMB'").count() == 1
    leads = files.save_bucketed(business.leads_clean, "bucketed_leads", "lead_id", 4)
    opps = files.save_bucketed(business.opportunities, "bucketed_opps", "lead_id", 4)
    joined = opps.hint("merge").join(leads, "lead_id", "left")
    assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    joined.collect()
    assert "Exchange hash" not in joined._jdf.queryExecution().executedPlan().toString()


def test_typed_import(spark):
    text = spark.createDataFrame(
        [("D1", "O1", "8900.0", "2025-02-12", "SMB", "3260", "True"), ("D2", "O2", "", " ", "SMB", "1", "false")],
        "deal_id string, opp_id string, arr_value string, close_date string, customer_segment string, "
        "cac string, renewal_flag string",
    )
    first, second = typed(text, "closed_deals").collect()
    padded = spark.createDataFrame(
        [("L", "2025-01-01", " paid ads ", "", "1", "E", " ")],
        "lead_id string, created_date string, lead_source string, industry string, "
        "company_size string, region string, lead_status string",
    )
    lead = typed(padded, "leads").first()
    assert (lead["lead_source"], lead["industry"], lead["lead_status"]) == (" paid ads ", None, " ")
    assert tuple(first) == ("D1", "O1", M("8900.00"), D("2025-02-12"), "SMB", M("3260.00"), True)
    assert second["arr_value"] is None and second["close_date"] is None
    broken = text.selectExpr("deal_id", "opp_id", "'x' AS arr_value", "close_date", "customer_segment", "cac", "renewal_flag")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed(broken, "closed_deals").collect()


def test_truth_values_of_text_files(spark, tmp_path):
    folder = tmp_path / "closed_deals"
    folder.mkdir()
    (folder / "part.csv").write_text(
        "deal_id,opp_id,arr_value,close_date,customer_segment,cac,renewal_flag\n"
        "D1,O1,10.5,2025-01-02,SMB,3,1\nD2,O2,,,SMB,3,0\nD3,O3,1,2025-01-03,,3,True\nD4,O4,1,2025-01-03,,3,false\n"
    )
    rows = files.read_table(spark, str(folder), "closed_deals", "csv").orderBy("deal_id").collect()
    assert [r["renewal_flag"] for r in rows] == [True, False, True, False]
    assert rows[0]["arr_value"] == M("10.50") and rows[1]["arr_value"] is None and rows[1]["close_date"] is None


def test_every_schema_parses():
    assert all(len(schema_of(name).fields) >= 5 for name in TABLES)


def test_built_tables_give_the_same_answers(spark, tmp_path):
    import dataclasses

    ds = Dataset.from_testdata(spark, SF_DIR)
    ds.params = dataclasses.replace(ds.params, kmeans_starts=3)
    built = ds.build(str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "forecast_summary")).count() > 4
    modelled = spark.read.parquet(str(tmp_path / "opportunities_modelled"))
    counts = {r["tbl"]: (r["n_rows"], r["n_columns"]) for r in row_counts({"m": modelled}).collect()}
    assert counts == {"m": (1500, 16)}
    for name in ("leads_clean", "opportunities_modelled", "coverage_ratio", "won_by_size_band", "star_deals",
                 "exec_arr_by_region", "m14_sliced_by_size_band", "kmeans_segments", "closed_deals_segmented"):
        first, again = registry.ANSWERS[name](ds), registry.ANSWERS[name](built)
        columns = sorted(first.columns)
        assert sorted(again.columns) == columns, name
        assert sorted(map(str, again.select(*columns).collect())) == sorted(map(str, first.select(*columns).collect())), name


def test_csv_tables_can_be_built_and_asked(spark, tmp_path):
    import dataclasses

    ds = Dataset.from_testdata(spark, SF_DIR)
    ds.params = dataclasses.replace(ds.params, kmeans_starts=2)
    built = ds.build(str(tmp_path), "csv")
    assert built.opportunities_clean().schema["arr_value"].dataType == ds.opportunities_clean().schema["arr_value"].dataType
    for name in ("leads_clean", "coverage_ratio", "won_by_size_band", "closed_deals_segmented"):
        first, again = registry.ANSWERS[name](ds), registry.ANSWERS[name](built)
        columns = sorted(first.columns)
        assert sorted(map(str, again.select(*columns).collect())) == sorted(map(str, first.select(*columns).collect())), name
    with pytest.raises(ValueError, match="schema must be given"):
        files.read_back(spark, str(tmp_path / "leads_clean"), "csv")


def test_calendar_is_a_setting(business):
    days = [r["date"] for r in business.dim_date.orderBy("date").collect()]
    assert (days[0], days[-1], len(days)) == (D("2025-01-01"), D("2025-05-31"), 151)
