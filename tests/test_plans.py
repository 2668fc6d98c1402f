"""What the plans must and must not contain at any scale."""

import io
import re
from contextlib import redirect_stdout

import pytest
from conftest import SF_DIR

from revtrail.plans import registry
from revtrail.plans.dataset import Dataset


def plan(rows):
    text = io.StringIO()
    with redirect_stdout(text):
        rows.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize(
    "name",
    ["opportunities_modelled", "star_opportunities", "star_deals", "measures_all", "rep_leaderboard"],
)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(registry.ANSWERS[name](Dataset.from_testdata(spark, SF_DIR)))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert forbidden not in text


def test_only_the_needed_columns_are_read(spark):
    text = plan(registry.ANSWERS["stage_velocity"](Dataset.from_testdata(spark, SF_DIR)))
    schemas = set(re.findall(r"ReadSchema: struct<(.*)>", text))
    assert schemas == {"o_orderkey:bigint,o_orderstatus:string", "l_orderkey:bigint,l_quantity:double"}


def test_unread_tables_leave_the_plan(spark):
    text = plan(registry.ANSWERS["funnel_by_source"](Dataset.from_testdata(spark, SF_DIR)))
    assert "lineitem.parquet" not in text


def test_filters_reach_the_scan(spark):
    text = plan(registry.ANSWERS["rolling_3mo_arr"](Dataset.from_testdata(spark, SF_DIR)))
    assert "EqualTo(o_orderstatus,F)" in text


def test_top_deals_need_no_full_sort(spark):
    text = plan(registry.ANSWERS["top_open_deals"](Dataset.from_testdata(spark, SF_DIR)))
    assert "TakeOrderedAndProject" in text


def test_the_values_of_a_group_are_never_gathered(spark):
    text = plan(registry.ANSWERS["opportunities_modelled"](Dataset.from_testdata(spark, SF_DIR)))
    assert "percentile" not in text.lower()
