"""Every answer with an SQL counterpart, compared value by value."""

import compare
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_points
from revtrail.plans import oracle, registry

QUERIES = registry.queries()
SQL = oracle.statements()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_answer_equals_sql(spark, duck, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_only_clustering_has_no_sql():
    assert set(QUERIES) - set(SQL) == {
        "kmeans_segments",
        "kmeans_profile",
        "kmeans_cluster_counts",
        "cluster_mix",
        "closed_deals_segmented",
    }
    assert set(SQL) <= set(QUERIES)


def test_entry_points_hold_every_answer():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns[0] == "lead_source"
    assert rows.count() > 0
