"""Heavy keys dealt to several tasks must change no value, and planning runs no job."""

import dataclasses

import compare
import pytest
from conftest import SF_DIR

from revtrail.plans import oracle, registry
from revtrail.plans.dataset import Dataset

SQL = oracle.statements()
NAMES = [
    "opportunities_clean",
    "arr_median_by_segment",
    "arr_cac_by_segment_source",
    "closed_deals_build",
    "star_opportunities",
    "star_deals",
]
FITTED = {"kmeans_segments", "kmeans_profile", "kmeans_cluster_counts", "cluster_mix", "closed_deals_segmented"}


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("hot_rows", [1, 7])
def test_heavy_keys(spark, name, hot_rows):
    ds = Dataset.from_testdata(spark, SF_DIR)
    ds.params = dataclasses.replace(ds.params, hot_rows=hot_rows)
    assert hot_rows > 1 or ds.find_heavy_keys()["lead_id"]
    ds.find_heavy_keys()
    rows = registry.presented(registry.ANSWERS[name](ds))
    assert compare.differences(rows, compare.connect(SF_DIR), SQL[name]) == []


def test_planning_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    started = {}
    for name, query in registry.queries().items():
        if name in FITTED:
            continue
        spark.sparkContext.setJobGroup(f"plan {name}", name)
        query(spark, SF_DIR)
        if jobs := tracker.getJobIdsForGroup(f"plan {name}"):
            started[name] = len(jobs)
    spark.sparkContext.setJobGroup("tests", "tests")
    assert started == {}
