import math

import pytest
from conftest import M
from published_deals import ROWS

from revtrail.operators import segments
from revtrail.params import HIGH_VALUE, LONG_TAIL, MID_MARKET, Params

PROFILE = "cluster int, n_deals long, mean_arr_value double, mean_cac double, mean_days_in_stage double"


def names(spark, rows):
    table = spark.createDataFrame([(c, 1, a, 1.0, d) for c, a, d in rows], PROFILE)
    return {r["cluster"]: r["cluster_label"] for r in segments.name_clusters(table).collect()}


def test_names_by_role(spark):
    # the published profile of the three archetypes
    rows = [(0, 128_222.0, 8.56), (1, 51_260.0, 9.29), (2, 35_426.0, 6.26)]
    assert names(spark, rows) == {0: HIGH_VALUE, 1: MID_MARKET, 2: LONG_TAIL}


def test_names_by_value_when_one_cluster_takes_both_roles(spark):
    rows = [(0, 10.0, 1.0), (1, 20.0, 50.0), (2, 30.0, 60.0)]
    assert names(spark, rows) == {0: LONG_TAIL, 1: MID_MARKET, 2: HIGH_VALUE}


def deals(spark):
    rows = []
    for i in range(30):
        rows.append((f"a{i}", "Enterprise", M(200_000 + i), M(3000 + i), 5))
        rows.append((f"b{i}", "SMB", M(20_000 + i), M(3000 + i), 6))
        rows.append((f"c{i}", "Mid-Market", M(60_000 + i), M(9000 + i), 20))
    return spark.createDataFrame(
        rows, "deal_id string, customer_segment string, arr_value decimal(18,2), cac decimal(18,2), days_in_stage int"
    )


def test_clear_groups_are_found(spark):
    labelled = segments.kmeans_segments(deals(spark), Params(kmeans_starts=3))
    mix = {tuple(r) for r in segments.cluster_mix(labelled).collect()}
    assert mix == {
        ("Enterprise", HIGH_VALUE, 30, "green"),
        ("SMB", LONG_TAIL, 30, "grey"),
        ("Mid-Market", MID_MARKET, 30, "blue"),
    }


def test_standardized_features(spark):
    rows = segments.standardized_features(deals(spark)).collect()
    for name in ("z_arr_value", "z_cac", "z_days_in_stage"):
        values = [r[name] for r in rows]
        assert abs(sum(values)) < 1e-3
        assert math.isclose(sum(v * v for v in values) / len(values), 1.0, rel_tol=1e-4)


PUBLISHED = [line.split() for line in ROWS.split("\n") if line]
NAMES = {"H": HIGH_VALUE, "M": MID_MARKET, "L": LONG_TAIL}


@pytest.fixture(scope="module")
def published(spark):
    rows = [(f"P{n:04d}", "SMB", M(arr), M(cac), int(days)) for n, (arr, cac, days, _) in enumerate(PUBLISHED)]
    table = spark.createDataFrame(
        rows, "deal_id string, customer_segment string, arr_value decimal(18,2), cac decimal(18,2), days_in_stage int"
    )
    return {
        parts: {r["deal_id"]: (r["cluster"], r["cluster_label"]) for r in segments.kmeans_segments(table.repartition(parts), Params()).collect()}
        for parts in (1, 2, 4, 8)
    }


def test_labels_do_not_depend_on_the_layout(published):
    assert published[1] == published[2] == published[4] == published[8]


def test_labels_agree_with_the_published_ones(published):
    found = [published[1][f"P{n:04d}"][1] for n in range(len(PUBLISHED))]
    agree = sum(f == NAMES[row[3]] for f, row in zip(found, PUBLISHED))
    assert len(PUBLISHED) == 127 and agree >= 0.95 * 127


def test_deals_without_a_feature_are_set_apart(spark):
    rows = deals(spark).unionByName(
        spark.createDataFrame([("x", "SMB", M(5), M(5), None)], "deal_id string, customer_segment string, arr_value decimal(18,2), cac decimal(18,2), days_in_stage int")
    )
    found = {r["deal_id"]: r["cluster_label"] for r in segments.kmeans_segments(rows, Params(kmeans_starts=3)).collect()}
    assert found["x"] is None and len(found) == 91 and set(found.values()) == {None, *NAMES.values()}


def test_no_deals(spark):
    assert segments.kmeans_segments(deals(spark).limit(0), Params(kmeans_starts=2)).collect() == []
