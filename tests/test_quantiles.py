import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from revtrail.operators.quantiles import exact_quantiles

PROBABILITIES = {"low": 0.25, "mid": 0.5, "high": 0.75, "least": 0.0, "most": 1.0}


def by_hand(values):
    return {name: float(np.quantile(values, p)) for name, p in PROBABILITIES.items()}


def test_quantiles_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    groups = {
        "one": [12.34],
        "two": [1.0, 2.0],
        "even": [1.0, 2.0, 3.0, 10.0],
        "ties": [5.0] * 999 + [7.0],
        "negative": [round(v, 2) for v in rng.normal(0, 50, 801).tolist()],
        "wide": [round(v, 2) for v in rng.lognormal(8, 4, 2000).tolist()],
        None: [3.0, 4.0, 8.0],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("one", None), ("none", None)]
    table = spark.createDataFrame(rows, "g string, v double").withColumn(
        "v", F.col("v").cast("decimal(18,2)")
    )
    found = {
        r["g"]: r.asDict()
        for r in exact_quantiles(table, "v", PROBABILITIES, ["g"]).collect()
    }
    assert set(found) == set(groups)
    for g, values in groups.items():
        for name, expected in by_hand(values).items():
            assert math.isclose(found[g][name], expected, rel_tol=1e-12, abs_tol=1e-9), (g, name)


def test_without_groups_and_with_a_frequent_value(spark):
    table = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).cast("decimal(18,2)").alias("v")
    )
    values = [500 if i % 3 == 0 else i for i in range(9000)]
    found = {k: float(v) for k, v in exact_quantiles(table, "v", PROBABILITIES).first().asDict().items()}
    assert found == pytest.approx(by_hand(values))


def test_midpoints_are_decimal(spark):
    table = spark.createDataFrame([(v,) for v in ("0.01", "0.02", "8036.05", "8036.06")], "v string")
    table = table.select(F.col("v").cast("decimal(18,2)").alias("v"))
    quartiles = exact_quantiles(table, "v", {"a": 0.25, "b": 0.5, "c": 0.75}).first()
    assert [str(v) for v in quartiles] == ["0.0175", "4018.0350", "8036.0525"]


def test_nothing_known(spark):
    table = spark.createDataFrame([(None,)], "v decimal(18,2)")
    assert exact_quantiles(table, "v", {"mid": 0.5}).first()["mid"] is None
