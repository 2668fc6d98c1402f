import pytest
from pyspark.sql import functions as F

from revtrail.operators.joins import heavy_keys, label_lookup, many_to_one
from revtrail.params import Params

HEAVY = Params(hot_rows=1000)


def facts(spark, n=30_000):
    """A third of the rows carry key 1, a third no key, the rest are spread."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(1)).when(i % 3 == 1, F.lit(None)).otherwise(100 + i)
    return spark.range(n).select("id", key.cast("long").alias("k"))


def ones(spark, n=30_000):
    return spark.range(n + 100).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def heavy(rows):
    return heavy_keys(rows, ["k"], HEAVY)["k"]


def test_heavy_keys_are_found(spark):
    prints = spark.createDataFrame([(1,), (None,)], "k long").select(F.xxhash64("k").alias("h")).collect()
    found = heavy(facts(spark))
    assert set(found) == {r["h"] for r in prints} and all(10 <= parts <= 14 for parts in found.values())
    even = spark.range(30_000).select(F.col("id").alias("k"))
    assert heavy(even) == {} == heavy(even.where("k < 0"))


def test_keys_are_not_shuffled_to_be_counted(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sketch", "sketch")
    heavy(facts(spark))
    stages = [s for j in tracker.getJobIdsForGroup("sketch") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("tests", "tests")
    # one row a task goes on to the last stage, which has one
    assert min(tracker.getStageInfo(s).numTasks for s in stages) == 1 and len(stages) <= 3


@pytest.mark.parametrize("known", [True, False])
def test_no_row_is_lost_or_repeated(spark, known):
    many, one = facts(spark), ones(spark)
    joined = many_to_one(many, one, "k", heavy(many) if known else None)
    expected = many.join(one, "k", "left")
    assert sorted(joined.columns) == sorted(expected.columns) and joined.count() == 30_000
    joined = joined.select(*expected.columns)
    assert joined.exceptAll(expected).count() == 0 and expected.exceptAll(joined).count() == 0


def test_rows_of_a_heavy_key_are_dealt_out(spark):
    many = facts(spark)
    found = heavy(many)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = many_to_one(many, ones(spark), "k", found)
        largest = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert largest < 10_000


def test_adaptive_execution_splits_heavy_keys_that_are_not_known(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        joined = many_to_one(facts(spark, 300_000), ones(spark, 300_000), "k")
        largest = joined.select(F.spark_partition_id().alias("p")).write.mode("overwrite")
        largest.saveAsTable("parts_of_heavy_keys")
    finally:
        for key in small:
            spark.conf.unset(key)
    found = spark.table("parts_of_heavy_keys").groupBy("p").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert found[0] < 100_000 and found[1] > 8


def test_labels_join_by_a_checked_broadcast(spark):
    many, one = facts(spark), ones(spark)
    few = one.where("k < 5")
    assert label_lookup(many, few, "k", Params(broadcast_rows=10)).where("v = 10").count() == 10_000
    with pytest.raises(Exception, match="more labels than broadcast_rows=10"):
        label_lookup(many, one, "k", Params(broadcast_rows=10)).collect()
