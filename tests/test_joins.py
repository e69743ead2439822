import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.operators.joins import join_unique, left_join, one_per_key
from tests.conftest import plan, rows


@pytest.fixture()
def sides(spark):
    """A third of both sides on key 'a', copies among the right rows, NULL keys on both."""
    rng = random.Random(3)
    keys = ["a"] * 10 + list("bcdefghij") + [None] * 5 + ["x1", "x2"]
    left = [(rng.choice(keys), f"e{i}") for i in range(400)]
    right = [(k, i % 4) for i, k in enumerate("aaaaaaaaaaaabbcdee")]
    right += [("a", 1)] * 25 + [(None, 9)] * 3
    return (
        spark.createDataFrame(left, "k string, e string"),
        spark.createDataFrame(right, "k string, n int"),
    )


@pytest.mark.parametrize("rows_per_salt", [1, 2, 30, 10_000])
def test_left_join_equals_the_plain_join(sides, rows_per_salt):
    left, right = sides
    expected = left.join(right, "k", "left").select("k", "e", "n")
    got = left_join(left, right, "k", "e", rows_per_salt).select("k", "e", "n")
    assert rows(got) == rows(expected)


def test_empty_sides(sides):
    left, right = sides
    none = right.where("1 = 0")
    got = left_join(left, none, "k", "e", 1).select("k", "e", "n")
    assert rows(got) == rows(left.select("k", "e", F.lit(None).cast("int")))
    assert left_join(left.where("1 = 0"), right, "k", "e", 1).count() == 0


@pytest.mark.parametrize("rows_per_salt", [1, 1000])
def test_right_values_come_out_as_they_are(spark, rows_per_salt):
    left = spark.createDataFrame([("a", "e1"), ("b", "e2")], "k string, e string")
    right = spark.createDataFrame(
        [("a", -0.0, {"x": 1}), ("a", 0.0, {"x": 1}), ("a", float("nan"), None), ("a", None, {})],
        "k string, v double, m map<string,int>",
    )
    got = left_join(left, right, "k", "e", rows_per_salt).select("k", "v", "m").collect()
    plain = [("a", -0.0, {"x": 1}), ("a", 0.0, {"x": 1}), ("a", float("nan"), None), ("a", None, {}), ("b", None, None)]
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, plain))


def test_no_job_runs_before_the_action(spark, sides):
    left, right = sides
    jobs = spark._jsc.sc().dagScheduler().numTotalJobs()
    left_join(left, right, "k", "e", 1)
    assert spark._jsc.sc().dagScheduler().numTotalJobs() == jobs


def test_join_unique_keeps_null_keys_and_moves_the_grouped_side_once(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, n int")
    right = spark.createDataFrame([("a", 5), ("a", 6), ("b", 7)], "k string, v int")
    joined = join_unique(left, right.groupBy("k").agg(F.min("v").alias("v")), "k")
    assert rows(joined.select("k", "n", "v")) == [("a", 1, 5), ("z", 3, None), (None, 2, None)]
    assert plan(joined).count("Exchange hashpartitioning") == 2


def test_one_per_key(spark):
    once = spark.createDataFrame([(1, "x"), (2, None), (None, "y"), (None, "z")], "k int, v string")
    assert rows(one_per_key(once, "k", "v")) == [(1, "x"), (2, None)]
    twice = spark.createDataFrame([(1, "x"), (1, "x")], "k int, v string")
    with pytest.raises(PySparkException, match="k is repeated"):
        one_per_key(twice, "k", "v").collect()
    left = spark.createDataFrame([(1, 5)], "k int, n int")
    with pytest.raises(PySparkException, match="k is repeated"):
        left.join(one_per_key(twice, "k", "v"), "k", "left").select("k", "n").count()


def test_null_keys_are_spread(spark, with_conf):
    """All keys NULL: the rows must still reach many partitions of the join."""
    with_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    left = spark.range(4000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("e"))
    left = left.withColumn("k", F.when(F.col("e") < 0, F.lit("z")).otherwise(F.col("k")))
    right = spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("n"))
    sizes = [
        r[0]
        for r in left_join(left, right, "k", "e")
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.count(F.lit(1)))
        .select("count(1)")
        .collect()
    ]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_hot_left_key_is_split_by_spark(spark, with_conf):
    """A hot key on the left alone needs no salt: the join is planned with skew splits."""
    with_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    left = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"),
        F.col("id").alias("e"),
    )
    right = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("n"))
    joined = left_join(left, right, "k", "e")
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan(joined)
    assert joined.where("n <> k * 2 OR n IS NULL").count() == 0
