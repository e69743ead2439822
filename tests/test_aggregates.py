import pytest
from pyspark.sql import functions as F

from siltstone.operators.aggregates import (
    earliest_known,
    group_by_known,
    known_values,
    mean,
    merge_known,
    total,
    total_count,
)
from tests.conftest import plan, rows


@pytest.fixture()
def facts(spark):
    return spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("a"), F.col("id") % 11)).alias("a"),
        F.when(F.col("id") % 5 == 0, (F.col("id") % 13).cast("string")).alias("b"),
        F.when(F.col("id") % 4 > 0, F.timestamp_seconds((F.col("id") * 37) % 101)).alias("t"),
        (F.col("id") % 6).cast("int").alias("batch"),
    )


def by_hand(facts):
    """The same from plain Python, one value at a time."""
    best = {}
    for r in facts.collect():
        best.setdefault(r.k, {})
        for c in "ab":
            if r[c] is not None:
                place = (r.t is None, r.t.timestamp() if r.t else 0, r[c])
                best[r.k][c] = min(best[r.k].get(c, place), place)
    return sorted(
        ((k, *(v[c][2] if c in v else None for c in "ab")) for k, v in best.items()), key=repr
    )


@pytest.mark.parametrize("values_repeat", [False, True])
def test_earliest_known(facts, values_repeat):
    known = earliest_known(facts, ["k"], ["a", "b"], "t", values_repeat)
    assert rows(known_values(known, ["a", "b"])) == by_hand(facts)


@pytest.mark.parametrize("values_repeat", [False, True])
def test_batches_merge_to_the_whole(facts, values_repeat):
    batches = earliest_known(facts, ["k", "batch"], ["a", "b"], "t", values_repeat)
    merged = merge_known(batches, ["k"], ["a", "b"])
    assert rows(known_values(merged, ["a", "b"])) == by_hand(facts)


def test_repeating_values_are_hashed_first(facts):
    text = plan(earliest_known(facts, ["k"], ["a", "b"], "t", values_repeat=True))
    assert "HashAggregate" in text and text.count("Exchange hashpartitioning") == 2
    assert plan(earliest_known(facts, ["k"], ["a"], "t")).count("Exchange hashpartitioning") == 1


def test_group_aggregates_skip_null_and_nan(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("a", float("nan"), None), ("a", None, 2), ("b", None, None), (None, 5.0, 5)],
        "k string, x double, n int",
    )
    got = group_by_known(
        df,
        "k",
        mean(F.col("x")).alias("mean"),
        total(F.col("x")).alias("total"),
        total_count(F.col("n")).alias("count"),
    )
    assert rows(got) == [("a", 1.0, 1.0, 3), ("b", None, 0.0, 0)]
