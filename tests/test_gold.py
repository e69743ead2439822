import json
import random

import pytest
from pyspark.sql import functions as F

from siltstone_checks import inputs
from siltstone_checks.inputs import derive
from siltstone.plans import gold, silver
from tests.conftest import SMALL, rows

EVENTS = (
    "event_key string, visitor_key string, media_id string, media_url string, "
    "percent_viewed double, ip string, country string, received_at timestamp, "
    "pipeline_ingested_at_utc timestamp"
)


def events(spark, *given):
    """Events from (key, visitor, media, url, ip, country, seconds or None)."""
    made = spark.createDataFrame(
        list(given),
        "event_key string, visitor_key string, media_id string, media_url string, "
        "ip string, country string, at int",
    )
    return made.withColumns(
        {
            "received_at": F.timestamp_seconds("at"),
            "percent_viewed": F.lit(0.5),
            "pipeline_ingested_at_utc": F.timestamp_seconds(F.lit(0)),
        }
    ).drop("at")


def test_first_known_per_column(spark):
    df = events(
        spark,
        ("e3", "v", "m", None, "B", "DE", 30),
        ("e1", "v", "m", None, None, "FR", 10),
        ("e2", "v", "m", None, "A", None, 20),
        ("e4", "w", "m", None, None, "US", 5),
        ("e5", None, "m", None, "C", "US", 1),
    )
    assert rows(gold.dim_visitor(df)) == [("v", "A", "FR"), ("w", None, "US")]


def test_rows_without_time_come_last_and_ties_go_by_value(spark):
    df = events(
        spark,
        ("a", "v", "m", None, "no time", "X", None),
        ("b", "v", "m", None, "timed", "Y", 100),
        ("d", "w", "m", None, "second", "Z", 7),
        ("c", "w", "m", None, "first", "Z", 7),
        ("f", "u", "m", None, "f", None, None),
        ("e", "u", "m", None, "e", None, None),
    )
    assert rows(gold.dim_visitor(df)) == [
        ("u", "e", None),
        ("v", "timed", "Y"),
        ("w", "first", "Z"),
    ]


def test_dim_visitor_does_not_depend_on_row_order(spark):
    silver_events = silver.events(derive(spark, SMALL, inputs.EVENTS))
    expected = rows(gold.dim_visitor(silver_events))
    shuffled = silver_events.repartition(13, "media_id").sortWithinPartitions(F.desc("event_key"))
    assert rows(gold.dim_visitor(shuffled)) == expected


def test_merged_batches_equal_the_rebuild(spark):
    silver_events = silver.events(derive(spark, SMALL, inputs.EVENTS))
    by_date = gold.visitor_first_seen(silver_events, "ingested_date")
    assert by_date.columns[:2] == ["visitor_key", "ingested_date"]
    assert rows(gold.merge_first_seen(by_date)) == rows(gold.dim_visitor(silver_events))


def test_fact_visitor_keeps_null_and_unmatched_and_repeats(spark):
    df = events(
        spark,
        ("e1", "v", "m", None, None, None, 1),
        ("e2", None, "m", None, None, None, 1),
        ("e3", "zz", "m", None, None, None, 1),
    )
    visitors = spark.createDataFrame(
        [("v", 1, 2), ("v", 3, 4), (None, 9, 9)], "visitor_key string, load_count int, play_count int"
    )
    got = gold.fact_visitor(df, visitors)
    assert got.columns == [
        "visitor_id",
        "event_id",
        "percent_viewed",
        "load_count",
        "play_count",
        "pipeline_ingested_at_utc",
    ]
    assert rows(got.select("event_id", "visitor_id", "load_count", "play_count")) == [
        ("e1", "v", 1, 2),
        ("e1", "v", 3, 4),
        ("e2", None, None, None),
        ("e3", "zz", None, None),
    ]


def test_hot_visitor_rows_give_the_same_facts(spark):
    rng = random.Random(1)
    df = events(
        spark, *[(f"e{i}", rng.choice("vvvwx"), "m", None, None, None, i) for i in range(60)]
    )
    visitors = spark.createDataFrame(
        [("v", i % 3, 1) for i in range(50)] + [("w", 1, 1)],
        "visitor_key string, load_count int, play_count int",
    )
    assert rows(gold.fact_visitor(df, visitors, rows_per_salt=10)) == rows(
        gold.fact_visitor(df, visitors)
    )


def test_media_urls(spark):
    df = events(
        spark,
        ("e1", "v", "m1", "late", None, None, 9),
        ("e2", "v", "m1", "early", None, None, 3),
        ("e3", "v", "m2", "", None, None, 1),
        ("e4", "v", "m2", "later than the blank one", None, None, 2),
        ("e5", "v", "m3", None, None, None, 1),
        ("e6", "v", "m4", "  ", None, None, 1),
        ("e7", "v", "m5", "\t", None, None, 1),
    )
    media = spark.createDataFrame(
        [(f"m{i}", f"name {i}") for i in range(1, 7)] + [(None, "no id")],
        "hashed_id string, name string",
    )
    got = gold.media_details(media, df, "http://b/")
    assert got.columns == ["media_id", "name", "url"]
    assert rows(got.select("media_id", "url")) == [
        ("m1", "early"),
        ("m2", "http://b/m2"),
        ("m3", "http://b/m3"),
        ("m4", "http://b/m4"),
        ("m5", "\t"),
        ("m6", "http://b/m6"),
        (None, None),
    ]


def test_media_with_a_url_column_is_refused(spark):
    media = spark.createDataFrame([("m1", "u")], "hashed_id string, url string")
    with pytest.raises(ValueError, match="'url'"):
        gold.media_details(media, events(spark, ("e", "v", "m", "u", None, None, 1)), "b")


def test_silver_media_details_takes_any_columns(spark):
    bare = spark.createDataFrame([("m1", "2024-01-02")], "hashed_id string, created string")
    assert silver.media_details(bare).dtypes == [("hashed_id", "string"), ("created", "timestamp")]
    nested = spark.createDataFrame(
        [("m1", "FACEBOOK", ("u", 1), [("x",)], True, 3)],
        "hashed_id string, name string, thumbnail struct<url:string,w:int>, "
        "assets array<struct<url:string>>, archived boolean, duration int",
    )
    assert rows(silver.media_details(nested)) == [("m1", "FACEBOOK", True, 3.0, 1, 0)]


def test_missing_required_columns_are_named(spark):
    df = spark.createDataFrame([("a",)], "event_key string")
    with pytest.raises(ValueError, match="bronze events: missing columns .*visitor_key"):
        silver.events(df)
    with pytest.raises(ValueError, match="silver media_stats"):
        gold.fact_media(df)


def test_fact_media_projects(spark):
    stats = silver.media_stats(derive(spark, SMALL, inputs.MEDIA_STATS)).withColumn("x", F.lit(1))
    assert gold.fact_media(stats).columns == [
        "media_id",
        "load_count",
        "play_count",
        "play_rate",
        "hours_watched",
        "engagement",
        "visitors",
        "pipeline_ingested_at_utc",
    ]
    assert json.loads(gold.fact_media(stats).schema.json())["fields"][0]["type"] == "string"
