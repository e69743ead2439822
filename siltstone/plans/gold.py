"""Silver to gold: visitor dimension, media and visitor facts, enriched media."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.functions.columns import default_url, rename
from siltstone.operators.aggregates import earliest_known, known_values, merge_known
from siltstone.operators.joins import ROWS_PER_SALT, join_unique, left_join

VISITOR_ATTRIBUTES = ("ip", "country")


def dim_visitor(events: DataFrame) -> DataFrame:
    """One row per visitor with the earliest known ip and the earliest known country."""
    return as_dimension(visitor_first_seen(events))


def visitor_first_seen(events: DataFrame, *batch: str) -> DataFrame:
    """What a batch of events says of each visitor: earliest values with their times.

    A day's batch reduces to one row per visitor of that day. Keeping these rows lets
    the dimension be rebuilt from them instead of from all events ever received. The
    events may hold several batches, told apart by the batch columns.
    """
    with_visitor = events.where(F.col("visitor_key").isNotNull())
    keys = ("visitor_key", *batch)
    return earliest_known(
        with_visitor, keys, VISITOR_ATTRIBUTES, "received_at", values_repeat=True
    )


def merge_first_seen(batches: DataFrame) -> DataFrame:
    """The visitor dimension from the batches' rows; equals dim_visitor over all events."""
    return as_dimension(merge_known(batches, ["visitor_key"], VISITOR_ATTRIBUTES))


def as_dimension(first_seen: DataFrame) -> DataFrame:
    """Rows of visitor_first_seen, one per visitor, as the dimension."""
    return rename(known_values(first_seen, VISITOR_ATTRIBUTES), "visitor_key", "visitor_id")


def fact_media(media_stats: DataFrame) -> DataFrame:
    schemas.SILVER_MEDIA_STATS.check(media_stats)
    return media_stats.select(*schemas.SILVER_MEDIA_STATS.required)


def fact_visitor(
    events: DataFrame, visitors: DataFrame, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Each event with the counts of its visitor; repeated visitor rows repeat the event.

    schemas.FACT_VISITOR names the columns and where each comes from.
    """
    table, counts = schemas.FACT_VISITOR, schemas.VISITOR_COUNTS
    key = table["visitor_id"]
    of_event = [source for source in table.values() if source not in counts]
    joined = left_join(
        events.select(of_event),
        visitors.select(key, *counts),
        key,
        spread_by=table["event_id"],
        rows_per_salt=rows_per_salt,
    )
    return joined.select([F.col(source).alias(name) for name, source in table.items()])


def media_details(media: DataFrame, events: DataFrame, base_url: str) -> DataFrame:
    """Media with the URL of their earliest event, or base_url and the id without one.

    An earliest URL that is blank is not skipped for a later one; it takes the default.
    """
    if "url" in media.columns:
        raise ValueError("media_details already has a column 'url'")
    with_url = events.where(F.col("media_url").isNotNull())
    first_urls = earliest_known(
        with_url, ["media_id"], ["media_url"], "received_at", values_repeat=True
    )
    urls = rename(known_values(first_urls, ["media_url"]), "media_url", "url")
    renamed = rename(media, "hashed_id", "media_id")
    columns = renamed.columns
    return join_unique(renamed, urls, "media_id").select(
        *columns, default_url(F.col("url"), F.col("media_id"), base_url).alias("url")
    )
