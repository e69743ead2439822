"""Bronze to silver: typed columns, one table each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.functions.columns import (
    drop_present,
    mentions,
    parse_boolean,
    parse_double,
    parse_timestamp,
    rename,
    transform_present,
)

# Columns of media_details that silver does without.
UNUSED_MEDIA_COLUMNS = ("thumbnail", "subfolder", "project", "share_link", "assets")


def events(bronze: DataFrame) -> DataFrame:
    schemas.BRONZE_EVENTS.check(bronze)
    return transform_present(
        bronze, {"received_at": parse_timestamp, "pipeline_ingested_at_utc": parse_timestamp}
    )


def media_details(bronze: DataFrame) -> DataFrame:
    """Every column is optional; the platform flags need the name."""
    typed = transform_present(
        drop_present(bronze, UNUSED_MEDIA_COLUMNS),
        {
            "created": parse_timestamp,
            "updated": parse_timestamp,
            "pipeline_ingested_at_utc": parse_timestamp,
            "archived": parse_boolean,
            "duration": parse_double,
            "progress": parse_double,
        },
    )
    if "name" not in typed.columns:
        return typed
    name = F.col("name")
    return typed.withColumns(
        {"facebook": mentions(name, "facebook"), "youtube": mentions(name, "youtube")}
    )


def media_stats(bronze: DataFrame) -> DataFrame:
    schemas.BRONZE_MEDIA_STATS.check(bronze)
    return transform_present(
        rename(bronze, "pipeline_media_id", "media_id"),
        {"pipeline_ingested_at_utc": parse_timestamp},
    )


def visitors(bronze: DataFrame) -> DataFrame:
    schemas.BRONZE_VISITORS.check(bronze)
    return transform_present(
        bronze,
        {
            "created_at": parse_timestamp,
            "last_active_at": parse_timestamp,
            "pipeline_ingested_at_utc": parse_timestamp,
        },
    )
