"""Scheduled calls: landed response pages to rows, and the completion rate."""

from __future__ import annotations

import logging
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.functions.documents import collection, field_or, parse_document, required_field
from siltstone.operators.aggregates import completion_counts, completion_share
from siltstone.sources.partitions import write_table
from siltstone.sources.staging import stage
from siltstone.sources.text import write_csv

log = logging.getLogger(__name__)

# Fixed value: the status of a response that can be used.
SUCCESS = 200

# Output column, path in the document, value when the key is missing.
CALL_FIELDS = (
    ("event_id", "$.uri", ""),
    ("event_type", "$.event_type", ""),
    ("start_time", "$.start_time", ""),
    ("end_time", "$.end_time", ""),
    ("status", "$.status", "N/A"),
    ("invitee_email", "$.location.email", "N/A"),
)


def _elements(pages: DataFrame) -> DataFrame:
    schemas.LANDED_PAGES.check(pages)
    usable = pages.where(F.col("status_code") == SUCCESS)
    return usable.select(F.explode(collection(parse_document(F.col("raw")))).alias("element"))


def flatten_calls(pages: DataFrame) -> DataFrame:
    """One row per scheduled call of every usable page."""
    element = F.col("element")
    return _elements(pages).select(
        *[field_or(element, path, default).alias(name) for name, path, default in CALL_FIELDS]
    )


def identifiers(pages: DataFrame, strict: bool = True) -> DataFrame:
    """The uri of every collection element; an element without one fails if strict."""
    element = F.col("element")
    uri = required_field(element, "$.uri") if strict else field_or(element, "$.uri", "")
    return _elements(pages).select(uri.alias("uri"))


def organizations(pages: DataFrame) -> DataFrame:
    """The current organization of each usable page, empty text without one."""
    schemas.LANDED_PAGES.check(pages)
    doc = parse_document(F.col("raw"))
    return (
        pages.where(F.col("status_code") == SUCCESS)
        .withColumn("doc", doc)
        .where(F.col("doc").isNotNull())
        .select(
            "event_type",
            field_or(F.col("doc"), "$.resource.current_organization", "").alias("organization"),
        )
    )


def _outcome() -> Column:
    readable = parse_document(F.col("raw")).isNotNull()
    return (
        F.when(F.coalesce(F.col("status_code") != SUCCESS, F.lit(True)), "refused")
        .when(readable, "used")
        .otherwise("unreadable")
    )


def page_outcomes(pages: DataFrame) -> DataFrame:
    """Pages by outcome: used, refused by the service, or not readable as JSON."""
    schemas.LANDED_PAGES.check(pages)
    return pages.groupBy(_outcome().alias("outcome")).agg(F.count(F.lit(1)).alias("pages"))


def quarantine(pages: DataFrame) -> DataFrame:
    """The pages that give no calls because they were refused or cannot be read, with the reason."""
    schemas.LANDED_PAGES.check(pages)
    found = pages.select("event_type", "status_code", "raw", _outcome().alias("outcome"))
    return found.where("outcome <> 'used'")


def _rate(counts: DataFrame, stamp: Column) -> DataFrame:
    return counts.select(
        stamp.alias("timestamp"),
        "total_scheduled_calls",
        "completed_calls",
        completion_share(),
    )


def completion_rate(calls: DataFrame, run_stamp: str) -> DataFrame:
    """Scheduled and completed calls, and the completed share in percent."""
    return _rate(calls.agg(*completion_counts()), F.lit(run_stamp))


class CallFiles(NamedTuple):
    """Folders written; None where there was nothing to write. rejected_pages is a count."""

    calls: str | None
    metrics: str | None
    rejected: str | None
    rejected_pages: int


def read_pages(pages: DataFrame) -> DataFrame:
    """Calls and page outcomes, every page parsed once.

    A row for each call of a usable page, and one for each page without calls. outcome is that of
    the page; is_call tells the two apart; raw is kept of pages that could not be used.
    """
    schemas.LANDED_PAGES.check(pages)
    document = F.when(F.col("status_code") == SUCCESS, parse_document(F.col("raw")))
    read = pages.select("event_type", "status_code", "raw", document.alias("__document"))
    refused = F.coalesce(F.col("status_code") != SUCCESS, F.lit(True))
    outcome = F.when(refused, "refused").when(F.col("__document").isNotNull(), "used").otherwise("unreadable")
    read = read.select(
        F.col("event_type").alias("__of"),
        "status_code",
        F.when(outcome != "used", F.col("raw")).alias("raw"),
        outcome.alias("outcome"),
        F.posexplode_outer(collection(F.col("__document"))).alias("__place", "__element"),
    )
    is_call = F.col("__place").isNotNull()
    fields = [
        F.when(is_call, field_or(F.col("__element"), path, default)).alias(name)
        for name, path, default in CALL_FIELDS
    ]
    return read.select("__of", "status_code", "raw", "outcome", is_call.alias("is_call"), *fields)


def export_calls(pages: DataFrame, out_root: str, run_stamp: str) -> CallFiles:
    """Write the calls and their completion rate as CSV, and the quarantined pages as Parquet.

    The pages are parsed once, into typed columns in the shared folder, which all outputs are
    read from. The two counts behind the rate are taken while the calls are written. The rate is of
    the pages that could be used; how many could not is returned, and which ones is written.
    """
    root = out_root.rstrip("/")
    seen = Observation()
    read = stage(read_pages(pages), "pages").df
    calls = read.where("is_call").select(*(name for name, _, _ in CALL_FIELDS))
    written = write_csv(
        calls, f"{root}/scheduled_calls_{run_stamp}", seen=seen, metrics=completion_counts()
    )
    counts = seen.get if written else {"total_scheduled_calls": 0, "completed_calls": 0}
    one_row = pages.sparkSession.range(1).select(
        *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()]
    )
    rate = write_csv(_rate(one_row, F.lit(run_stamp)), f"{root}/campaign_metrics_{run_stamp}")
    rejected = f"{root}/rejected_pages_{run_stamp}"
    unused = read.where("outcome <> 'used'")
    rows = write_table(unused.select(F.col("__of").alias("event_type"), "status_code", "raw", "outcome"), rejected)
    if rows:
        log.warning("%d pages were refused or could not be read: %s", rows, rejected)
    return CallFiles(written, rate, rejected if rows else None, rows)
