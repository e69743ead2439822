"""The pipeline's jobs: read a date of the layer below, transform, replace the output."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from siltstone import schemas
from siltstone.plans import commerce, gold, silver
from siltstone.schemas import INGESTED_DATE, Contract
from siltstone.sources.partitions import (
    read_partition,
    read_table,
    write_partition,
    write_table,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Report:
    """What a run read and wrote."""

    job: str
    rows_in: dict[str, int]
    rows_out: int
    schema: str


@dataclass(frozen=True)
class Job:
    """Inputs with their contracts, the transform, and the output table."""

    inputs: tuple[tuple[str, Contract], ...]
    transform: Callable[..., DataFrame]
    output: str
    # All dates in, whole table out; else one date in and out.
    whole: bool = False


JOBS = {
    "silver_events": Job(
        (("bronze/events", schemas.BRONZE_EVENTS),), silver.events, "silver/events"
    ),
    "silver_media_details": Job(
        (("bronze/media_details", schemas.BRONZE_MEDIA_DETAILS),),
        silver.media_details,
        "silver/media_details",
    ),
    "silver_media_stats": Job(
        (("bronze/media_stats", schemas.BRONZE_MEDIA_STATS),),
        silver.media_stats,
        "silver/media_stats",
    ),
    "silver_visitors": Job(
        (("bronze/visitors", schemas.BRONZE_VISITORS),), silver.visitors, "silver/visitors"
    ),
    "dim_visitor": Job(
        (("silver/events", schemas.SILVER_EVENTS),),
        gold.dim_visitor,
        "gold/dim_visitor",
        whole=True,
    ),
    "visitor_first_seen": Job(
        (("silver/events", schemas.SILVER_EVENTS),),
        gold.visitor_first_seen,
        "gold/visitor_first_seen",
    ),
    "dim_visitor_from_first_seen": Job(
        (("gold/visitor_first_seen", schemas.VISITOR_FIRST_SEEN),),
        gold.merge_first_seen,
        "gold/dim_visitor",
        whole=True,
    ),
    "fact_media": Job(
        (("silver/media_stats", schemas.SILVER_MEDIA_STATS),), gold.fact_media, "gold/fact_media"
    ),
    "fact_visitor": Job(
        (
            ("silver/events", schemas.SILVER_EVENTS),
            ("silver/visitors", schemas.SILVER_VISITORS),
        ),
        gold.fact_visitor,
        "gold/fact_visitor",
    ),
    "gold_media_details": Job(
        (
            ("silver/media_details", schemas.SILVER_MEDIA_DETAILS),
            ("silver/events", schemas.SILVER_EVENTS),
        ),
        gold.media_details,
        "gold/media_details",
    ),
    "customer_lifetime_value": Job(
        (("bronze/orders", schemas.ORDERS), ("bronze/customers", schemas.CUSTOMERS)),
        commerce.customer_lifetime_value,
        "gold/customer_lifetime_value",
        whole=True,
    ),
    "order_parts": Job((("bronze/orders", schemas.ORDERS),), commerce.order_parts, "gold/order_parts"),
    "customer_lifetime_value_from_parts": Job(
        (("gold/order_parts", schemas.ORDER_PARTS), ("bronze/customers", schemas.CUSTOMERS)),
        commerce.customers_from_parts,
        "gold/customer_lifetime_value",
        whole=True,
    ),
    "option_parts": Job((("bronze/option_lines", schemas.OPTION_LINES),), commerce.option_parts, "gold/option_parts"),
    "item_options_from_parts": Job(
        (("gold/option_parts", schemas.OPTION_PARTS), ("bronze/menu", schemas.MENU)),
        commerce.options_from_parts,
        "gold/item_options",
        whole=True,
    ),
    "line_parts": Job((("bronze/order_lines", schemas.ORDER_LINES),), commerce.line_parts, "gold/line_parts"),
    "top_performing_locations_from_parts": Job(
        (
            ("gold/line_parts", schemas.ORDER_LINES),
            ("bronze/orders", schemas.ORDERS),
            ("bronze/restaurants", schemas.RESTAURANTS),
        ),
        commerce.top_performing_locations,
        "gold/top_performing_locations",
        whole=True,
    ),
    "item_options": Job(
        (("bronze/option_lines", schemas.OPTION_LINES), ("bronze/menu", schemas.MENU)),
        commerce.item_options,
        "gold/item_options",
        whole=True,
    ),
    "top_performing_locations": Job(
        (
            ("bronze/order_lines", schemas.ORDER_LINES),
            ("bronze/orders", schemas.ORDERS),
            ("bronze/restaurants", schemas.RESTAURANTS),
        ),
        commerce.top_performing_locations,
        "gold/top_performing_locations",
        whole=True,
    ),
}


def run(spark: SparkSession, name: str, root: str, day: date, **options: object) -> Report:
    """Run one job below root and return what it read and wrote.

    The input rows are counted from the footers of the files, which reads no column, and
    the output rows while they are written; the transform runs once.
    """
    job = JOBS[name]
    root = root.rstrip("/")
    frames, rows_in = [], {}
    for table, contract in job.inputs:
        path = f"{root}/{table}"
        if job.whole:
            df = read_table(spark, path, contract)
        else:
            df = read_partition(spark, path, day, contract).drop(INGESTED_DATE)
        rows_in[table] = df.count()
        frames.append(df)
    result = job.transform(*frames, **options)
    target = f"{root}/{job.output}"
    rows = write_table(result, target) if job.whole else write_partition(result, target, day)
    report = Report(name, rows_in, rows, result.schema.simpleString())
    log.info("%s", report)
    return report
