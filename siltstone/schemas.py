"""Column contracts of the layers, and the check applied when a table is read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

INGESTED_DATE = "ingested_date"

# Fixed values, as are all column names below: columns of the visitor facts and their sources.
FACT_VISITOR = {
    "visitor_id": "visitor_key",
    "event_id": "event_key",
    "percent_viewed": "percent_viewed",
    "load_count": "load_count",
    "play_count": "play_count",
    "pipeline_ingested_at_utc": "pipeline_ingested_at_utc",
}

# The columns of the visitor facts that come from the visitors.
VISITOR_COUNTS = ("load_count", "play_count")


@dataclass(frozen=True)
class Contract:
    """Columns a table must have, and those it may lack.

    types, in DDL form, are given for tables that this project writes itself. Several dates of
    such a table are read with them: a file that lacks a column gives NULL there, and a column
    of another type fails the read.
    """

    table: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    types: str = ""

    @property
    def schema(self) -> T.StructType | None:
        return T.StructType.fromDDL(self.types) if self.types else None

    def check(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.required if c not in df.columns]
        if missing:
            raise ValueError(f"{self.table}: missing columns {missing}; found {df.columns}")
        wanted = {f.name: f.dataType.simpleString() for f in self.schema or ()}
        other = {c: t for c, t in df.dtypes if wanted.get(c, t) != t}
        if other:
            raise ValueError(f"{self.table}: columns of another type: {other}")
        return df


BRONZE_EVENTS = Contract(
    "bronze events",
    (
        "event_key",
        "visitor_key",
        "media_id",
        "media_url",
        "percent_viewed",
        "ip",
        "country",
        "received_at",
        "pipeline_ingested_at_utc",
    ),
)

BRONZE_MEDIA_DETAILS = Contract(
    "bronze media_details",
    (),
    (
        "hashed_id",
        "name",
        "created",
        "updated",
        "archived",
        "duration",
        "progress",
        "thumbnail",
        "subfolder",
        "project",
        "share_link",
        "assets",
        "pipeline_ingested_at_utc",
    ),
)

BRONZE_MEDIA_STATS = Contract(
    "bronze media_stats",
    ("pipeline_media_id", "pipeline_ingested_at_utc"),
    ("load_count", "play_count", "play_rate", "hours_watched", "engagement", "visitors"),
)

BRONZE_VISITORS = Contract(
    "bronze visitors",
    ("visitor_key", "created_at", "last_active_at", "pipeline_ingested_at_utc"),
    ("load_count", "play_count"),
)

SILVER_EVENTS = Contract(
    "silver events",
    BRONZE_EVENTS.required,
    types="event_key string, visitor_key string, media_id string, media_url string, "
    "percent_viewed double, ip string, country string, received_at timestamp, "
    "pipeline_ingested_at_utc timestamp, ingested_date date",
)

SILVER_MEDIA_DETAILS = Contract("silver media_details", ("hashed_id",))

SILVER_MEDIA_STATS = Contract(
    "silver media_stats",
    (
        "media_id",
        "load_count",
        "play_count",
        "play_rate",
        "hours_watched",
        "engagement",
        "visitors",
        "pipeline_ingested_at_utc",
    ),
)

SILVER_VISITORS = Contract("silver visitors", ("visitor_key", "load_count", "play_count"))

VISITOR_FIRST_SEEN = Contract(
    "visitor_first_seen",
    ("visitor_key", "ip", "country"),
    types="visitor_key string, ip struct<at: timestamp, value: string>, "
    "country struct<at: timestamp, value: string>, ingested_date date",
)

LANDED_PAGES = Contract("landed pages", ("event_type", "status_code", "raw"))

ORDERS = Contract("orders", ("customer_id", "order_id", "amount", "order_date"))

ORDER_PARTS = Contract("order_parts", ("customer_id", "order_id", "spend", "first_date", "last_date"))

OPTION_PARTS = Contract("option_parts", ("item_id", "added", "gone"))

CUSTOMERS = Contract("customers", ("customer_id", "currency"))

OPTION_LINES = Contract("option_lines", ("item_id", "quantity", "removed"))

MENU = Contract("menu", ("item_id", "item_name", "option_name"))

ORDER_LINES = Contract("order_lines", ("order_id", "restaurant_id", "revenue"))

RESTAURANTS = Contract("restaurants", ("restaurant_id", "currency"))

CUSTOMER_LIFETIME_VALUE = Contract(
    "customer_lifetime_value",
    (
        "total_spend",
        "avg_order_value",
        "customer_lifespan_days",
        "clv_segment",
        "total_orders",
        "avg_days_between_orders",
        "currency",
    ),
)

ITEM_OPTIONS = Contract(
    "item_options",
    ("item_name", "option_name", "total_added_count", "total_removed_count"),
)

TOP_PERFORMING_LOCATIONS = Contract(
    "top_performing_locations",
    (
        "revenue_rank",
        "restaurant_id",
        "currency",
        "total_revenue",
        "avg_order_value",
        "total_orders",
        "avg_daily_orders",
        "avg_weekly_orders",
    ),
)
