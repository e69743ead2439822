"""Every query by name, with the SQL whose result it must equal."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone_checks import inputs
from siltstone_checks.inputs import as_sql, derive
from siltstone import schemas, session
from siltstone.functions.columns import run_stamp
from siltstone.operators.ordering import in_order
from siltstone.plans import backfill, calls, commerce, gold, jobs, reports, silver, visitor_state
from siltstone.sources import partitions, relational, text
from siltstone.sources.catalog import buckets_for, read_named, write_bucketed
from siltstone.sources.staging import stage

BASE_URL = "https://media.example/medias/"
RUN_STAMP = "2024-03-01_00-00-00"
REWRITTEN_DAY = date(2024, 1, 2)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(fn(session.pin(spark), sf_dir))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock time, the type the given tables use."""
    stamps = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Means of doubles depend on summing order in the last digits."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def with_position(df: DataFrame) -> DataFrame:
    """A sorted report's rows with the place each has in it, in the order they come in."""
    rows = stage(df.withColumn("__came", F.monotonically_increasing_id()), "report").df
    placed = in_order(rows, [F.col("__came")], "positions")
    return placed.withColumnRenamed("rank", "position").drop("__came", "total")


_gold_paths: dict[tuple[str, str, str], str] = {}


def gold_table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A gold table, built by the first report of an application that asks for it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _gold_paths or not session.exists(spark, _gold_paths[key]):
        path = session.scratch_path(spark, name)
        partitions.write_table(build(), path)
        _gold_paths[key] = path
    return partitions.read_table(spark, _gold_paths[key])


# Silver

SQL_EVENTS = as_sql(inputs.EVENTS)
SQL_SILVER_EVENTS = f"""(
SELECT event_key, visitor_key, media_id, media_url, percent_viewed, ip, country,
       TRY_CAST(received_at AS TIMESTAMP) AS received_at,
       TRY_CAST(pipeline_ingested_at_utc AS TIMESTAMP) AS pipeline_ingested_at_utc,
       ingested_date
FROM {SQL_EVENTS})"""


def _silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.events(derive(spark, sf_dir, inputs.EVENTS))


@query(f"SELECT * FROM {SQL_SILVER_EVENTS}")
def silver_events(spark, sf_dir):
    return _silver_events(spark, sf_dir)


SQL_SILVER_MEDIA = f"""(
SELECT hashed_id, name, TRY_CAST(created AS TIMESTAMP) AS created,
       CASE WHEN updated LIKE '%+02:00'
            THEN CAST(replace(updated, '+02:00', '') AS TIMESTAMP) - INTERVAL 2 HOUR
            ELSE CAST(updated AS TIMESTAMP) END AS updated,
       CASE archived WHEN 'true' THEN true WHEN '1' THEN true WHEN 'false' THEN false END AS archived,
       TRY_CAST(duration AS DOUBLE) AS duration, TRY_CAST(progress AS DOUBLE) AS progress,
       TRY_CAST(pipeline_ingested_at_utc AS TIMESTAMP) AS pipeline_ingested_at_utc,
       CAST(coalesce(lower(name) LIKE '%facebook%', false) AS INTEGER) AS facebook,
       CAST(coalesce(lower(name) LIKE '%youtube%', false) AS INTEGER) AS youtube
FROM {as_sql(inputs.MEDIA_DETAILS)})"""


@query(f"SELECT * FROM {SQL_SILVER_MEDIA}")
def silver_media_details(spark, sf_dir):
    return silver.media_details(derive(spark, sf_dir, inputs.MEDIA_DETAILS))


SQL_SILVER_STATS = f"""(
SELECT pipeline_media_id AS media_id, load_count, play_count, play_rate, hours_watched,
       engagement, visitors,
       TRY_CAST(pipeline_ingested_at_utc AS TIMESTAMP) AS pipeline_ingested_at_utc
FROM {as_sql(inputs.MEDIA_STATS)})"""


@query(f"SELECT * FROM {SQL_SILVER_STATS}")
def silver_media_stats(spark, sf_dir):
    return silver.media_stats(derive(spark, sf_dir, inputs.MEDIA_STATS))


@query(
    f"""SELECT visitor_key, load_count, play_count,
           TRY_CAST(created_at AS TIMESTAMP) AS created_at,
           TRY_CAST(last_active_at AS TIMESTAMP) AS last_active_at,
           TRY_CAST(pipeline_ingested_at_utc AS TIMESTAMP) AS pipeline_ingested_at_utc
    FROM {as_sql(inputs.VISITORS)}"""
)
def silver_visitors(spark, sf_dir):
    return silver.visitors(derive(spark, sf_dir, inputs.VISITORS))


# Gold

SQL_TIME = "coalesce(received_at, TIMESTAMP '9999-12-31')"
SQL_DIM_VISITOR = f"""
SELECT visitor_key AS visitor_id,
       first(ip ORDER BY {SQL_TIME}, ip) FILTER (ip IS NOT NULL) AS ip,
       first(country ORDER BY {SQL_TIME}, country) FILTER (country IS NOT NULL) AS country
FROM {SQL_SILVER_EVENTS} WHERE visitor_key IS NOT NULL GROUP BY visitor_key"""


@query(SQL_DIM_VISITOR)
def gold_dim_visitor(spark, sf_dir):
    return gold.dim_visitor(_silver_events(spark, sf_dir))


@query(SQL_DIM_VISITOR)
def gold_dim_visitor_by_date(spark, sf_dir):
    """The same dimension, merged from one batch of rows per date."""
    events = _silver_events(spark, sf_dir)
    path = session.scratch_path(spark, "visitor_first_seen")
    batches = gold.visitor_first_seen(events, "ingested_date")
    partitions.write_dates(batches, path)
    return gold.merge_first_seen(partitions.read_table(spark, path))


@query(SQL_DIM_VISITOR)
def gold_dim_visitor_by_bucket(spark, sf_dir):
    """The same dimension after a run for each of three dates, the second of which ran with wrong rows first."""
    root = session.scratch_path(spark, "visitor_state")
    events = _silver_events(spark, sf_dir)
    dated = F.pmod(F.unix_date("ingested_date"), F.lit(3))
    wrong = events.where(dated == 2).withColumns({"received_at": F.lit("1999-01-01").cast("timestamp"), "ip": F.lit("0")})
    for i, rows in ((0, events.where(dated == 0)), (1, wrong), (2, events.where(dated == 2)), (1, events.where(dated == 1))):
        visitor_state.update(spark, root, rows, REWRITTEN_DAY + timedelta(days=i), buckets=16)
    return visitor_state.dimension(spark, root)


@query(f"SELECT * FROM {SQL_SILVER_STATS}")
def gold_fact_media(spark, sf_dir):
    return gold.fact_media(silver.media_stats(derive(spark, sf_dir, inputs.MEDIA_STATS)))


def _sql_fact_visitor(visitors: str) -> str:
    return f"""
    SELECT e.visitor_key AS visitor_id, event_key AS event_id, percent_viewed,
           load_count, play_count, pipeline_ingested_at_utc
    FROM {SQL_SILVER_EVENTS} e LEFT JOIN
         (SELECT visitor_key, load_count, play_count FROM {visitors}) v
         ON e.visitor_key = v.visitor_key"""


@query(_sql_fact_visitor(as_sql(inputs.VISITORS)))
def gold_fact_visitor(spark, sf_dir):
    visitors = silver.visitors(derive(spark, sf_dir, inputs.VISITORS))
    return gold.fact_visitor(_silver_events(spark, sf_dir), visitors)


@query(_sql_fact_visitor(as_sql(inputs.VISITORS_REPEATED)))
def gold_fact_visitor_fanout(spark, sf_dir):
    visitors = derive(spark, sf_dir, inputs.VISITORS_REPEATED)
    return gold.fact_visitor(_silver_events(spark, sf_dir), visitors)


@query(_sql_fact_visitor(as_sql(inputs.VISITORS_HOT)))
def gold_fact_visitor_hot_key(spark, sf_dir):
    """A key that is hot among the visitors, with a salt for every hundred of its rows."""
    visitors = derive(spark, sf_dir, inputs.VISITORS_HOT)
    return gold.fact_visitor(_silver_events(spark, sf_dir), visitors, rows_per_salt=100)


@query(
    f"""SELECT m.hashed_id AS media_id, m.* EXCLUDE (hashed_id),
           CASE WHEN u.url IS NULL OR trim(u.url) = '' THEN '{BASE_URL}' || m.hashed_id
                ELSE u.url END AS url
    FROM {SQL_SILVER_MEDIA} m LEFT JOIN (
        SELECT media_id, first(media_url ORDER BY {SQL_TIME}, media_url) AS url
        FROM {SQL_SILVER_EVENTS} WHERE media_url IS NOT NULL GROUP BY media_id) u
    ON m.hashed_id = u.media_id"""
)
def gold_media_details(spark, sf_dir):
    media = silver.media_details(derive(spark, sf_dir, inputs.MEDIA_DETAILS))
    return gold.media_details(media, _silver_events(spark, sf_dir), BASE_URL)


# Reading and writing


@query(
    f"""SELECT event_key, visitor_key, received_at, ingested_date,
           CASE WHEN ingested_date = DATE '{REWRITTEN_DAY}' THEN 0.0 ELSE percent_viewed END
               AS percent_viewed
    FROM {SQL_SILVER_EVENTS}
    WHERE ingested_date <> DATE '{REWRITTEN_DAY}' OR visitor_key IS NOT NULL"""
)
def partition_overwrite_roundtrip(spark, sf_dir):
    """Every date is written, one of them again with other rows, then all are read."""
    root = session.scratch_path(spark, "events")
    columns = ["event_key", "visitor_key", "received_at", "percent_viewed", "ingested_date"]
    partitions.write_dates(_silver_events(spark, sf_dir).select(*columns), root)
    day = partitions.read_partition(spark, root, REWRITTEN_DAY)
    rewritten = stage(
        day.where("visitor_key IS NOT NULL").withColumn("percent_viewed", F.lit(0.0)), "day"
    )
    partitions.write_partition(rewritten.df, root, REWRITTEN_DAY)
    return partitions.read_table(spark, root).select(*columns)


@query(
    f"""SELECT event_key, visitor_key, media_id, media_url, percent_viewed, ip,
           CASE WHEN ingested_date <> DATE '{REWRITTEN_DAY}' THEN country END AS country,
           received_at, pipeline_ingested_at_utc, ingested_date
    FROM {SQL_SILVER_EVENTS}"""
)
def dates_with_an_added_column(spark, sf_dir):
    """One date was written before the table had all its columns; the read keeps them."""
    root = session.scratch_path(spark, "events")
    events = _silver_events(spark, sf_dir)
    partitions.write_dates(events.where(F.col("ingested_date") != F.lit(REWRITTEN_DAY)), root)
    early = events.where(F.col("ingested_date") == F.lit(REWRITTEN_DAY)).drop("country")
    partitions.write_partition(early, root, REWRITTEN_DAY)
    return partitions.read_table(spark, root, schemas.SILVER_EVENTS)


@query(
    f"""SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
           CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus,
           CAST(DATE '{REWRITTEN_DAY}' + CAST(o_orderkey % 3 AS INTEGER) AS DATE) AS ingested_date
    FROM orders"""
)
def dates_of_several_schemas(spark, sf_dir):
    """Three dates: narrower numbers and a column less in the first, and one rewritten with wider ones."""
    root = session.scratch_path(spark, "orders")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    orders = orders.select(*columns[:2], F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderstatus")
    for i in (2, 0, 1):
        day = orders.where(F.col("o_orderkey") % 3 == i)
        narrow = day.drop("o_orderstatus").withColumn("o_custkey", F.col("o_custkey").cast("int"))
        partitions.write_partition(narrow if i != 1 else day, root, REWRITTEN_DAY + timedelta(days=i))
    partitions.write_partition(orders.where("o_orderkey % 3 = 2"), root, REWRITTEN_DAY + timedelta(days=2))
    return partitions.read_table(spark, root).select(*columns, "ingested_date")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS stamp FROM events")
def run_stamps(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", run_stamp(F.col("ts").cast("timestamp")).alias("stamp"))


@query(
    f"""SELECT 'silver_events' AS job, count(*) AS rows_in, count(*) AS rows_out,
           'struct<event_key:string,visitor_key:string,media_id:string,media_url:string,percent_viewed:double,'
           || 'ip:string,country:string,received_at:timestamp,pipeline_ingested_at_utc:timestamp>' AS "schema"
    FROM {SQL_EVENTS} WHERE ingested_date = DATE '{REWRITTEN_DAY}'
    UNION ALL
    SELECT 'dim_visitor', count(*), count(DISTINCT visitor_key),
           'struct<visitor_id:string,ip:string,country:string>'
    FROM {SQL_EVENTS} WHERE ingested_date = DATE '{REWRITTEN_DAY}'"""
)
def job_reports(spark, sf_dir):
    """What two jobs say of a run over one date of a lake made from the events."""
    root = session.scratch_path(spark, "lake")
    events = derive(spark, sf_dir, inputs.EVENTS)
    of_day = events.where(F.col("ingested_date") == F.lit(REWRITTEN_DAY))
    partitions.write_partition(of_day, f"{root}/bronze/events", REWRITTEN_DAY)
    found = [jobs.run(spark, name, root, REWRITTEN_DAY) for name in ("silver_events", "dim_visitor")]
    rows = [(r.job, sum(r.rows_in.values()), r.rows_out, r.schema) for r in found]
    return spark.createDataFrame(rows, "job string, rows_in long, rows_out long, schema string")


@query(
    f"""SELECT attempt, ingested_date, count(*) AS rows_out
    FROM {SQL_EVENTS}, (VALUES ('first'), ('second'), ('third')) AS attempts(attempt)
    WHERE CASE attempt WHEN 'first' THEN ingested_date <> DATE '{REWRITTEN_DAY}' + 1
                       WHEN 'second' THEN ingested_date BETWEEN DATE '{REWRITTEN_DAY}' AND DATE '{REWRITTEN_DAY}' + 1
                            AND (visitor_key IS NOT NULL OR ingested_date <> DATE '{REWRITTEN_DAY}')
                       ELSE false END
    GROUP BY 1, 2"""
)
def backfill_runs(spark, sf_dir):
    """What three backfills run: all dates there; then a changed and a late one; then none."""
    root = session.scratch_path(spark, "lake")
    events = derive(spark, sf_dir, inputs.EVENTS)
    late = REWRITTEN_DAY + timedelta(days=1)
    partitions.write_dates(events.where(F.col("ingested_date") != F.lit(late)), f"{root}/bronze/events")
    found = [("first", backfill.backfill(spark, "silver_events", root))]
    day = events.where(F.col("ingested_date") == F.lit(REWRITTEN_DAY)).where("visitor_key IS NOT NULL")
    partitions.write_partition(day, f"{root}/bronze/events", REWRITTEN_DAY)
    partitions.write_partition(events.where(F.col("ingested_date") == F.lit(late)), f"{root}/bronze/events", late)
    found += [(attempt, backfill.backfill(spark, "silver_events", root)) for attempt in ("second", "third")]
    rows = [(attempt, day, report.rows_out) for attempt, runs in found for day, report in runs.items()]
    return spark.createDataFrame(rows, "attempt string, ingested_date date, rows_out long")


@query(
    f"""SELECT true AS of_today, event_key, visitor_key FROM {SQL_EVENTS} WHERE ingested_date = DATE '{REWRITTEN_DAY}'"""
)
def run_without_a_date(spark, sf_dir):
    """A run without a date reads and writes the folder of today in UTC."""
    root = session.scratch_path(spark, "lake")
    events = derive(spark, sf_dir, inputs.EVENTS)
    today = partitions.run_date()
    of_day = events.where(F.col("ingested_date") == F.lit(REWRITTEN_DAY))
    partitions.write_partition(of_day, f"{root}/bronze/events", today)
    jobs.run(spark, "silver_events", root, today)
    age = F.datediff(F.current_date(), F.col("ingested_date"))  # 1 if midnight has passed
    written = partitions.read_table(spark, f"{root}/silver/events")
    return written.select(age.between(0, 1).alias("of_today"), "event_key", "visitor_key")


@query("SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def table_overwrite_roundtrip(spark, sf_dir):
    """A whole table is written, then replaced by other rows."""
    root = session.scratch_path(spark, "orders")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    partitions.write_table(orders, root)
    partitions.write_table(orders.where("o_orderstatus <> 'P'"), root)
    return partitions.read_table(spark, root)


@query(f"SELECT * FROM {as_sql(inputs.PADDED_CUSTOMERS)}")
def csv_roundtrip(spark, sf_dir):
    customer = derive(spark, sf_dir, inputs.PADDED_CUSTOMERS)
    path = text.write_csv(customer, session.scratch_path(spark, "customer"))
    return text.read_csv(spark, path, customer.schema)


@query(
    """SELECT 'customer' AS "table", 'ok' AS status, count(*) AS rows, false AS has_error FROM customer
    UNION ALL SELECT 'orders', 'ok', count(*), false FROM orders
    UNION ALL SELECT 'no_such_table', 'failed', NULL, true
    UNION ALL SELECT 'lineitem', 'ok', count(*), false FROM lineitem"""
)
def ingest_status(spark, sf_dir):
    """Tables are copied side by side; the one that cannot be read does not stop the rest."""
    status = relational.extract_tables(
        spark,
        ["customer", "orders", "no_such_table", "lineitem"],
        lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"),
        session.scratch_path(spark, "bronze"),
        raise_on_failure=False,
    )
    return status.select("table", "status", "rows", F.col("error").isNotNull().alias("has_error"))


@query("SELECT * FROM lineitem")
def catalog_scan(spark, sf_dir):
    """A table by its name in the catalog."""
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").createOrReplaceTempView("named_lineitem")
    return read_named(spark, "named_lineitem")


# Scheduled calls

SQL_USED_ORDERS = """(
SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'
  AND NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'))"""
SQL_CALLS = f"""(
SELECT 'call-' || o_orderkey AS event_id,
       '  type-' || o_orderpriority || chr(10) || 'second line ' AS event_type,
       strftime(o_orderdate, '%Y-%m-%dT09:00:00Z') AS start_time,
       CASE o_orderpriority WHEN '1-URGENT' THEN '' END AS end_time,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active' ELSE 'canceled' END AS status,
       CASE o_orderstatus WHEN 'F' THEN 'c' || o_custkey || '@x.example' WHEN 'P' THEN 'N/A' END
           AS invitee_email
FROM {SQL_USED_ORDERS}
UNION ALL
SELECT 'next-' || o_orderkey, '', '', '', 'N/A', 'N/A' FROM {SQL_USED_ORDERS})"""


def _call_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, inputs.CALL_PAGES)


@query(f"SELECT * FROM {SQL_CALLS}")
def calls_flatten(spark, sf_dir):
    return calls.flatten_calls(_call_pages(spark, sf_dir))


@query(
    """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'refused'
                WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'unreadable'
                ELSE 'used' END AS outcome, count(*) AS pages
    FROM orders GROUP BY 1"""
)
def calls_page_outcomes(spark, sf_dir):
    return calls.page_outcomes(_call_pages(spark, sf_dir))


@query(
    """SELECT 'type-' || p_partkey AS uri FROM part WHERE p_brand <> 'Brand#7'
    UNION ALL SELECT p_name FROM part WHERE p_brand <> 'Brand#7'"""
)
def calls_event_types(spark, sf_dir):
    return calls.identifiers(derive(spark, sf_dir, inputs.TYPE_PAGES))


@query(
    """SELECT c_name AS event_type,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN ''
                WHEN c_mktsegment <> 'FURNITURE' THEN 'org-' || c_mktsegment END AS organization
    FROM customer WHERE c_acctbal >= 0"""
)
def calls_organizations(spark, sf_dir):
    return calls.organizations(derive(spark, sf_dir, inputs.ORGANIZATION_PAGES))


SQL_RATE = f"""
SELECT '{RUN_STAMP}' AS "timestamp", count(*) AS total_scheduled_calls,
       count(*) FILTER (status = 'completed') AS completed_calls,
       round_even(count(*) FILTER (status = 'completed') / count(*) * 100, 2)
           AS completed_calls_percentage
FROM {SQL_CALLS}"""


@query(SQL_RATE)
def calls_completion_rate(spark, sf_dir):
    return calls.completion_rate(calls.flatten_calls(_call_pages(spark, sf_dir)), RUN_STAMP)


CSV_CALLS = T.StructType([T.StructField(f[0], T.StringType()) for f in calls.CALL_FIELDS])
CSV_RATE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("total_scheduled_calls", T.LongType()),
        T.StructField("completed_calls", T.LongType()),
        T.StructField("completed_calls_percentage", T.DoubleType()),
    ]
)


@query(
    f"""SELECT event_id, nullif(event_type, '') AS event_type, nullif(start_time, '') AS start_time,
           nullif(end_time, '') AS end_time, status, invitee_email FROM {SQL_CALLS}"""
)
def calls_export(spark, sf_dir):
    """The calls as read back from the CSV export, where empty text and NULL are one."""
    root = session.scratch_path(spark, "calls")
    written = calls.export_calls(_call_pages(spark, sf_dir), root, RUN_STAMP)
    return text.read_csv(spark, written.calls, CSV_CALLS)


@query(SQL_RATE)
def calls_export_metrics(spark, sf_dir):
    """The completion rate as read back from the CSV export."""
    root = session.scratch_path(spark, "calls")
    written = calls.export_calls(_call_pages(spark, sf_dir), root, RUN_STAMP)
    return text.read_csv(spark, written.metrics, CSV_RATE)


@query(
    f"""SELECT event_type, status_code, raw,
           CASE WHEN status_code <> 200 THEN 'refused' ELSE 'unreadable' END AS outcome
    FROM {as_sql(inputs.CALL_PAGES)} WHERE status_code <> 200 OR raw = '{{"collection":['"""
)
def calls_quarantine(spark, sf_dir):
    """The pages that the export set apart, as it wrote them."""
    root = session.scratch_path(spark, "calls")
    written = calls.export_calls(_call_pages(spark, sf_dir), root, RUN_STAMP)
    return partitions.read_table(spark, written.rejected)


@query(
    f"""SELECT '{RUN_STAMP}' AS "timestamp", count(*) FILTER (o_orderkey IS NULL) AS total_scheduled_calls,
           count(*) FILTER (o_orderkey IS NULL) AS completed_calls,
           CAST(0 AS DOUBLE) AS completed_calls_percentage
    FROM orders"""
)
def calls_export_of_nothing(spark, sf_dir):
    """Every page was refused: no calls file is left, and the rate is 0."""
    root = session.scratch_path(spark, "calls")
    refused = _call_pages(spark, sf_dir).withColumn("status_code", F.lit(500))
    written = calls.export_calls(refused, root, RUN_STAMP)
    if written.calls is not None:
        raise AssertionError("a file of no calls was written")
    return text.read_csv(spark, written.metrics, CSV_RATE)


# Customer lifetime value

def _sql_clv_totals(orders: str) -> str:
    # By way of text, a decimal of any size becomes the nearest double.
    return f"""(
SELECT customer_id, c_mktsegment AS currency,
       CAST(CAST(sum(amount) AS VARCHAR) AS DOUBLE) AS total_spend,
       count(DISTINCT order_id) AS total_orders,
       date_diff('day', min(order_date), max(order_date)) AS customer_lifespan_days
FROM {as_sql(orders)} LEFT JOIN customer ON customer_id = c_custkey GROUP BY 1, 2)"""


def _sql_clv(totals: str) -> str:
    return f"""(
SELECT customer_id, total_spend, total_spend / total_orders AS avg_order_value, total_orders,
       CAST(customer_lifespan_days AS INTEGER) AS customer_lifespan_days,
       CASE WHEN total_orders > 1
            THEN customer_lifespan_days / CAST(total_orders - 1 AS DOUBLE) END
           AS avg_days_between_orders,
       currency,
       CASE WHEN total_spend >= (SELECT quantile_cont(total_spend, 2.0 / 3) FROM {totals})
            THEN 'High'
            WHEN total_spend >= (SELECT quantile_cont(total_spend, 1.0 / 3) FROM {totals})
            THEN 'Medium' ELSE 'Low' END AS clv_segment
FROM {totals})"""


SQL_CLV = _sql_clv(_sql_clv_totals(inputs.CLV_ORDERS))


def _clv_from(spark: SparkSession, sf_dir: str, orders: str) -> DataFrame:
    return commerce.customer_lifetime_value(
        derive(spark, sf_dir, orders), derive(spark, sf_dir, inputs.CLV_CUSTOMERS)
    )


def _clv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table that the reports read."""
    return gold_table(spark, sf_dir, "clv", lambda: _clv_from(spark, sf_dir, inputs.CLV_ORDERS))


@query(f"SELECT * FROM {_sql_clv(_sql_clv_totals(inputs.CLV_ORDERS_WIDE))}")
def clv_table(spark, sf_dir):
    """Amounts of many decimals and of very many digits among the orders."""
    return _clv_from(spark, sf_dir, inputs.CLV_ORDERS_WIDE)


@query(f"SELECT * FROM {SQL_CLV}")
def clv_table_narrowed(spark, sf_dir):
    """The table of plain amounts, which the reports read."""
    return _clv_from(spark, sf_dir, inputs.CLV_ORDERS)


def _by_date(spark: SparkSession, lines: DataFrame, day: str, build: Callable[..., DataFrame]) -> DataFrame:
    """The parts of all dates of some lines, dealt over seven dates by an expression.

    One date comes late, after the others, and one is first written with wrong lines and run again.
    """
    root = session.scratch_path(spark, "parts")
    days = [REWRITTEN_DAY + timedelta(days=i) for i in range(7)]
    dated = lines.withColumn("ingested_date", F.expr(f"date_add(date'{days[0]}', cast({day} as int))"))
    late, again = days[2], days[4]
    early = dated.where(F.col("ingested_date") != F.lit(late))
    wrong = F.when(F.col("ingested_date") == F.lit(again), F.lit(days[5])).otherwise(F.col("ingested_date"))
    mistaken = dated.where(F.col("ingested_date").isin(days[3], days[4])).withColumn("ingested_date", F.lit(again))
    with session.small_tasks(spark):
        partitions.write_dates(build(mistaken, "ingested_date"), root)
        partitions.write_dates(build(early.withColumn("ingested_date", wrong), "ingested_date"), root)
        rerun = dated.where(F.col("ingested_date").isin(days[4], days[5]))
        partitions.write_dates(build(rerun, "ingested_date"), root)
        partitions.write_partition(build(dated.where(F.col("ingested_date") == F.lit(late)).drop("ingested_date")), root, late)
    return partitions.read_table(spark, root).drop("ingested_date")


@query(f"SELECT * FROM {_sql_clv(_sql_clv_totals(inputs.CLV_ORDERS_WIDE))}")
def clv_table_by_date(spark, sf_dir):
    """The same table from the parts of each date, with a late date and one run again."""
    orders = derive(spark, sf_dir, inputs.CLV_ORDERS_WIDE)
    parts = _by_date(spark, orders, "order_id % 7", commerce.order_parts)
    return commerce.customers_from_parts(parts, derive(spark, sf_dir, inputs.CLV_CUSTOMERS))


@query(
    f"""SELECT count(*) AS total_customers, round(sum(total_spend), 2) AS total_revenue,
           round(avg(avg_order_value), 4) AS avg_order_value,
           round(avg(customer_lifespan_days), 4) AS avg_customer_lifespan_days
    FROM {SQL_CLV}"""
)
def clv_kpis(spark, sf_dir):
    kpis = reports.clv_kpis(_clv(spark, sf_dir))
    return rounded(kpis, total_revenue=2, avg_order_value=4, avg_customer_lifespan_days=4)


@query(f'SELECT clv_segment, count(*) AS "count" FROM {SQL_CLV} GROUP BY 1')
def clv_segment_counts(spark, sf_dir):
    return reports.clv_segment_counts(_clv(spark, sf_dir))


@query(
    f"""SELECT clv_segment, round(avg(total_spend), 4) AS avg_spend,
           round(avg(total_orders), 4) AS avg_orders,
           round(avg(avg_days_between_orders), 4) AS avg_days
    FROM {SQL_CLV} GROUP BY 1"""
)
def clv_segment_means(spark, sf_dir):
    means = reports.clv_segment_means(_clv(spark, sf_dir))
    return rounded(means, avg_spend=4, avg_orders=4, avg_days=4)


@query(
    f"""SELECT clv_segment, row_number() OVER (ORDER BY avg(total_spend) DESC, clv_segment) - 1 AS "position"
    FROM {SQL_CLV} GROUP BY 1"""
)
def clv_segment_means_order(spark, sf_dir):
    """The order in which the means are shown."""
    return with_position(reports.clv_segment_means(_clv(spark, sf_dir)).select("clv_segment"))


@query(
    f"""SELECT currency, round(sum(total_spend), 2) AS total_revenue
    FROM {SQL_CLV} WHERE currency IS NOT NULL GROUP BY 1"""
)
def clv_revenue_by_currency(spark, sf_dir):
    return rounded(reports.clv_revenue_by_currency(_clv(spark, sf_dir)), total_revenue=2)


@query(f"SELECT DISTINCT clv_segment FROM {SQL_CLV}")
def clv_segments(spark, sf_dir):
    return reports.clv_segments(_clv(spark, sf_dir))


@query(f"SELECT * FROM {SQL_CLV} WHERE clv_segment IN ('High', 'Low') OR clv_segment IS NULL")
def clv_filtered(spark, sf_dir):
    return reports.clv_filtered(_clv(spark, sf_dir), ["High", "Low", None])


# Item options

SQL_OPTIONS = f"""(
SELECT item_name, option_name,
       CAST(sum(CASE WHEN coalesce(removed, false) THEN 0 ELSE quantity END) AS BIGINT) AS total_added_count,
       CAST(sum(CASE WHEN coalesce(removed, false) THEN quantity ELSE 0 END) AS BIGINT) AS total_removed_count
FROM {as_sql(inputs.OPTION_LINES)} l LEFT JOIN {as_sql(inputs.MENU)} m ON l.item_id = m.item_id
GROUP BY 1, 2)"""
SQL_CLEAN = f"""(
SELECT item_name, option_name,
       CAST(trunc(CASE WHEN total_added_count IS NULL OR total_added_count IN ('x', 'nan', '1d') THEN 0
                       ELSE CAST(trim(total_added_count) AS DOUBLE) END) AS BIGINT) AS total_added_count,
       CAST(total_removed_count AS BIGINT) AS total_removed_count
FROM {as_sql(inputs.ITEM_OPTIONS_TEXT, item_options=SQL_OPTIONS)})"""


def _built_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commerce.item_options(
        derive(spark, sf_dir, inputs.OPTION_LINES), derive(spark, sf_dir, inputs.MENU)
    )


def _options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table that the reports read."""
    return gold_table(spark, sf_dir, "options", lambda: _built_options(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = derive(
        spark, sf_dir, inputs.ITEM_OPTIONS_TEXT, item_options=_options(spark, sf_dir)
    )
    return reports.item_options_clean(messy)


@query(f"SELECT * FROM {SQL_OPTIONS}")
def item_options_table(spark, sf_dir):
    return _built_options(spark, sf_dir)


@query(f"SELECT * FROM {SQL_OPTIONS}")
def item_options_by_date(spark, sf_dir):
    """The same table from the parts of each date; an item's lines are in all of them."""
    lines = derive(spark, sf_dir, inputs.OPTION_LINES)
    parts = _by_date(spark, lines, "pmod(xxhash64(item_id, quantity), 7)", commerce.option_parts)
    return commerce.options_from_parts(parts, derive(spark, sf_dir, inputs.MENU))


@query(f"SELECT * FROM {SQL_CLEAN}")
def item_options_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


@query(
    f"""SELECT count(DISTINCT item_name) AS total_menu_items,
           count(DISTINCT option_name) AS total_option_types,
           CAST(sum(total_added_count) AS BIGINT) AS total_options_added
    FROM {SQL_CLEAN}"""
)
def item_options_kpis(spark, sf_dir):
    return reports.item_options_kpis(_clean(spark, sf_dir))


@query(f"SELECT DISTINCT item_name FROM {SQL_CLEAN} WHERE item_name IS NOT NULL")
def item_names(spark, sf_dir):
    return reports.item_names(_clean(spark, sf_dir))


@query(
    f"""SELECT item_name, row_number() OVER (ORDER BY item_name) - 1 AS "position"
    FROM (SELECT DISTINCT item_name FROM {SQL_CLEAN} WHERE item_name IS NOT NULL)"""
)
def item_names_order(spark, sf_dir):
    """The order in which the items are listed."""
    return with_position(reports.item_names(_clean(spark, sf_dir)))


SQL_FIRST_ITEM = f"item_name = (SELECT min(item_name) FROM {SQL_CLEAN})"


@query(f"SELECT * FROM {SQL_CLEAN} WHERE {SQL_FIRST_ITEM}")
def item_options_for_item(spark, sf_dir):
    return reports.item_options_for_item(_clean(spark, sf_dir))


@query(
    f"""SELECT item_name, option_name, total_added_count FROM {SQL_CLEAN}
    WHERE {SQL_FIRST_ITEM} ORDER BY total_added_count DESC, option_name LIMIT 10"""
)
def item_top_added(spark, sf_dir):
    return reports.item_top_added(_clean(spark, sf_dir))


@query(
    f"""SELECT item_name, option_name, total_removed_count FROM {SQL_CLEAN}
    WHERE {SQL_FIRST_ITEM} ORDER BY total_removed_count DESC, option_name LIMIT 10"""
)
def item_top_removed(spark, sf_dir):
    return reports.item_top_removed(_clean(spark, sf_dir))


def _sql_options_top(count: str) -> str:
    return f"""SELECT option_name, CAST(sum({count}) AS BIGINT) AS {count} FROM {SQL_CLEAN}
    WHERE option_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""


@query(_sql_options_top("total_added_count"))
def options_top_added(spark, sf_dir):
    return reports.options_top_added(_clean(spark, sf_dir))


@query(_sql_options_top("total_removed_count"))
def options_top_removed(spark, sf_dir):
    return reports.options_top_removed(_clean(spark, sf_dir))


# Top performing locations

def _sql_locations(lines: str) -> str:
    return f"""(
SELECT CAST(rank() OVER (PARTITION BY currency ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank,
       restaurant_id, currency, total_revenue, total_revenue / total_orders AS avg_order_value,
       total_orders, total_orders / nullif(CAST(days AS DOUBLE), 0) AS avg_daily_orders,
       total_orders / nullif(CAST(weeks AS DOUBLE), 0) AS avg_weekly_orders
FROM (SELECT l.restaurant_id, currency, CAST(CAST(sum(revenue) AS VARCHAR) AS DOUBLE) AS total_revenue,
             count(DISTINCT l.order_id) AS total_orders, count(DISTINCT order_date) AS days,
             count(DISTINCT date_trunc('week', order_date)) AS weeks
      FROM {as_sql(lines)} l
      LEFT JOIN {as_sql(inputs.ORDER_DATES)} o ON l.order_id = o.order_id
      LEFT JOIN {as_sql(inputs.RESTAURANTS)} r ON l.restaurant_id = r.restaurant_id
      GROUP BY 1, 2))"""


SQL_LOCATIONS = _sql_locations(inputs.ORDER_LINES)
SQL_FIRST_CURRENCY = f"currency = (SELECT min(r_name) FROM {as_sql('SELECT * FROM region')})"


def _locations_from(spark: SparkSession, sf_dir: str, lines: str) -> DataFrame:
    return commerce.top_performing_locations(
        derive(spark, sf_dir, lines),
        derive(spark, sf_dir, inputs.ORDER_DATES),
        derive(spark, sf_dir, inputs.RESTAURANTS),
    )


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table that the reports read."""
    return gold_table(
        spark, sf_dir, "locations", lambda: _locations_from(spark, sf_dir, inputs.ORDER_LINES)
    )


@query(f"SELECT * FROM {_sql_locations(inputs.ORDER_LINES_WIDE)}")
def locations_table(spark, sf_dir):
    """Amounts of many decimals and of very many digits among the lines."""
    return _locations_from(spark, sf_dir, inputs.ORDER_LINES_WIDE)


@query(f"SELECT * FROM {SQL_LOCATIONS}")
def locations_table_ranged(spark, sf_dir):
    """The table of plain amounts, which the reports read."""
    return _locations_from(spark, sf_dir, inputs.ORDER_LINES)


@query(f"SELECT * FROM {_sql_locations(inputs.ORDER_LINES_WIDE)}")
def locations_table_by_date(spark, sf_dir):
    """The same table from the parts of each date; the lines of an order are in several of them."""
    lines = derive(spark, sf_dir, inputs.ORDER_LINES_WIDE)
    parts = _by_date(spark, lines, "pmod(order_id + xxhash64(revenue), 7)", commerce.line_parts)
    return commerce.top_performing_locations(
        parts, derive(spark, sf_dir, inputs.ORDER_DATES), derive(spark, sf_dir, inputs.RESTAURANTS)
    )


@query(f"SELECT * FROM {SQL_LOCATIONS}")
def locations_table_bucketed(spark, sf_dir):
    """The same table from order tables of the catalog, bucketed by order, whose lines need no shuffle."""
    buckets = buckets_for(derive(spark, sf_dir, inputs.ORDER_LINES).count())  # of the larger table, for both
    for name, sql in (("order_lines_by_order", inputs.ORDER_LINES), ("order_dates_by_order", inputs.ORDER_DATES)):
        path = session.scratch_path(spark, name)
        with session.small_tasks(spark):
            write_bucketed(derive(spark, sf_dir, sql), name, path, "order_id", buckets)
    return commerce.top_performing_locations(
        read_named(spark, "order_lines_by_order"),
        read_named(spark, "order_dates_by_order"),
        derive(spark, sf_dir, inputs.RESTAURANTS),
    )


@query(
    f"""SELECT revenue_rank, restaurant_id,
           row_number() OVER (ORDER BY revenue_rank, restaurant_id) - 1 AS "position"
    FROM {SQL_LOCATIONS} WHERE currency = 'ASIA'"""
)
def locations_ranking_order(spark, sf_dir):
    """The order in which the ranking is shown."""
    ranking = reports.locations_ranking(_locations(spark, sf_dir), "ASIA")
    return with_position(ranking.select("revenue_rank", "restaurant_id"))


@query(f"SELECT DISTINCT currency FROM {SQL_LOCATIONS}")
def location_currencies(spark, sf_dir):
    return reports.location_currencies(_locations(spark, sf_dir))


@query(
    f"""SELECT count(*) AS total_restaurants, round(sum(total_revenue), 2) AS total_revenue,
           round(avg(avg_order_value), 4) AS avg_order_value,
           round(avg(avg_daily_orders), 6) AS avg_daily_orders
    FROM {SQL_LOCATIONS} WHERE {SQL_FIRST_CURRENCY}"""
)
def locations_kpis(spark, sf_dir):
    kpis = reports.locations_kpis(_locations(spark, sf_dir))
    return rounded(kpis, total_revenue=2, avg_order_value=4, avg_daily_orders=6)


@query(
    f"""SELECT revenue_rank, restaurant_id, total_revenue, avg_order_value, avg_daily_orders
    FROM {SQL_LOCATIONS} WHERE {SQL_FIRST_CURRENCY} ORDER BY revenue_rank, restaurant_id LIMIT 10"""
)
def locations_top10(spark, sf_dir):
    return reports.locations_top10(_locations(spark, sf_dir))


@query(
    f"""SELECT currency, revenue_rank, restaurant_id, total_revenue, avg_order_value, avg_daily_orders
    FROM (SELECT *, row_number() OVER (PARTITION BY currency ORDER BY revenue_rank, restaurant_id) AS place
          FROM {SQL_LOCATIONS} WHERE currency IS NOT NULL) WHERE place <= 10"""
)
def locations_top10_by_currency(spark, sf_dir):
    return reports.locations_top10_by_currency(_locations(spark, sf_dir))


@query(
    f"""SELECT currency, count(*) AS total_restaurants, round(sum(total_revenue), 2) AS total_revenue,
           round(avg(avg_order_value), 4) AS avg_order_value,
           round(avg(avg_daily_orders), 6) AS avg_daily_orders
    FROM {SQL_LOCATIONS} WHERE currency IS NOT NULL GROUP BY currency"""
)
def locations_kpis_by_currency(spark, sf_dir):
    kpis = reports.locations_kpis_by_currency(_locations(spark, sf_dir))
    return rounded(kpis, total_revenue=2, avg_order_value=4, avg_daily_orders=6)


@query(
    f"""SELECT restaurant_id, avg_order_value, total_revenue, total_orders
    FROM {SQL_LOCATIONS} WHERE {SQL_FIRST_CURRENCY}"""
)
def locations_scatter(spark, sf_dir):
    return reports.locations_scatter(_locations(spark, sf_dir))


@query(
    f"""SELECT revenue_rank, restaurant_id, total_revenue, avg_order_value, total_orders,
           avg_daily_orders, avg_weekly_orders
    FROM {SQL_LOCATIONS} WHERE currency = 'ASIA'"""
)
def locations_ranking(spark, sf_dir):
    return reports.locations_ranking(_locations(spark, sf_dir), "ASIA")
