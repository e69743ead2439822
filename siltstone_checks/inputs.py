"""The layers' input tables, derived from the given ones by SQL that both engines read.

{name} stands for a given table. Nulls, blanks and unreadable text are put in here, as
the given tables have none, and keys are rewritten where rows are to match nothing. Every
input is made from whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# One media per value of props, one visitor per user; user 7 has no key.
EVENTS = """
SELECT CAST(event_id AS STRING) AS event_key,
       nullif(CAST(user_id AS STRING), '7') AS visitor_key,
       concat('m', regexp_extract(props, '[0-9]+', 0)) AS media_id,
       CASE event_type WHEN 'error' THEN NULL
                       WHEN 'signup' THEN ''
                       ELSE concat('https://v.example/', CAST(event_id % 3 AS STRING)) END AS media_url,
       value / 500 AS percent_viewed,
       CASE WHEN event_type = 'click' THEN NULL
            ELSE concat('10.0.0.', CAST(user_id AS STRING)) END AS ip,
       nullif(event_type, 'error') AS country,
       CASE WHEN event_id % 97 = 0 THEN 'nope' ELSE CAST(ts AS STRING) END AS received_at,
       CAST(ts AS STRING) AS pipeline_ingested_at_utc,
       CAST(ts AS DATE) AS ingested_date
FROM {events}
"""

# Every fourth user bears another key and so matches no event.
VISITORS = """
SELECT concat(CASE WHEN user_id % 4 = 0 THEN 'gone-' ELSE '' END, CAST(user_id AS STRING)) AS visitor_key,
       count(*) AS load_count,
       count(CASE WHEN event_type = 'view' THEN 1 END) AS play_count,
       CAST(min(ts) AS STRING) AS created_at,
       CASE WHEN user_id % 10 = 3 THEN 'never' ELSE CAST(max(ts) AS STRING) END AS last_active_at,
       CAST(max(ts) AS STRING) AS pipeline_ingested_at_utc
FROM {events} GROUP BY user_id
"""

# Several rows per visitor, and rows without a key, which must match nothing.
VISITORS_REPEATED = """
SELECT nullif(CAST(user_id AS STRING), '7') AS visitor_key,
       count(*) AS load_count,
       count(CASE WHEN value > 50 THEN 1 END) AS play_count
FROM {events} GROUP BY user_id, event_type
"""

# A third of the rows share one visitor, with many of them equal.
VISITORS_HOT = """
SELECT CASE WHEN user_id % 3 = 0 THEN '13' ELSE CAST(user_id AS STRING) END AS visitor_key,
       count(*) AS load_count,
       count(CASE WHEN value > 50 THEN 1 END) AS play_count
FROM {events} GROUP BY user_id, event_type
"""

MEDIA_DETAILS = """
SELECT concat('m', CAST(p_partkey AS STRING)) AS hashed_id,
       CASE WHEN p_size % 9 = 4 THEN NULL
            ELSE concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' FaceBook ad'
                                                   WHEN 1 THEN ' on YouTube'
                                                   WHEN 2 THEN ' facebook+youtube'
                                                   ELSE '' END) END AS name,
       CASE WHEN p_size = 1 THEN 'nope'
            ELSE concat('2024-01-', lpad(CAST(1 + p_size % 28 AS STRING), 2, '0'),
                        'T03:04:05Z') END AS created,
       CASE WHEN p_size % 3 = 0 THEN concat('2024-02-', lpad(CAST(1 + p_size % 28 AS STRING), 2, '0'))
            ELSE concat('2024-02-', lpad(CAST(1 + p_size % 28 AS STRING), 2, '0'),
                        'T03:04:05.123+02:00') END AS updated,
       CASE p_size % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'maybe'
                       WHEN 3 THEN '1' ELSE NULL END AS archived,
       CASE WHEN p_size % 7 = 0 THEN 'x' ELSE CAST(p_retailprice AS STRING) END AS duration,
       CASE WHEN p_size % 11 = 0 THEN '' ELSE CAST(p_size AS STRING) END AS progress,
       p_brand AS thumbnail,
       p_type AS subfolder,
       p_brand AS project,
       p_type AS share_link,
       p_brand AS assets,
       '2024-03-01 00:00:00' AS pipeline_ingested_at_utc
FROM {part}
"""

MEDIA_STATS = """
SELECT concat('m', CAST(l_partkey AS STRING)) AS pipeline_media_id,
       count(*) AS load_count,
       count(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS play_count,
       count(CASE WHEN l_returnflag <> 'R' THEN 1 END) / CAST(count(*) AS DOUBLE) AS play_rate,
       sum(l_quantity) / 60 AS hours_watched,
       CAST(max(l_discount) AS DOUBLE) AS engagement,
       count(CASE WHEN l_linenumber = 1 THEN 1 END) AS visitors,
       CASE WHEN l_partkey % 13 = 0 THEN 'nope'
            ELSE CAST(max(l_shipdate) AS STRING) END AS pipeline_ingested_at_utc
FROM {lineitem} GROUP BY l_partkey
"""

# One landed page per order. Its second call lacks a status and has a null location.
CALL_PAGES = """
SELECT concat('type-', o_orderpriority) AS event_type,
       CASE WHEN o_orderpriority = '5-LOW' THEN 500 ELSE 200 END AS status_code,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN '{{"collection":['
            ELSE concat(
              '{{"collection":[{{"uri":"call-', CAST(o_orderkey AS STRING),
              '","event_type":"  type-', o_orderpriority, chr(92), 'nsecond line ',
              '","start_time":"', CAST(CAST(o_orderdate AS DATE) AS STRING), 'T09:00:00Z"',
              CASE o_orderpriority WHEN '1-URGENT' THEN '' ELSE ',"end_time":null' END,
              ',"status":"',
              CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active' ELSE 'canceled' END,
              '","location":{{',
              CASE o_orderstatus WHEN 'F' THEN concat('"email":"c', CAST(o_custkey AS STRING), '@x.example"')
                                 WHEN 'O' THEN '"email":null' ELSE '' END,
              '}}}},{{"uri":"next-', CAST(o_orderkey AS STRING), '","location":null}}]}}') END AS raw
FROM {orders}
"""

TYPE_PAGES = """
SELECT p_brand AS event_type,
       CASE p_brand WHEN 'Brand#7' THEN 503 ELSE 200 END AS status_code,
       concat('{{"collection":[{{"uri":"type-', CAST(p_partkey AS STRING),
              '"}},{{"uri":"', p_name, '"}}]}}') AS raw
FROM {part}
"""

ORGANIZATION_PAGES = """
SELECT c_name AS event_type,
       CASE WHEN c_acctbal < 0 THEN 401 ELSE 200 END AS status_code,
       CASE c_mktsegment WHEN 'BUILDING' THEN '{{}}'
                         WHEN 'MACHINERY' THEN '{{"resource":{{}}}}'
                         WHEN 'FURNITURE' THEN '{{"resource":{{"current_organization":null}}}}'
                         ELSE concat('{{"resource":{{"current_organization":"org-', c_mktsegment, '"}}}}') END AS raw
FROM {customer}
"""

CLV_ORDERS = """
SELECT o_custkey AS customer_id, o_orderkey AS order_id,
       CAST(o_totalprice AS DECIMAL(28, 8)) AS amount, CAST(o_orderdate AS DATE) AS order_date
FROM {orders}
"""

# Amounts with digits far behind the point, and amounts that are very large.
CLV_ORDERS_WIDE = """
SELECT o_custkey AS customer_id, o_orderkey AS order_id,
       CAST(o_totalprice AS DECIMAL(28, 8))
         + CASE WHEN o_orderkey % 7 = 0 THEN CAST('0.00004' AS DECIMAL(28, 8))
                WHEN o_custkey % 50 = 1 THEN CAST('1000000000000000' AS DECIMAL(28, 8))
                ELSE CAST('0' AS DECIMAL(28, 8)) END AS amount,
       CAST(o_orderdate AS DATE) AS order_date
FROM {orders}
"""

CLV_CUSTOMERS = """
SELECT c_custkey AS customer_id, c_mktsegment AS currency FROM {customer}
"""

# Every fiftieth item is on no menu; the seventh line of an order has no flag.
OPTION_LINES = """
SELECT CASE WHEN l_partkey % 50 = 0 THEN -l_partkey ELSE l_partkey END AS item_id, l_quantity AS quantity,
       CASE WHEN l_linenumber <> 7 THEN l_returnflag = 'R' END AS removed
FROM {lineitem}
"""

MENU = """
SELECT p_partkey AS item_id, p_name AS item_name, p_brand AS option_name FROM {part}
"""

# The item_options table as a consumer may meet it: counts as text, some unreadable.
ITEM_OPTIONS_TEXT = """
SELECT item_name, option_name,
       CASE total_added_count % 10 WHEN 0 THEN 'x' WHEN 1 THEN NULL WHEN 2 THEN 'nan' WHEN 3 THEN '1d'
            WHEN 4 THEN concat(' ', CAST(total_added_count AS STRING), ' ')
            WHEN 5 THEN concat(CAST(total_added_count AS STRING), '.9')
            WHEN 6 THEN concat('-', CAST(total_added_count AS STRING), '.9')
            WHEN 7 THEN '1e3' ELSE CAST(total_added_count AS STRING) END AS total_added_count,
       CAST(total_removed_count AS STRING) AS total_removed_count
FROM {item_options}
"""

# Lines of every fortieth order have no order row.
ORDER_LINES = """
SELECT CASE WHEN l_orderkey % 40 = 0 THEN -l_orderkey ELSE l_orderkey END AS order_id,
       l_suppkey AS restaurant_id,
       CAST(l_extendedprice AS DECIMAL(14, 2)) * CAST(1 - l_discount AS DECIMAL(5, 4)) AS revenue
FROM {lineitem}
"""

# The same lines, with digits far behind the point and very large amounts.
ORDER_LINES_WIDE = """
SELECT CASE WHEN l_orderkey % 40 = 0 THEN -l_orderkey ELSE l_orderkey END AS order_id,
       l_suppkey AS restaurant_id,
       CAST(l_extendedprice AS DECIMAL(28, 8))
         + CASE WHEN l_orderkey % 7 = 0 THEN CAST('0.00004' AS DECIMAL(28, 8))
                WHEN l_suppkey % 5 = 0 THEN CAST('1000000000000000' AS DECIMAL(28, 8))
                ELSE CAST('0' AS DECIMAL(28, 8)) END AS revenue
FROM {lineitem}
"""

ORDER_DATES = """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date FROM {orders}
"""

# Every seventeenth restaurant has no row under its own number.
RESTAURANTS = """
SELECT CASE WHEN s_suppkey % 17 = 0 THEN -s_suppkey ELSE s_suppkey END AS restaurant_id, r_name AS currency
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

# A whole table with text that starts and ends in white space or holds line breaks and quotes.
PADDED_CUSTOMERS = """
SELECT *, concat('  ', c_name, ' ') AS padded, concat(chr(9), c_name, chr(9)) AS tabbed,
       concat(c_name, chr(10), ' "', c_name, '"', chr(10)) AS several_lines
FROM {customer}
"""


def derive(spark: SparkSession, sf_dir: str, sql: str, **frames: DataFrame) -> DataFrame:
    """An input as a DataFrame over the Parquet tables of sf_dir."""
    names = set(re.findall(r"(?<!\{)\{(\w+)\}", sql)) - frames.keys()
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    return spark.sql(sql, **tables, **frames)


def as_sql(sql: str, **nested: str) -> str:
    """The same input as a subquery over the tables' names."""
    names = set(re.findall(r"(?<!\{)\{(\w+)\}", sql))
    return "(" + sql.strip().format(**{n: nested.get(n, n) for n in names}) + ")"
