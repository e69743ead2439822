"""Copies of relational tables, whole or in parallel slices, with per-table outcome."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Mapping, Sequence

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siltstone.sources.partitions import write_table

log = logging.getLogger(__name__)

# The tables of the relational source.
SOURCE_TABLES = ("date_dim", "order_items", "order_item_options")

# Fixed value: slices of a hash-partitioned read.
HASH_PARTITIONS = 10

STATUS = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows", T.LongType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)


class ExtractFailed(Exception):
    """Raised after all tables were tried; carries the outcome of each."""

    def __init__(self, failed: Sequence[str], status: DataFrame):
        super().__init__(f"tables not extracted: {list(failed)}")
        self.failed = list(failed)
        self.status = status


# How databases name a whole number made from any value; {column} is the quoted column.
HASHES = {
    "sqlserver": "CHECKSUM({column})",
    "postgresql": "HASHTEXT(CAST({column} AS TEXT))",
    "mysql": "CRC32({column})",
    "oracle": "ORA_HASH({column})",
}

# Rows fetched in one round trip unless the properties say otherwise.
FETCH_ROWS = 10_000


def quoted(url: str, column: str) -> str:
    """A column name as the database's own quoting writes it."""
    if url.startswith("jdbc:sqlserver"):
        return "[" + column.replace("]", "]]") + "]"
    mark = "`" if url.startswith("jdbc:mysql") else '"'
    return mark + column.replace(mark, mark * 2) + mark


def hash_predicates(
    url: str, field: str, slices: int = HASH_PARTITIONS, whole_numbers: bool = True
) -> list[str]:
    """Conditions that put each row of a table in exactly one slice.

    Whole numbers are their own hash; other columns take the database's. The remainder is
    taken before the sign is dropped, so the smallest integer does not overflow; rows with a
    NULL key go with slice 0.
    """
    column = value = quoted(url, field)
    if not whole_numbers:
        kind = url.split(":")[1]
        if kind not in HASHES:
            raise ValueError(f"no hash is known for {kind}; slice by a whole-number column")
        value = HASHES[kind].format(column=column)
    remainder = f"{value} % {slices}" if "sqlserver" in url else f"MOD({value}, {slices})"
    rest = [f"ABS({remainder}) = {i}" for i in range(1, slices)]
    return [f"ABS({remainder}) = 0 OR {column} IS NULL", *rest]


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    hash_field: str | None = None,
    slices: int = HASH_PARTITIONS,
) -> DataFrame:
    """A database table over JDBC, in parallel slices if a column is named.

    Without one the table comes through one connection, as nothing says how to cut it.
    """
    options = {"fetchsize": str(FETCH_ROWS)} | dict(properties or {})
    whole = spark.read.jdbc(url, table, properties=options)
    if hash_field is None:
        return whole
    whole_numbers = isinstance(whole.schema[hash_field].dataType, T.IntegralType)
    predicates = hash_predicates(url, hash_field, slices, whole_numbers)
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


#: Tables that are copied side by side.
TABLES_AT_ONCE = 4


def extract_tables(
    spark: SparkSession,
    tables: Sequence[str],
    read: Callable[[str], DataFrame],
    out_root: str,
    raise_on_failure: bool = True,
    at_once: int = TABLES_AT_ONCE,
) -> DataFrame:
    """Copy each table to Parquet, some at once; one that fails does not stop the others.

    Each table is pulled once: its rows are counted while they are written. Spark shares its
    tasks out among the copies, so that a table that comes through one connection does not
    leave the others waiting. After all were tried, a failure raises with the outcome of every
    table, in the order given; good copies stay.
    """

    def copy(table: str) -> tuple[str, str, int | None, str | None]:
        try:
            rows = write_table(read(table), f"{out_root.rstrip('/')}/{table}")
        except Exception as error:
            lines = str(error).splitlines() or [type(error).__name__]
            log.error("%s: %s", table, error)
            return table, "failed", None, lines[0]
        log.info("%s: %d rows", table, rows)
        return table, "ok", rows, None

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        outcome = list(pool.map(inheritable_thread_target(spark)(copy), tables))
    status = spark.createDataFrame(outcome, STATUS)
    failed = [row[0] for row in outcome if row[1] == "failed"]
    if failed and raise_on_failure:
        raise ExtractFailed(failed, status)
    return status
