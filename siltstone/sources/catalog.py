"""Tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.schemas import Contract

# Most rows of a bucket, which one task reads, on average.
BUCKET_ROWS = 500_000
LEAST_BUCKETS = 16


def read_named(spark: SparkSession, name: str, contract: Contract | None = None) -> DataFrame:
    df = spark.table(name)
    return contract.check(df) if contract else df


def buckets_for(rows: int) -> int:
    """Number of buckets for a table of so many rows, a power of two.

    It grows with the table, so that the task that reads a bucket does not.
    """
    return max(LEAST_BUCKETS, 1 << (-(-rows // BUCKET_ROWS) - 1).bit_length())


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Replace a table of the catalog, its files bucketed by a key and sorted by it in each.

    Queries that group or join by the key first find their rows in place, with no shuffle.
    Tables that are to meet so need the same number of buckets. Rows come to the writer by
    the hash that buckets go by, so that a task holds few buckets and leaves few files; a hot
    key's rows, NULL's too, are shared over tasks and become several files of its bucket.
    A query reads a bucket in one task: choose a key whose groups are small beside the table.
    """
    (
        df.hint("rebalance", buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(name)
    )
