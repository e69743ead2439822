"""Parquet tables, whole or one ingested_date partition at a time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone.schemas import INGESTED_DATE, Contract
from siltstone.sources import schema_history


def run_date(text: str | None = None) -> date:
    """The run's date: as given in ISO form, else today in UTC."""
    if text is None:
        return datetime.now(timezone.utc).date()
    return date.fromisoformat(text)


def partition_path(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{INGESTED_DATE}={day.isoformat()}"


def read_partition(
    spark: SparkSession, root: str, day: date, contract: Contract | None = None
) -> DataFrame:
    """One date of a table, with its ingested_date column.

    Only that date's folder is listed, however many dates the table has, and a date that
    was never written raises PATH_NOT_FOUND instead of giving an empty table. A date is
    written at once, so its files agree; columns it lacks or of another type than the
    contract's fail the read.
    """
    df = spark.read.option("basePath", root).parquet(partition_path(root, day))
    df = df.withColumn(INGESTED_DATE, F.lit(day))
    return contract.check(df) if contract else df


def read_dates(
    spark: SparkSession, root: str, days: Sequence[date], contract: Contract | None = None
) -> DataFrame:
    """Several dates of a table; every one of them must exist."""
    folders = [partition_path(root, day) for day in days]
    df = schema_history.read_dated(spark, root, folders, contract)
    if df is None:  # no date has a file
        df = spark.read.option("basePath", root).parquet(*folders)
    return contract.check(df) if contract else df


def read_table(spark: SparkSession, root: str, contract: Contract | None = None) -> DataFrame:
    """All of a table, every date included.

    Dates are read with the schemas they were written with: a column that a date lacks is
    NULL there, and a narrower number is widened to the widest of the dates or to the
    contract's type. Types that no wider one holds fail the read.
    """
    folders = schema_history.date_folders(spark, root)
    df = schema_history.read_dated(spark, root, folders, contract) if folders else None
    if df is None:
        df = schema_history.read_undated(spark, root)
    return contract.check(df) if contract else df


def counted(df: DataFrame, *more: Column) -> tuple[DataFrame, Observation]:
    """The frame with a row counter, and other metrics, that fill while the frame is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *more), seen


def rows_seen(seen: Observation) -> int:
    """The count, once the frame was written.

    Spark drops the counter along with a join side that it finds to be empty, and the
    metrics it then hands over have no columns, which get() asserts they have.
    """
    try:
        return seen.get["rows"]
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return 0


def write_partition(df: DataFrame, root: str, day: date) -> int:
    """Replace one date of a table and return the rows written; other dates stay.

    Dynamic overwrite stages the new files and swaps them in at commit, so a run that
    fails half-way leaves the old partition readable. It replaces nothing when there are
    no rows, so an empty result empties the date's folder instead.
    """
    checked, seen = counted(df.drop(INGESTED_DATE))
    (
        # Added last, the date is a known constant to the writer, which would else sort by it.
        checked.withColumn(INGESTED_DATE, F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(INGESTED_DATE)
        .parquet(root)
    )
    rows = rows_seen(seen)
    if rows == 0:
        empty = df.sparkSession.createDataFrame([], df.drop(INGESTED_DATE).schema)
        empty.write.mode("overwrite").parquet(partition_path(root, day))
    schema_history.record(df.sparkSession, partition_path(root, day), df.drop(INGESTED_DATE).schema)
    return rows


def write_dates(df: DataFrame, root: str) -> int:
    """Replace every date that the frame holds and return the rows written.

    The rebalance gathers each date in files of the advised size: a large date is split
    over tasks, small ones do not leave one file per task.
    """
    dated, seen = counted(df.hint("rebalance", INGESTED_DATE), F.collect_set(INGESTED_DATE).alias("days"))
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(INGESTED_DATE)
        .parquet(root)
    )
    rows = rows_seen(seen)
    for day in seen.get["days"] if rows else ():
        schema_history.record(df.sparkSession, partition_path(root, day), df.drop(INGESTED_DATE).schema)
    return rows


def write_table(df: DataFrame, root: str, recorded: bool = True) -> int:
    """Replace a whole unpartitioned table and return the rows written."""
    checked, seen = counted(df)
    checked.write.mode("overwrite").parquet(root)
    if recorded:
        schema_history.record(df.sparkSession, root, df.schema)
    return rows_seen(seen)
