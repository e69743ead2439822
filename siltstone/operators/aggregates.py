"""Grouped and global aggregates with stated null and NaN rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import percent, round_percent, skip_nan

# Fixed value: the time that rows without one are sorted at, after all others.
LAST_TIME = "9999-12-31 00:00:00"

# Fixed value: the call status that counts as completed.
COMPLETED = "completed"


def earliest_known(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    time: str,
    values_repeat: bool = False,
) -> DataFrame:
    """Per key and column, the earliest non-null value with its time, as (at, value).

    Rows without a time come after all others, and of values at the same time the
    smallest is taken, so the result does not depend on row order. Columns are looked at
    one by one: their values may come from different rows. The results of several batches
    merge with merge_known.

    Comparing text makes Spark sort each task's rows by key. Where a key's rows mostly
    repeat the same values, values_repeat first shrinks them to one per combination with
    its first time; that step hashes, as it keeps only a number. Where they do not, it
    would only move all rows once more.
    """
    at = F.coalesce(F.col(time), F.lit(LAST_TIME).cast("timestamp"))
    if values_repeat:
        df = df.groupBy(*keys, *columns).agg(F.min(at).alias("__at"))
        at = F.col("__at")
    known = [
        F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("value")))
        for c in columns
    ]
    return df.groupBy(*keys).agg(
        *[F.min(k).alias(c) for k, c in zip(known, columns, strict=True)]
    )


def merge_known(batches: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key out of the results of earliest_known for several batches."""
    return batches.groupBy(*keys).agg(*[F.min(c).alias(c) for c in columns])


def known_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values alone, without their times."""
    return df.withColumns({c: F.col(c)["value"] for c in columns})


def mean(c: Column) -> Column:
    return F.avg(skip_nan(c))


def total(c: Column) -> Column:
    """Sum where an all-null group is 0."""
    return F.coalesce(F.sum(skip_nan(c)), F.lit(0.0))


def total_count(c: Column) -> Column:
    """Sum of whole numbers where an all-null group is 0."""
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def group_by_known(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """Group rows that have a key; rows with a NULL key belong to no group."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggregates)


def completion_counts() -> Sequence[Column]:
    """All calls and completed calls, in one pass."""
    return (
        F.count(F.lit(1)).alias("total_scheduled_calls"),
        F.count_if(F.col("status") == COMPLETED).alias("completed_calls"),
    )


def completion_share() -> Column:
    """Completed share in percent from the two counts; 0 without calls."""
    share = percent(F.col("completed_calls"), F.col("total_scheduled_calls"))
    return round_percent(share).alias("completed_calls_percentage")
