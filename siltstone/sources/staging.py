"""Intermediate tables in the shared folder."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from siltstone.session import scratch_path
from siltstone.sources.partitions import write_table


# Rows of a file at least, where a bound of the rows is known: narrow ones, and such as hold
# a text or take a Python function's work.
NARROW_ROWS = 250_000
TEXT_ROWS = 5_000


class Staged(NamedTuple):
    """A frame written to the shared folder and read back, with its row count."""

    df: DataFrame
    rows: int


def in_few(df: DataFrame, most: int, each: int = NARROW_ROWS) -> DataFrame:
    """df, which has most rows at most, in a task for every so many of them, or one for each core."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-most // each)))


def stage(df: DataFrame, name: str, most: int | None = None, each: int = NARROW_ROWS) -> Staged:
    """Write an intermediate once, so that later passes read the same rows.

    Later passes prune columns and push filters into the Parquet scan, and a lost
    executor costs a re-read of files rather than a re-run of the plan above them.

    most, a bound of the rows, keeps a small table from having a file for each shuffle
    partition: where Hadoop has no native library, an executor starts some processes a file.
    """
    if most is not None:
        df = in_few(df, most, each)
    path = scratch_path(df.sparkSession, name)
    rows = write_table(df, path, recorded=False)
    return Staged(df.sparkSession.read.schema(df.schema).parquet(path), rows)
