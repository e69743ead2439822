"""CSV output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from siltstone.session import remove
from siltstone.sources.partitions import counted, rows_seen

# Quotes doubled inside quoted fields, white space kept; NULL and empty text are both written
# as nothing.
FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
EMPTY = {"nullValue": "", "emptyValue": ""}


def write_csv(
    df: DataFrame,
    path: str,
    seen: Observation | None = None,
    metrics: Sequence[Column] = (),
) -> str | None:
    """Write with a header and return the path; a frame without rows leaves nothing.

    Aggregates given as metrics are filled into seen during the write, which is the only
    pass over the frame: an empty result is found by its count and removed.
    """
    if seen is not None:
        df = df.observe(seen, *metrics)
    df, rows = counted(df)
    df.write.mode("overwrite").options(**FORMAT, **EMPTY).csv(path)
    if rows_seen(rows):
        return path
    remove(df.sparkSession, path)
    return None


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of write_csv. Fields may hold line breaks, so a file is read by one task.

    write_csv leaves a file for each task that wrote, so a large table has many of them.
    """
    return spark.read.schema(schema).options(**FORMAT, multiLine=True).csv(path)
