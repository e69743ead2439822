"""Places and running sums over a whole sorted table, without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.sources.staging import NARROW_ROWS, stage

# monotonically_increasing_id holds the partition above these bits, the row's place below.
ROW_BITS = 33


def in_order(
    df: DataFrame,
    order: list[Column],
    name: str,
    value: str | None = None,
    most: int | None = None,
    each: int = NARROW_ROWS,
) -> DataFrame:
    """df with rank (0-based place in the order) and total (rows), written to the shared folder.

    With a value column (whole numbers, not null) also before, the sum of the values of all
    earlier rows, and whole, the sum of all. Spark sorts by range, so no key gathers in one
    task; a row's place is its place in its own partition plus the rows of the partitions
    before it, and only one number or two for each partition are added up in one task. A bound
    of the rows, most, sets the number of files as in `stage`; sorted partitions stay as they are.
    """
    at = F.col("__at")
    rows = stage(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), name, most, each).df
    rows = rows.withColumns(
        {"__part": F.shiftright(at, ROW_BITS), "__row": at.bitwiseAND((1 << ROW_BITS) - 1)}
    )
    sums = [F.count("*").alias("__n")] + ([F.sum(value).alias("__v")] if value else [])
    parts = rows.groupBy("__part").agg(*sums)
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = {
        "__first": F.coalesce(F.sum("__n").over(earlier), F.lit(0)),
        "total": F.sum("__n").over(every),
    }
    if value:
        found |= {
            "__sum": F.coalesce(F.sum("__v").over(earlier), F.lit(0)),
            "whole": F.sum("__v").over(every),
        }
    # One row for each partition of the sorted table, which bounds its size.
    parts = F.broadcast(parts.withColumns(found).drop("__n", "__v"))
    rows = rows.join(parts, "__part").withColumn("rank", F.col("__first") + F.col("__row"))
    if value:
        inside = Window.partitionBy("__part").orderBy("__row")
        inside = inside.rowsBetween(Window.unboundedPreceding, -1)
        own = F.coalesce(F.sum(value).over(inside), F.lit(0))
        rows = rows.withColumn("before", F.col("__sum") + own)
    return rows.drop("__at", "__part", "__row", "__first", "__sum")


def spread(df: DataFrame) -> Column:
    """A last sort column by which rows that are equal in the others are shared out over ranges."""
    return F.xxhash64(*df.columns)
