"""Top-k, exact quantiles and exact ranks that stay distributed on large groups."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.ordering import in_order, spread


def largest(df: DataFrame, value: str, tie_break: str, n: int = 10) -> DataFrame:
    """The n rows with the largest values, shown in ascending order."""
    top = df.orderBy(F.desc_nulls_last(value), F.asc_nulls_last(tie_break)).limit(n)
    return top.orderBy(F.asc_nulls_last(value), F.desc_nulls_last(tie_break))


def best_ranked(df: DataFrame, rank: str, tie_break: str, n: int = 10) -> DataFrame:
    return by_rank(df, rank, tie_break).limit(n)


def best_of_each(df: DataFrame, group: str, rank: str, tie_break: str, n: int = 10) -> DataFrame:
    """The n best ranked rows of every group, in one pass; rows without a group are left out.

    Each task keeps its n best rows of a group before anything moves, so that a group of any
    size sends n rows a task.
    """
    order = Window.partitionBy(group).orderBy(F.asc_nulls_last(rank), F.asc_nulls_last(tie_break))
    placed = df.where(F.col(group).isNotNull()).withColumn("__place", F.row_number().over(order))
    return placed.where(F.col("__place") <= n).drop("__place")


def by_rank(df: DataFrame, rank: str, tie_break: str) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(rank), F.asc_nulls_last(tie_break))


def sorted_quantiles(placed: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Interpolated quantiles of a double column, exact at any size.

    placed is what in_order made of a table sorted by the column, NULLs last; NaN sorts behind
    all numbers, so the numbers have the first places. Two rows for each share come to the driver.
    """
    known = F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    n = placed.where(known).count()
    if n == 0:
        return [None] * len(shares)
    places = [share * (n - 1) for share in shares]
    wanted = sorted({f(place) for place in places for f in (floor, ceil)})
    found = placed.where(F.col("rank").isin(wanted)).select("rank", F.col(column).cast("double").alias("v"))
    value_at = {row["rank"]: row["v"] for row in found.collect()}
    out = []
    for place in places:
        k = floor(place)
        low, high = value_at[k], value_at[ceil(place)]
        out.append(low if place == k or low == high else (k + 1 - place) * low + (place - k) * high)
    return out


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Interpolated quantiles of a double column, exact at any size; the column is written sorted."""
    values = df.select(column)
    return sorted_quantiles(in_order(values, [F.asc_nulls_last(column)], "values"), column, shares)


def rank_within(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """rank() by value, largest first, inside each group; exact at any group size.

    df is written once, sorted by group and value over all groups; rows of one value are shared
    out by a hash. A row's rank is the first place of its value less that of its group.
    """
    columns = df.columns
    order = [F.asc_nulls_first(group), F.desc_nulls_last(value), spread(df)]
    placed = in_order(df, order, "ranks").withColumnRenamed("rank", "__rank").drop("total")
    firsts = placed.groupBy(F.col(group).alias("__group"), F.col(value).alias("__value")).agg(F.min("__rank").alias("__first"))
    starts = firsts.groupBy(F.col("__group").alias("__of")).agg(F.min("__first").alias("__start"))
    ranks = firsts.join(starts, F.col("__group").eqNullSafe(F.col("__of")))
    ranks = ranks.select("__group", "__value", (1 + F.col("__first") - F.col("__start")).cast("int").alias(name))
    same = F.col(group).eqNullSafe(F.col("__group")) & F.col(value).eqNullSafe(F.col("__value"))
    return placed.join(ranks, same, "left").select(*columns, name)
