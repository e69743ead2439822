"""Row filters with the list and default rules of the reports."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_list(c: Column, values: Sequence[Any]) -> Column:
    """Membership where a None in the list also keeps NULL rows; an empty list keeps none."""
    known = [v for v in values if v is not None]
    kept = F.coalesce(c.isin(known), F.lit(False)) if known else F.lit(False)
    return kept | c.isNull() if len(known) < len(values) else kept


def where_selected(df: DataFrame, column: str, value: Any = None) -> DataFrame:
    """Rows with the chosen value, by default the first one in sort order."""
    if value is not None:
        return df.where(F.col(column) == F.lit(value))
    first = df.agg(F.min(column).alias(column)).scalar()
    return df.where(F.col(column) == first)


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
