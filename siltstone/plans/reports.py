"""The questions the reports ask of the three commerce tables, one frame each."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import whole_count
from siltstone.operators.aggregates import group_by_known, mean, total, total_count
from siltstone.operators.filters import in_list, sorted_values, where_selected
from siltstone.operators.ranking import best_of_each, best_ranked, by_rank, largest


def _rows() -> Column:
    return F.count(F.lit(1))


# Customer lifetime value


def clv_kpis(clv: DataFrame) -> DataFrame:
    return clv.agg(
        _rows().alias("total_customers"),
        total(F.col("total_spend")).alias("total_revenue"),
        mean(F.col("avg_order_value")).alias("avg_order_value"),
        mean(F.col("customer_lifespan_days")).alias("avg_customer_lifespan_days"),
    )


def clv_segment_counts(clv: DataFrame) -> DataFrame:
    return group_by_known(clv, "clv_segment", _rows().alias("count"))


def clv_segment_means(clv: DataFrame) -> DataFrame:
    """Mean spend, orders and days between orders per segment, highest spend first."""
    means = group_by_known(
        clv,
        "clv_segment",
        mean(F.col("total_spend")).alias("avg_spend"),
        mean(F.col("total_orders")).alias("avg_orders"),
        mean(F.col("avg_days_between_orders")).alias("avg_days"),
    )
    return means.orderBy(F.desc_nulls_last("avg_spend"), "clv_segment")


def clv_revenue_by_currency(clv: DataFrame) -> DataFrame:
    revenue = group_by_known(clv, "currency", total(F.col("total_spend")).alias("total_revenue"))
    return revenue.orderBy(F.desc_nulls_last("total_revenue"), "currency")


def clv_segments(clv: DataFrame) -> DataFrame:
    return clv.select("clv_segment").distinct().orderBy("clv_segment")


def clv_filtered(clv: DataFrame, segments: Sequence[Any] | None = None) -> DataFrame:
    """Customers of the chosen segments; None chooses every segment there is."""
    return clv if segments is None else clv.where(in_list(F.col("clv_segment"), segments))


# Item options


def item_options_clean(options: DataFrame) -> DataFrame:
    counts = ("total_added_count", "total_removed_count")
    return options.withColumns({c: whole_count(options, c) for c in counts})


def item_options_kpis(clean: DataFrame) -> DataFrame:
    return clean.agg(
        F.count_distinct("item_name").alias("total_menu_items"),
        F.count_distinct("option_name").alias("total_option_types"),
        total_count(F.col("total_added_count")).alias("total_options_added"),
    )


def item_names(clean: DataFrame) -> DataFrame:
    return sorted_values(clean, "item_name")


def item_options_for_item(clean: DataFrame, item: str | None = None) -> DataFrame:
    """Options of one item, most added first; by default the first item by name."""
    return where_selected(clean, "item_name", item).orderBy(
        F.desc_nulls_last("total_added_count"), "option_name"
    )


def item_top_added(clean: DataFrame, item: str | None = None) -> DataFrame:
    chosen = where_selected(clean, "item_name", item)
    return largest(chosen.drop("total_removed_count"), "total_added_count", "option_name")


def item_top_removed(clean: DataFrame, item: str | None = None) -> DataFrame:
    chosen = where_selected(clean, "item_name", item)
    return largest(chosen.drop("total_added_count"), "total_removed_count", "option_name")


def options_top_added(clean: DataFrame) -> DataFrame:
    return _options_top(clean, "total_added_count")


def options_top_removed(clean: DataFrame) -> DataFrame:
    return _options_top(clean, "total_removed_count")


def _options_top(clean: DataFrame, count: str) -> DataFrame:
    sums = group_by_known(clean, "option_name", total_count(F.col(count)).alias(count))
    return largest(sums, count, "option_name")


# Top performing locations


def location_currencies(locations: DataFrame) -> DataFrame:
    """Every currency there is, in order; NULL, of locations without a restaurant row, comes last."""
    return locations.select("currency").distinct().orderBy(F.asc_nulls_last("currency"))


def _location_figures() -> list[Column]:
    return [
        _rows().alias("total_restaurants"),
        total(F.col("total_revenue")).alias("total_revenue"),
        mean(F.col("avg_order_value")).alias("avg_order_value"),
        mean(F.col("avg_daily_orders")).alias("avg_daily_orders"),
    ]


def locations_kpis(locations: DataFrame, currency: str | None = None) -> DataFrame:
    """Key figures of one currency; by default the first currency by name."""
    return where_selected(locations, "currency", currency).agg(*_location_figures())


def locations_kpis_by_currency(locations: DataFrame) -> DataFrame:
    """Key figures of every currency, in one pass."""
    return group_by_known(locations, "currency", *_location_figures())


def locations_top10_by_currency(locations: DataFrame) -> DataFrame:
    """The ten best ranked locations of every currency, in one pass."""
    return best_of_each(locations, "currency", "revenue_rank", "restaurant_id").select(
        "currency", "revenue_rank", "restaurant_id", "total_revenue", "avg_order_value", "avg_daily_orders"
    )


def locations_top10(locations: DataFrame, currency: str | None = None) -> DataFrame:
    chosen = where_selected(locations, "currency", currency)
    return best_ranked(chosen, "revenue_rank", "restaurant_id").select(
        "revenue_rank", "restaurant_id", "total_revenue", "avg_order_value", "avg_daily_orders"
    )


def locations_scatter(locations: DataFrame, currency: str | None = None) -> DataFrame:
    return where_selected(locations, "currency", currency).select(
        "restaurant_id", "avg_order_value", "total_revenue", "total_orders"
    )


def locations_ranking(locations: DataFrame, currency: str | None = None) -> DataFrame:
    chosen = where_selected(locations, "currency", currency)
    return by_rank(chosen, "revenue_rank", "restaurant_id").select(
        "revenue_rank",
        "restaurant_id",
        "total_revenue",
        "avg_order_value",
        "total_orders",
        "avg_daily_orders",
        "avg_weekly_orders",
    )
