"""Gold tables of the commerce reports.

The reports fix the columns of these tables but nothing fixes how they are computed; the
definitions here are this project's own.

Decimal money is summed at its own scale, exactly. Money in doubles is summed as doubles, so its
last bits depend on the order of summing; ranks and segments compare totals that were written
once, and so fit the totals shown.

Sides that must have each key once are checked as they are joined. No line is dropped: lines
without a customer, item or order stay, with NULL where the other side would speak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import amount
from siltstone.operators.joins import one_per_key
from siltstone.operators.ordering import in_order, spread
from siltstone.operators.ranking import rank_within, sorted_quantiles
from siltstone.session import small_tasks


def customer_totals(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order history per customer, with the customer's currency.

    orders: customer_id, order_id, amount, order_date, one row per order or order line.
    customers: customer_id, currency, one row per customer.

    Lines are added up per order first, so that distinct orders are plain counts and a
    customer with very many orders is spread over tasks until only sums remain. The
    customer table joins the finished totals, one row per key on both sides.
    """
    return _customers(order_parts(orders), customers)


def order_parts(orders: DataFrame, *batch: str) -> DataFrame:
    """What a batch of order lines adds to each order: spend, first and last date.

    A day's batch reduces to a row per order. The orders are the keys that the count of
    distinct orders needs, so batches merge exactly even where an order's lines are in several.
    The lines may hold several batches, told apart by the batch columns.
    """
    return orders.groupBy(*batch, "customer_id", "order_id").agg(
        F.sum(amount(orders, "amount")).alias("spend"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )


def customers_from_parts(parts: DataFrame, customers: DataFrame) -> DataFrame:
    """customer_lifetime_value from the parts of all batches instead of from all lines."""
    merged = parts.groupBy("customer_id", "order_id").agg(
        F.sum("spend").alias("spend"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")
    )
    return with_segments(_customers(merged, customers))


def _customers(per_order: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = per_order.groupBy("customer_id").agg(
        F.sum("spend").cast("double").alias("total_spend"),
        F.count("order_id").alias("total_orders"),
        F.datediff(F.max("last_date"), F.min("first_date")).alias("customer_lifespan_days"),
    )
    return per_customer.join(
        one_per_key(customers, "customer_id", "currency"), "customer_id", "left"
    ).select(
        "customer_id",
        "total_spend",
        F.try_divide("total_spend", "total_orders").alias("avg_order_value"),
        "total_orders",
        "customer_lifespan_days",
        F.try_divide(
            F.col("customer_lifespan_days").cast("double"), F.col("total_orders") - 1
        ).alias("avg_days_between_orders"),
        "currency",
    )


def with_segments(totals: DataFrame) -> DataFrame:
    """High, Medium or Low by the tertile cut points of total_spend over all customers.

    The totals are written once to the shared folder, sorted by spend, which is what the cut
    points are read from.
    """
    columns = totals.columns
    placed = in_order(totals, [F.asc_nulls_last("total_spend"), spread(totals)], "customer_totals")
    low, high = sorted_quantiles(placed, "total_spend", [1 / 3, 2 / 3])
    spend = F.col("total_spend")
    segment = (
        F.when(spend >= F.lit(high), "High")
        .when(spend >= F.lit(low), "Medium")
        .when(spend.isNotNull(), "Low")
    )
    return placed.select(*columns, segment.alias("clv_segment"))


def customer_lifetime_value(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer totals with their segment."""
    return with_segments(customer_totals(orders, customers))


def item_options(option_lines: DataFrame, menu: DataFrame) -> DataFrame:
    """Quantities added and removed per item and option.

    option_lines: item_id, quantity, removed (boolean; a NULL counts as added).
    menu: item_id, item_name, option_name, one row per item_id.

    Lines are added up per item_id before they meet the menu. Items that the menu lacks
    are counted under NULL names. Quantities may be of any numeric type, but must add up to whole
    numbers.
    """
    return _options(option_parts(option_lines), menu)


def option_parts(option_lines: DataFrame, *batch: str) -> DataFrame:
    """What a batch of option lines adds to each item_id; batches merge by adding up."""
    quantity = amount(option_lines, "quantity")
    removed = F.coalesce(F.col("removed"), F.lit(False))
    return option_lines.groupBy(*batch, "item_id").agg(
        F.sum(F.when(~removed, quantity)).alias("added"),
        F.sum(F.when(removed, quantity)).alias("gone"),
    )


def options_from_parts(parts: DataFrame, menu: DataFrame) -> DataFrame:
    """item_options from the parts of all batches."""
    merged = parts.groupBy("item_id").agg(F.sum("added").alias("added"), F.sum("gone").alias("gone"))
    return _options(merged, menu)


def _options(per_id: DataFrame, menu: DataFrame) -> DataFrame:
    return (
        per_id.join(one_per_key(menu, "item_id", "item_name", "option_name"), "item_id", "left")
        .groupBy("item_name", "option_name")
        .agg(
            _whole(F.sum("added"), "added").alias("total_added_count"),
            _whole(F.sum("gone"), "removed").alias("total_removed_count"),
        )
    )


def _whole(total: Column, what: str) -> Column:
    """A sum of quantities as a count; one with a fraction is no count and fails the query."""
    count = F.coalesce(total, F.lit(0))
    failure = F.raise_error(F.lit(f"quantities {what} do not add up to a whole number"))
    return F.when(count == F.floor(count), count.cast("bigint")).otherwise(failure.cast("bigint"))


def location_totals(
    order_lines: DataFrame, orders: DataFrame, restaurants: DataFrame
) -> DataFrame:
    """Revenue and order cadence per restaurant and currency.

    order_lines: order_id, restaurant_id, revenue.
    orders: order_id, order_date, one row per order.
    restaurants: restaurant_id, currency, one row per restaurant.

    Lines meet their orders first: the grouping by order and restaurant that follows is
    then partitioned by order already, so lines move once. Each step makes distinct what the
    next one counts: lines become one row per restaurant and order, these one per restaurant
    and week with the week's days as bits, these one per restaurant. The bits are exact and
    merge by OR, so no step needs a distinct count, and a restaurant with very many lines is
    spread by order and by week until only its weeks remain. Lines without an order, or of one
    without a date, count for revenue and orders but for no day.
    """
    lines = order_lines.select("order_id", "restaurant_id", amount(order_lines, "revenue").alias("revenue"))
    dated = lines.join(one_per_key(orders, "order_id", "order_date"), "order_id", "left")
    per_order = dated.groupBy("order_id", "restaurant_id").agg(
        F.sum("revenue").alias("revenue"), F.min("order_date").cast("date").alias("day")
    )
    return _with_currency(_per_restaurant(_per_week(per_order)), restaurants)


def line_parts(order_lines: DataFrame, *batch: str) -> DataFrame:
    """What a batch of order lines adds to each order and restaurant.

    The result can stand for the lines. An order's date is looked up when batches are merged,
    so an order may arrive after its lines, and its lines in several batches.
    """
    revenue = F.sum(amount(order_lines, "revenue")).alias("revenue")
    return order_lines.groupBy(*batch, "order_id", "restaurant_id").agg(revenue)


def _per_week(per_order: DataFrame) -> DataFrame:
    """Revenue, orders and days (as bits) of every restaurant and week."""
    week = F.date_trunc("week", "day").cast("date").alias("week")
    return per_order.groupBy("restaurant_id", week).agg(
        F.sum("revenue").alias("revenue"),
        F.count("order_id").alias("orders"),
        F.bit_or(F.expr("shiftleft(1, weekday(day))")).alias("days"),
    )


def _per_restaurant(per_week: DataFrame) -> DataFrame:
    return per_week.groupBy("restaurant_id").agg(
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.sum("orders").alias("total_orders"),
        F.sum(F.bit_count("days")).alias("days"),
        F.count("week").alias("weeks"),
    )


def _with_currency(per_restaurant: DataFrame, restaurants: DataFrame) -> DataFrame:
    return per_restaurant.join(
        one_per_key(restaurants, "restaurant_id", "currency"), "restaurant_id", "left"
    ).select(
        "restaurant_id",
        "currency",
        "total_revenue",
        F.try_divide("total_revenue", "total_orders").alias("avg_order_value"),
        "total_orders",
        F.try_divide("total_orders", "days").alias("avg_daily_orders"),
        F.try_divide("total_orders", "weeks").alias("avg_weekly_orders"),
    )


def top_performing_locations(
    order_lines: DataFrame, orders: DataFrame, restaurants: DataFrame
) -> DataFrame:
    """Location totals ranked by revenue inside each currency.

    The totals are written once to the shared folder, in the order of their ranks, so that the
    ranks compare the same sums that are shown. A line is held by several sorts and hash tables
    of a task until its week's sums are left, so that tasks are small.
    """
    totals = location_totals(order_lines, orders, restaurants)
    with small_tasks(totals.sparkSession):
        ranked = rank_within(totals, "currency", "total_revenue", "revenue_rank")
    return ranked.select("revenue_rank", *totals.columns)
