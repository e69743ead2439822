from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone_checks import inputs
from siltstone_checks.inputs import derive
from siltstone.plans import commerce, reports
from siltstone import session
from siltstone.session import scratch_path
from siltstone.sources.catalog import buckets_for, read_named, write_bucketed
from tests.conftest import SMALL, plan, rows

NAN = float("nan")


def clv(spark, *given):
    return spark.createDataFrame(
        list(given),
        "total_spend double, avg_order_value double, customer_lifespan_days int, "
        "clv_segment string, total_orders bigint, avg_days_between_orders double, currency string",
    )


@pytest.fixture()
def customers(spark):
    return clv(
        spark,
        (10.0, 5.0, 3, "High", 2, 3.0, "EUR"),
        (20.0, NAN, 4, "High", 4, None, "USD"),
        (NAN, 1.0, None, "Low", 1, None, None),
        (None, None, 5, "Low", 1, None, "CHF"),
        (7.0, 7.0, 0, None, 1, None, "EUR"),
    )


def test_kpis_skip_nan_and_null(customers):
    assert tuple(reports.clv_kpis(customers).first()) == (5, 37.0, pytest.approx(13 / 3), 3.0)


def test_segments_without_a_name_are_no_group(customers):
    assert rows(reports.clv_segment_counts(customers)) == [("High", 2), ("Low", 2)]
    means = [tuple(r) for r in reports.clv_segment_means(customers).collect()]
    assert means == [("High", 15.0, 3.0, 3.0), ("Low", None, 1.0, None)]


def test_revenue_of_nothing_is_zero(customers):
    got = [tuple(r) for r in reports.clv_revenue_by_currency(customers).collect()]
    assert got == [("USD", 20.0), ("EUR", 17.0), ("CHF", 0.0)]


def test_filtered_by_segment(customers):
    assert reports.clv_filtered(customers).count() == 5
    assert reports.clv_filtered(customers, ["High", None]).count() == 3
    assert reports.clv_filtered(customers, []).count() == 0
    assert [r[0] for r in reports.clv_segments(customers).collect()] == [None, "High", "Low"]


def test_customer_totals(spark):
    orders = spark.createDataFrame(
        [
            (1, 10, Decimal("5.10"), date(2024, 1, 1)),
            (1, 10, Decimal("0.20"), date(2024, 1, 1)),
            (1, 11, Decimal("1.00"), date(2024, 1, 9)),
            (1, 12, None, date(2024, 1, 5)),
            (2, 20, Decimal("3.00"), date(2024, 2, 1)),
        ],
        "customer_id int, order_id int, amount decimal(18,2), order_date date",
    )
    who = spark.createDataFrame([(1, "EUR")], "customer_id int, currency string")
    got = rows(commerce.customer_totals(orders, who))
    assert got == [(1, 6.3, 6.3 / 3, 3, 8, 4.0, "EUR"), (2, 3.0, 3.0, 1, 0, None, None)]


def test_money_is_summed_at_its_own_scale(spark):
    small = [(1, i, Decimal("0.00004"), date(2024, 1, 1)) for i in range(3)]
    large = [(2, 9, Decimal("1000000000000000.00000001"), date(2024, 1, 1))] * 2
    orders = spark.createDataFrame(
        small + large, "customer_id int, order_id int, amount decimal(28,8), order_date date"
    )
    who = spark.createDataFrame([(1, "EUR"), (2, "EUR")], "customer_id int, currency string")
    assert [r[1] for r in rows(commerce.customer_totals(orders, who))] == [0.00012, 2e15]
    doubles = orders.withColumn("amount", F.col("amount").cast("double"))
    got = [r[1] for r in rows(commerce.customer_totals(doubles, who))]
    assert got == pytest.approx([0.00012, 2e15], rel=1e-15)


def test_segments_have_all_names(spark):
    orders, who = (derive(spark, SMALL, s) for s in (inputs.CLV_ORDERS, inputs.CLV_CUSTOMERS))
    direct = commerce.customer_lifetime_value(orders, who)
    assert {r[0] for r in reports.clv_segments(direct).collect()} == {"High", "Medium", "Low"}
    assert "Window" not in plan(direct)


def test_a_repeated_dimension_key_fails(spark):
    orders = spark.createDataFrame(
        [(1, 10, 5.0, date(2024, 1, 1))], "customer_id int, order_id int, amount double, order_date date"
    )
    who = spark.createDataFrame([(1, "EUR"), (1, "USD")], "customer_id int, currency string")
    with pytest.raises(PySparkException, match="customer_id is repeated"):
        commerce.customer_totals(orders, who).collect()


def test_segments_of_no_customers(spark):
    orders, who = (derive(spark, SMALL, s) for s in (inputs.CLV_ORDERS, inputs.CLV_CUSTOMERS))
    assert commerce.customer_lifetime_value(orders.where("1 = 0"), who).count() == 0


def test_lines_without_an_order_keep_their_revenue(spark):
    lines = spark.createDataFrame(
        [(1, 7, 2.0), (99, 7, 3.0), (99, 8, 4.0)], "order_id int, restaurant_id int, revenue double"
    )
    dates = spark.createDataFrame([(1, date(2024, 1, 1))], "order_id int, order_date date")
    who = spark.createDataFrame([(7, "EUR")], "restaurant_id int, currency string")
    assert rows(commerce.location_totals(lines, dates, who)) == [
        (7, "EUR", 5.0, 2.5, 2, 2.0, 2.0),
        (8, None, 4.0, 4.0, 1, None, None),
    ]


def test_lines_of_locations_move_once(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    lines, dates, places = (
        derive(spark, SMALL, sql) for sql in (inputs.ORDER_LINES, inputs.ORDER_DATES, inputs.RESTAURANTS)
    )
    text = plan(commerce.location_totals(lines, dates, places))
    assert text.count("hashpartitioning(order_id") == 2  # the lines and the orders, once each


def test_location_cadence(spark):
    lines = spark.createDataFrame(
        [(1, 7, 2.0), (1, 7, 3.0), (2, 7, 1.0), (3, 7, 4.0), (3, 8, 6.0)],
        "order_id int, restaurant_id int, revenue double",
    )
    dates = spark.createDataFrame(
        [(1, date(2024, 1, 1)), (2, date(2024, 1, 1)), (3, date(2024, 1, 8))],
        "order_id int, order_date date",
    )
    who = spark.createDataFrame([(7, "EUR"), (8, "EUR")], "restaurant_id int, currency string")
    got = rows(commerce.top_performing_locations(lines, dates, who))
    assert got == [
        (1, 7, "EUR", 10.0, 10.0 / 3, 3, 1.5, 1.5),
        (2, 8, "EUR", 6.0, 6.0, 1, 1.0, 1.0),
    ]


def _bucketed(spark, name, df, key):
    write_bucketed(df, name, scratch_path(spark, name), key, 8)
    return read_named(spark, name)


def test_tables_bucketed_by_their_keys_need_no_shuffle_of_lines(spark, with_conf):
    """The groupings and joins fit a bucketing by order or customer as they are."""
    with_conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"
    )
    orders, who, lines, dates, places = (
        derive(spark, SMALL, sql)
        for sql in (
            inputs.CLV_ORDERS,
            inputs.CLV_CUSTOMERS,
            inputs.ORDER_LINES,
            inputs.ORDER_DATES,
            inputs.RESTAURANTS,
        )
    )
    totals = commerce.customer_totals(
        _bucketed(spark, "orders_b", orders, "customer_id"),
        _bucketed(spark, "customers_b", who, "customer_id"),
    )
    assert "Exchange" not in plan(totals)
    assert rows(totals) == rows(commerce.customer_totals(orders, who))
    located = commerce.location_totals(
        _bucketed(spark, "lines_b", lines, "order_id"),
        _bucketed(spark, "dates_b", dates, "order_id"),
        places,
    )
    assert "hashpartitioning(order_id" not in plan(located)
    assert rows(located) == rows(commerce.location_totals(lines, dates, places))


def test_item_options(spark):
    lines = spark.createDataFrame(
        [(1, 2.0, False), (1, 3.0, True), (2, 5.0, False), (3, 1.0, False), (2, NAN, False)],
        "item_id int, quantity double, removed boolean",
    )
    menu = spark.createDataFrame(
        [(1, "tea", "milk"), (2, "tea", "milk"), (3, "tea", "sugar")],
        "item_id int, item_name string, option_name string",
    )
    more = spark.createDataFrame(
        [(3, 4.0, None), (9, 2.0, False), (9, 1.0, True)], "item_id int, quantity double, removed boolean"
    )
    assert rows(commerce.item_options(lines.union(more), menu)) == [
        ("tea", "milk", 7, 3),
        ("tea", "sugar", 5, 0),
        (None, None, 2, 1),
    ]


def test_quantities_that_make_no_whole_count_fail(spark):
    lines = spark.createDataFrame([(1, 0.5, False), (1, 0.5, False)], "item_id int, quantity double, removed boolean")
    menu = spark.createDataFrame([(1, "tea", "milk")], "item_id int, item_name string, option_name string")
    assert rows(commerce.item_options(lines, menu)) == [("tea", "milk", 1, 0)]
    with pytest.raises(PySparkException, match="whole number"):
        commerce.item_options(lines.withColumn("quantity", F.lit(0.3)), menu).collect()


def test_days_and_weeks_need_no_distinct_count(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    lines, dates, places = (
        derive(spark, SMALL, sql) for sql in (inputs.ORDER_LINES, inputs.ORDER_DATES, inputs.RESTAURANTS)
    )
    text = plan(commerce.location_totals(lines, dates, places))
    assert "distinct" not in text and "Expand" not in text
    assert text.count("Exchange hashpartitioning(restaurant_id#") <= 3  # weeks, totals and the restaurants


def test_item_reports(spark):
    options = spark.createDataFrame(
        [
            ("tea", "milk", "3", "1"),
            ("tea", "sugar", "x", "9"),
            ("cake", "cream", "3.9", None),
            (None, "milk", "4", "0"),
            ("tea", None, "100", "100"),
        ],
        "item_name string, option_name string, total_added_count string, total_removed_count string",
    )
    clean = reports.item_options_clean(options)
    assert tuple(reports.item_options_kpis(clean).first()) == (2, 3, 110)
    assert [r[0] for r in reports.item_names(clean).collect()] == ["cake", "tea"]
    assert rows(reports.item_options_for_item(clean)) == [("cake", "cream", 3, 0)]
    tea = [tuple(r) for r in reports.item_options_for_item(clean, "tea").collect()]
    assert [r[2] for r in tea] == [100, 3, 0]
    assert [r[1] for r in reports.item_top_removed(clean, "tea").collect()] == ["milk", "sugar", None]
    added = [tuple(r) for r in reports.options_top_added(clean).collect()]
    assert added == [("sugar", 0), ("cream", 3), ("milk", 7)]
    assert "TakeOrderedAndProject" in plan(reports.options_top_removed(clean))


def test_location_reports(spark):
    data = [(i, i * 10, "EUR", 100.0 - i, 2.0, 3, 1.0, 4.0) for i in range(1, 13)]
    data += [(1, 999, "USD", 5.0, NAN, 1, None, 1.0)]
    table = spark.createDataFrame(
        data,
        "revenue_rank int, restaurant_id int, currency string, total_revenue double, "
        "avg_order_value double, total_orders bigint, avg_daily_orders double, "
        "avg_weekly_orders double",
    ).orderBy(F.desc("revenue_rank"))
    assert [r[0] for r in reports.location_currencies(table).collect()] == ["EUR", "USD"]
    assert tuple(reports.locations_kpis(table, "USD").first()) == (1, 5.0, None, None)
    assert [r[0] for r in reports.locations_top10(table).collect()] == list(range(1, 11))
    ranking = reports.locations_ranking(table)
    assert [r[0] for r in ranking.collect()] == list(range(1, 13))
    assert ranking.columns[0] == "revenue_rank" and "currency" not in ranking.columns
    assert reports.locations_scatter(table, "EUR").count() == 12


def test_locations_without_a_restaurant_have_a_currency_entry(spark):
    table = spark.createDataFrame([("USD",), (None,), ("EUR",), (None,)], "currency string")
    assert [r[0] for r in reports.location_currencies(table).collect()] == ["EUR", "USD", None]


def test_locations_are_added_up_by_small_tasks(spark, with_conf, monkeypatch):
    """Smaller sizes that the session asks for stay, and all are as before afterwards."""
    size, read, first = *session.SMALL_TASKS, session.INITIAL_PARTITIONS
    with_conf(**{size.replace(".", "__"): "64MB", read.replace(".", "__"): "1m"})
    seen, rank_within = {}, commerce.rank_within

    def spy(*args):
        seen.update({k: spark.conf.get(k) for k in (size, read, first)})
        return rank_within(*args)

    monkeypatch.setattr(commerce, "rank_within", spy)
    lines, dates, places = (
        derive(spark, SMALL, sql) for sql in (inputs.ORDER_LINES, inputs.ORDER_DATES, inputs.RESTAURANTS)
    )
    assert commerce.top_performing_locations(lines, dates, places).count() > 0
    assert seen == {size: str(16 << 20), read: "1m", first: "200"}  # the session has 8 shuffle partitions
    assert (spark.conf.get(size), spark.conf.get(read), spark.conf.get(first, None)) == ("64MB", "1m", None)


def test_buckets_grow_with_the_table():
    assert [buckets_for(n) for n in (0, 1, 8_000_000, 8_000_001, 216_000_000)] == [16, 16, 16, 32, 512]
