from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import rollups
from tallyhouse.plans import benchmark_queries, marts

D = Decimal
SALES = (
    "channel string, sale_order_id bigint, item_sk int, customer_sk bigint, sold_date_sk int, "
    "quantity int, sales_price decimal(7,2), ext_discount_amt decimal(7,2), "
    "ext_sales_price decimal(7,2), ext_tax decimal(7,2), net_paid decimal(7,2), "
    "net_profit decimal(7,2)"
)
RETURNS = (
    "channel string, return_order_id bigint, item_sk int, returned_date_sk int, "
    "return_quantity int, return_amt decimal(7,2)"
)
ITEMS = (
    "item_key int, item_id string, product_name string, brand string, category string, "
    "item_class string, manufacturer string, size string, color string, "
    "current_price decimal(7,2), wholesale_cost decimal(7,2), is_current int"
)


def sales_of(spark, *rows):
    """rows: channel, order, item, customer, day, units, paid"""
    full = [
        (c, o, i, k, d, u, D(p) / u, D(0), D(p), D(0), D(p), D(1)) for c, o, i, k, d, u, p in rows
    ]
    return spark.createDataFrame(full, SALES)


def dates_of(spark, days=800):
    first = date(2000, 1, 1)
    rows = []
    for n in range(days):
        day = first + timedelta(days=n)
        quarter = (day.month + 2) // 3
        rows.append((n, day, day.year, quarter, day.month, day.isoweekday() % 7, str(day.weekday()), 0))
    return spark.createDataFrame(
        rows,
        "date_key int, calendar_date date, calendar_year int, quarter_of_year int, "
        "month_of_year int, day_of_week int, day_name string, is_weekend int",
    )


def items_of(spark, *rows):
    """rows: key, category, is_current"""
    full = [
        (k, f"I{k}", "n", f"brand {k % 2}", c, "c", "m", "s", "red", D(1), D(1), cur)
        for k, c, cur in rows
    ]
    return spark.createDataFrame(full, ITEMS)


def test_sales_performance(spark):
    sales = sales_of(
        spark,
        ("store", 1, 1, 1, 10, 4, "40"),
        ("store", 1, 2, 1, 10, 1, "20"),
        ("store", 2, 1, 2, 10, 5, "40"),
        ("web", 1, 1, 1, 11, 1, "0"),
        ("web", 3, 1, 1, 9999, 1, "5"),  # day unknown to the calendar
    )
    returns = spark.createDataFrame(
        [("store", 1, 1, 10, 20, D(7)), ("web", 1, 1, 12, 1, D(1))], RETURNS
    )
    mart = marts.mart_sales_performance(sales, returns, dates_of(spark))
    rows = {(r.date_key, r.channel): r for r in mart.collect()}
    assert set(rows) == {(10, "store"), (11, "web")}
    store, web = rows[10, "store"], rows[11, "web"]
    assert (store.units_sold, store.order_count, store.gross_sales) == (10, 2, D(100))
    assert (store.avg_order_value, store.net_revenue, store.returns_rate) == (D("50.00"), D(93), D("2.0000"))
    assert (store.profit_margin, store.calendar_date) == (D("0.0300"), date(2000, 1, 11))
    assert (web.profit_margin, web.units_returned, web.returns_rate) == (None, 0, D("0.0000"))


def test_channel_comparison(spark):
    sales = sales_of(
        spark,
        ("store", 1, 1, 1, 0, 1, "30"),
        ("store", 1, 1, None, 5, 1, "30"),
        ("web", 2, 1, 1, 6, 1, "40"),
        ("web", 3, 1, 1, 40, 1, "10"),
    )
    returns = spark.createDataFrame([("web", 2, 1, 30, 1, D(4)), ("web", 2, 1, 70, 1, D(4))], RETURNS)
    mart = marts.mart_channel_comparison(sales, returns, dates_of(spark))
    rows = {(r.month_of_year, r.channel): r for r in mart.collect()}
    assert set(rows) == {(1, "store"), (1, "web"), (2, "web")}
    assert rows[1, "store"].share_of_total == D("0.6000")
    assert (rows[1, "store"].order_count, rows[1, "store"].unique_customers) == (1, 1)
    assert (rows[1, "web"].returns_rate, rows[2, "web"].share_of_total) == (D("0.1000"), D("1.0000"))
    assert rows[2, "web"].units_returned == 0


def test_product_analytics(spark, many_slices):
    sales = sales_of(
        spark,
        ("web", 1, 1, 1, 0, 2, "10"),
        ("store", 2, 1, 1, 0, 2, "10"),
        ("web", 3, 2, 2, 0, 1, "20"),
        ("web", 4, 3, 2, 0, 1, "99"),
    )
    returns = spark.createDataFrame([("web", 1, 1, 0, 1, D(5))], RETURNS)
    items = items_of(spark, (1, "a", 1), (2, "a", 1), (3, "a", 0), (4, "b", 1), (5, None, 1))
    mart = marts.mart_product_analytics(sales, returns, items)
    rows = {r.item_key: r for r in mart.collect()}
    assert set(rows) == {1, 2, 4, 5}
    assert (rows[1].top_channel, rows[2].top_channel, rows[4].top_channel) == ("store", "web", None)
    assert {k: (r.rank_by_revenue, r.rank_in_category) for k, r in rows.items()} == {
        1: (1, 1), 2: (1, 1), 4: (3, 1), 5: (3, 1),
    }
    assert (rows[1].returns_rate, rows[1].avg_sales_price) == (D("0.2500"), 5.0)
    assert (rows[4].units_sold, rows[4].returns_rate, rows[4].avg_sales_price) == (0, None, None)


def test_customer_360(spark, many_slices):
    sales = sales_of(
        spark,
        ("store", 1, 1, 1, 0, 1, "10"),
        ("web", 1, 1, 1, 3, 1, "10"),
        ("web", 1, 2, 1, 3, 1, "5"),
        ("store", 5, 1, 2, 7, 2, "4"),
        ("store", 9, 1, None, 9, 1, "1"),  # anchors "today" though the customer is unknown
    )
    columns = (
        "customer_key bigint, customer_id string, customer_name string, email_address string, "
        "city string, state string, zip string, country string, gender string, "
        "marital_status string, education_status string, credit_rating string, "
        "income_lower_bound int, income_upper_bound int, is_preferred_customer int"
    )
    customers = spark.createDataFrame([(k, *["x"] * 11, 1, 2, 0) for k in (1, 2, 3)], columns)
    mart = marts.mart_customer_360(sales, dates_of(spark), customers)
    rows = {r.customer_key: r for r in mart.collect()}
    one, two, three = rows[1], rows[2], rows[3]
    assert (one.frequency, one.channels_used, one.lifetime_units) == (2, 2, 3)
    assert (one.recency_days, two.recency_days) == (6, 2)
    assert (one.preferred_channel, two.preferred_channel) == ("web", "store")
    # Two customers fill quintiles 3 and 5.
    assert (one.rfm_code, two.rfm_code) == ("355", "533")
    assert (one.segment, two.segment) == ("Loyal", "Loyal")
    assert (three.segment, three.rfm_code, three.frequency) == ("Inactive", None, None)
    assert len(mart.columns) == 29


@pytest.mark.parametrize(
    "scores, segment",
    [
        ((4, 4, 4), "Champion"),
        ((3, 3, 5), "Loyal"),
        ((5, 1, 1), "New"),
        ((1, 5, 1), "At Risk"),
        ((1, 1, 1), "Lost"),
        ((3, 1, 1), "Potential"),
        ((None, None, None), "Inactive"),
    ],
)
def test_segments(spark, scores, segment):
    df = spark.createDataFrame([scores], "r_score int, f_score int, m_score int")
    assert df.select(marts.segment_of()).first()[0] == segment


def test_returns_fan_out(spark):
    """A sale line repeats for each return line of its key, and the other way round."""
    sales = sales_of(
        spark,
        ("store", 1, 1, 1, 0, 10, "10"),
        ("web", 1, 1, 1, 0, 3, "10"),
        ("store", 2, 1, 1, 0, 4, "10"),
    )
    returns = spark.createDataFrame(
        [("store", 1, 1, 0, 2, D(1)), ("store", 1, 1, 0, None, D(1)), ("web", 7, 1, 0, 5, D(1)),
         ("web", None, 1, 0, 5, D(1))],
        RETURNS,
    )
    items = items_of(spark, (1, "a", 1))
    joined = sales.join(
        returns.drop("channel"),
        (sales.item_sk == returns.item_sk) & (F.col("sale_order_id") == F.col("return_order_id")),
        "left",
    )
    wanted = joined.agg(F.sum("quantity"), F.sum("return_quantity")).first()
    row = benchmark_queries.returns_rate_by_brand(sales, returns, items, 0).first()
    assert (row.units_sold, row.units_returned) == tuple(wanted) == (30, 4)
    assert benchmark_queries.returns_rate_by_brand(sales, returns, items, 30).isEmpty()


def test_top_customers_adds_up_keys_of_one_id(spark):
    sales = sales_of(spark, ("web", 1, 1, 1, 0, 1, "5"), ("web", 1, 1, 2, 0, 1, "5"), ("web", 1, 1, 3, 0, 1, "9"))
    customers = spark.createDataFrame(
        [(1, "A", "a"), (2, "A", "a"), (3, "B", "b")],
        "customer_key bigint, customer_id string, customer_name string",
    )
    top = benchmark_queries.top_customers(sales, customers, 1).collect()
    assert [(r.customer_id, r.lifetime_value, r.channels_used) for r in top] == [("A", D(10), 1)]


def test_top_channel_matches_the_window_form(spark):
    rows = [(c, o, o % 7, o, 0, 1 + o % 3, "1") for o in range(60) for c in ("store", "web", "catalog")[: 1 + o % 3]]
    sales = sales_of(spark, *rows)
    one_pass = rollups.item_sales(sales).select("item_sk", F.col("top_channel").alias("channel"))
    assert one_pass.exceptAll(rollups.item_top_channel(sales)).isEmpty()
    customers = rollups.customer_sales(sales).select("customer_sk", F.col("preferred_channel").alias("channel"))
    assert customers.exceptAll(rollups.preferred_channel(sales)).isEmpty()
