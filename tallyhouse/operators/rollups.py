"""The named aggregation steps behind the marts.

Facts are aggregated before they meet a dimension, and every distinct count
shuffles on its own key first, so a group with a third of all rows is spread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import quotient
from tallyhouse.operators.key_sets import distinct_counts, key_sets
from tallyhouse.operators.ranking import top1_per_group
from tallyhouse.operators.staging import CHANNELS

SALE_SUMS = {
    "units_sold": "quantity",
    "gross_sales": "ext_sales_price",
    "discount_amount": "ext_discount_amt",
    "tax_amount": "ext_tax",
    "net_sales": "net_paid",
    "net_profit": "net_profit",
}
RETURN_SUMS = {"units_returned": "return_quantity", "returns_amount": "return_amt"}


def _sums(sums: dict[str, str]) -> list:
    return [F.sum(column).alias(name) for name, column in sums.items()]


def daily_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.col("sold_date_sk").alias("date_key"), "channel").agg(
        *_sums(SALE_SUMS), F.countDistinct("sale_order_id").alias("order_count")
    )


def daily_returns(returns: DataFrame) -> DataFrame:
    return returns.groupBy(F.col("returned_date_sk").alias("date_key"), "channel").agg(
        *_sums(RETURN_SUMS)
    )


def monthly_sales(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Month totals with distinct orders and distinct customers.

    Two distinct counts make the engine copy each input row, so lines are first
    summed to one row per date, order and customer.
    """
    sums = {name: SALE_SUMS[name] for name in ("units_sold", "gross_sales", "net_sales", "net_profit")}
    orders = sales.groupBy("sold_date_sk", "channel", "sale_order_id", "customer_sk").agg(
        *_sums(sums)
    )
    return (
        orders.join(dates, F.col("sold_date_sk") == F.col("date_key"))
        .groupBy("calendar_year", "month_of_year", "quarter_of_year", "channel")
        .agg(
            *[F.sum(name).alias(name) for name in sums],
            F.countDistinct("sale_order_id").alias("order_count"),
            F.countDistinct("customer_sk").alias("unique_customers"),
        )
    )


def daily_keys(sales: DataFrame) -> DataFrame:
    """Orders and customers of each date and channel, a state that months and years follow
    from without the lines."""
    days = sales.withColumnRenamed("sold_date_sk", "date_key")
    return key_sets(days, ["date_key", "channel"], {"order": "sale_order_id", "customer": "customer_sk"})


def monthly_from_days(daily: DataFrame, keys: DataFrame, dates: DataFrame) -> DataFrame:
    """``monthly_sales`` from daily totals and daily keys, without the lines."""
    months = ["calendar_year", "month_of_year", "quarter_of_year", "channel"]
    names = ("units_sold", "gross_sales", "net_sales", "net_profit")
    calendar = dates.select("date_key", *months[:3])
    sums = daily.join(calendar, "date_key").groupBy(*months).agg(*[F.sum(n).alias(n) for n in names])
    kinds = {"order": "order_count", "customer": "unique_customers"}
    counts = distinct_counts(keys.join(calendar, "date_key"), months, kinds)
    # A month of lines without orders and customers has no keys; no part of a month is NULL.
    return sums.join(counts, months, "left").fillna(0, list(kinds.values()))


def unique_per_year(keys: DataFrame, dates: DataFrame) -> DataFrame:
    """Distinct orders and customers per year over all channels, from daily keys."""
    years = keys.join(dates.select("date_key", "calendar_year"), "date_key")
    return distinct_counts(years, ["calendar_year"], {"order": "order_count", "customer": "unique_customers"})


def monthly_returns(returns: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        daily_returns(returns)
        .join(dates, "date_key")
        .groupBy("calendar_year", "month_of_year", "channel")
        .agg(*[F.sum(name).alias(name) for name in RETURN_SUMS])
    )


def item_sales(sales: DataFrame) -> DataFrame:
    """Lifetime totals per item and its channel with most units, in one pass.

    Channels are the fixed set staging writes, so units per channel are plain
    conditional sums; on equal units the channel first by name wins.
    """
    by_item = sales.groupBy("item_sk").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("ext_sales_price").alias("gross_revenue"),
        F.sum("net_paid").alias("net_revenue"),
        F.sum("net_profit").alias("net_profit"),
        F.countDistinct("customer_sk").alias("distinct_customers"),
        quotient(F.sum("sales_price"), F.count("sales_price")).alias("avg_sales_price"),
        *[
            F.sum(F.when(F.col("channel") == channel, F.coalesce("quantity", F.lit(0)))).alias(
                f"_{channel}"
            )
            for channel in CHANNELS
        ],
    )
    # A channel without rows stays NULL and never compares as the best.
    best = F.greatest(*[f"_{channel}" for channel in CHANNELS])
    top = F.coalesce(*[F.when(F.col(f"_{c}") == best, F.lit(c)) for c in sorted(CHANNELS)])
    return by_item.withColumn("top_channel", top).drop(*[f"_{c}" for c in CHANNELS])


def item_returns(returns: DataFrame) -> DataFrame:
    return returns.groupBy("item_sk").agg(*_sums(RETURN_SUMS))


def item_top_channel(sales: DataFrame) -> DataFrame:
    units = sales.groupBy("item_sk", "channel").agg(F.sum("quantity").alias("units"))
    order = [F.desc_nulls_last("units"), F.asc("channel")]
    return top1_per_group(units, ["item_sk"], order).select("item_sk", "channel")


def customer_sales(sales: DataFrame) -> DataFrame:
    """Lifetime totals and preferred channel of each known customer, in one scan.

    Lines are first summed per customer, channel and order; an order belongs to one
    channel, so the rows left per customer are its distinct orders.
    """
    orders = (
        sales.where("customer_sk IS NOT NULL")
        .groupBy("customer_sk", "channel", "sale_order_id")
        .agg(
            F.min("sold_date_sk").alias("first_day"),
            F.max("sold_date_sk").alias("last_day"),
            F.sum("quantity").alias("units"),
            F.sum("net_paid").alias("paid"),
        )
    )
    per_channel = []
    for channel in CHANNELS:
        here = F.col("channel") == channel
        per_channel.append(F.sum(F.when(here, F.col("paid"))).alias(f"_paid_{channel}"))
        per_channel.append(F.max(here).alias(f"_has_{channel}"))
    customers = orders.groupBy("customer_sk").agg(
        F.min("first_day").alias("first_purchase_date_key"),
        F.max("last_day").alias("last_purchase_date_key"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("units").alias("lifetime_units"),
        F.sum("paid").alias("lifetime_value"),
        *per_channel,
    )
    # Greatest value first, NULL values last, then channel by name.
    places = [
        F.when(
            F.col(f"_has_{c}"),
            F.struct(
                F.isnull(f"_paid_{c}").alias("unpaid"),
                F.negate(f"_paid_{c}").alias("order"),
                F.lit(c).alias("channel"),
            ),
        )
        for c in CHANNELS
    ]
    used = sum(F.col(f"_has_{c}").cast("bigint") for c in CHANNELS)
    return customers.withColumns(
        {"channels_used": used, "preferred_channel": F.least(*places)["channel"]}
    ).drop(*[f"{kind}{c}" for c in CHANNELS for kind in ("_paid_", "_has_")])


def preferred_channel(sales: DataFrame) -> DataFrame:
    paid = (
        sales.where("customer_sk IS NOT NULL")
        .groupBy("customer_sk", "channel")
        .agg(F.sum("net_paid").alias("paid"))
    )
    order = [F.desc_nulls_last("paid"), F.asc("channel")]
    return top1_per_group(paid, ["customer_sk"], order).select("customer_sk", "channel")


def date_anchor(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """The dataset's own "today": the last calendar date with a sale."""
    sold = sales.select(F.col("sold_date_sk").alias("date_key")).distinct()
    return sold.join(dates, "date_key").agg(F.max("calendar_date").alias("today"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
