"""The five benchmark queries over silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import ratio


def annual_sales_by_channel(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Lines are summed per day before the calendar is joined."""
    days = sales.groupBy(F.col("sold_date_sk").alias("date_key"), "channel").agg(
        F.sum("net_paid").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("line_count"),
    )
    return (
        days.join(dates, "date_key")
        .groupBy("calendar_year", "channel")
        .agg(*[F.sum(c).alias(c) for c in ("revenue", "units", "line_count")])
        .orderBy("calendar_year", "channel")
    )


def top_customers(sales: DataFrame, customers: DataFrame, limit: int = 25) -> DataFrame:
    """Best customers by value; sales are summed per customer and channel before the join."""
    paid = sales.groupBy("customer_sk", "channel").agg(F.sum("net_paid").alias("paid"))
    return (
        paid.join(customers, F.col("customer_sk") == F.col("customer_key"))
        .groupBy("customer_id", "customer_name")
        .agg(
            F.sum("paid").alias("lifetime_value"),
            F.countDistinct("channel").alias("channels_used"),
        )
        .orderBy(F.desc_nulls_last("lifetime_value"), "customer_id", "customer_name")
        .limit(limit)
    )


def sales_by_category(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue and distinct customers of each category's current items.

    The join comes first: grouping by item and customer would not make the lines
    fewer, while category and customer do. A hot item is split by the adaptive skew
    join when the items are too large to broadcast.
    """
    return (
        sales.join(items.where("is_current = 1"), F.col("item_sk") == F.col("item_key"))
        .groupBy("category")
        .agg(
            F.sum("net_paid").alias("revenue"),
            F.countDistinct("customer_sk").alias("unique_customers"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def daily_sales_of_month(
    sales: DataFrame, dates: DataFrame, year: int = 2002, month: int = 1
) -> DataFrame:
    """One month by day and channel.

    With ``date_bucket`` on both sides the join also matches it, which lets the
    filter on the calendar prune the fact's partitions at run time.
    """
    keys = [sales["sold_date_sk"] == dates["date_key"]]
    if "date_bucket" in sales.columns and "date_bucket" in dates.columns:
        keys.append(sales["date_bucket"] == dates["date_bucket"])
    days = dates.where((F.col("calendar_year") == year) & (F.col("month_of_year") == month))
    return (
        sales.join(days, keys)
        .groupBy("calendar_date", "channel")
        .agg(F.sum("quantity").alias("units"), F.sum("net_paid").alias("revenue"))
        .orderBy("calendar_date", "channel")
    )


def returns_rate_by_brand(
    sales: DataFrame, returns: DataFrame, items: DataFrame, min_units: int = 1000
) -> DataFrame:
    """Units sold and returned per brand over the line-level join of sales and returns.

    The left join on (item, order) repeats a sale line for each return line of its key
    and the other way round. Its sums follow from per-key totals: units sold count
    max(1, return lines) times, units returned once per sale line. Each fact is summed per
    key and the sums are joined, so no pair of lines is built; over facts that are stored
    hashed by the key, neither the sums nor the join need a shuffle. Lines of expired item
    versions are left out before they are summed.
    """
    current = items.where("is_current = 1").select("item_key", "brand")
    is_current = F.col("item_sk") == F.col("item_key")
    sales = sales.join(current.select("item_key"), is_current, "left_semi")
    returns = returns.join(current.select("item_key"), is_current, "left_semi")
    sold = sales.groupBy("item_sk", "sale_order_id").agg(
        F.sum("quantity").alias("sold"), F.count(F.lit(1)).alias("sale_lines")
    )
    returned = (
        returns.dropna(subset=["item_sk", "return_order_id"])
        .groupBy("item_sk", F.col("return_order_id").alias("sale_order_id"))
        .agg(F.sum("return_quantity").alias("returned"), F.count(F.lit(1)).alias("return_lines"))
    )
    per_key = sold.join(returned, ["item_sk", "sale_order_id"], "left")
    lines = F.greatest(F.coalesce("return_lines", F.lit(0)), F.lit(1))
    per_item = (
        per_key.groupBy("item_sk")
        .agg(
            F.sum(F.col("sold") * lines).alias("units_sold"),
            F.sum(F.col("returned") * F.col("sale_lines")).alias("units_returned"),
        )
    )
    return (
        per_item.join(current, is_current)
        .groupBy("brand")
        .agg(
            F.sum("units_sold").alias("units_sold"),
            F.coalesce(F.sum("units_returned"), F.lit(0)).alias("units_returned"),
        )
        .where(F.col("units_sold") > min_units)
        .select(
            "brand",
            "units_sold",
            "units_returned",
            ratio("units_returned", "units_sold").alias("returns_rate"),
        )
        .orderBy(F.desc("returns_rate"), "brand")
    )
