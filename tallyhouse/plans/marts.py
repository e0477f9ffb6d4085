"""The four gold marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import ratio, zero_if_null
from tallyhouse.operators import rollups
from tallyhouse.operators.ranking import with_quintiles, with_ranks
from tallyhouse.session import settle

# --- fixed values: segments, the first matching rule wins ---------------------
SEGMENTS = (
    ("Champion", "r_score >= 4 AND f_score >= 4 AND m_score >= 4"),
    ("Loyal", "r_score >= 3 AND f_score >= 3"),
    ("New", "r_score >= 4 AND f_score <= 2"),
    ("At Risk", "r_score <= 2 AND f_score >= 3"),
    ("Lost", "r_score = 1"),
    ("Inactive", "r_score IS NULL"),
)
OTHER_SEGMENT = "Potential"
# --- end of fixed values -----------------------------------------------------


def mart_sales_performance(sales: DataFrame, returns: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per sale date and channel; days with returns only do not appear."""
    return (
        rollups.daily_sales(sales)
        .join(rollups.daily_returns(returns), ["date_key", "channel"], "left")
        .join(dates, "date_key")
        .select(
            "date_key",
            "calendar_date",
            "calendar_year",
            "quarter_of_year",
            "month_of_year",
            "day_of_week",
            "day_name",
            "is_weekend",
            "channel",
            "units_sold",
            "order_count",
            ratio("net_sales", "order_count", 2).alias("avg_order_value"),
            "gross_sales",
            "discount_amount",
            "tax_amount",
            "net_sales",
            "net_profit",
            ratio("net_profit", "gross_sales").alias("profit_margin"),
            zero_if_null("units_returned"),
            zero_if_null("returns_amount"),
            (F.col("gross_sales") - F.coalesce("returns_amount", F.lit(0))).alias("net_revenue"),
            ratio(F.coalesce("units_returned", F.lit(0)), F.col("units_sold")).alias(
                "returns_rate"
            ),
        )
    )


def with_channel_share(monthly: DataFrame) -> DataFrame:
    """Each channel's part of its month's gross sales; a month has one row per channel."""
    month = W.partitionBy("calendar_year", "month_of_year")
    share = ratio(F.col("gross_sales"), F.sum("gross_sales").over(month))
    return monthly.withColumn("share_of_total", share)


def mart_channel_comparison(sales: DataFrame, returns: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per month and channel; the returns rate is by money, not by units."""
    period = ["calendar_year", "month_of_year", "channel"]
    return (
        with_channel_share(rollups.monthly_sales(sales, dates))
        .join(rollups.monthly_returns(returns, dates), period, "left")
        .select(
            "calendar_year",
            "month_of_year",
            "quarter_of_year",
            "channel",
            "units_sold",
            "order_count",
            "unique_customers",
            "gross_sales",
            "net_sales",
            "net_profit",
            ratio("units_sold", "order_count", 2).alias("avg_basket_size"),
            ratio("net_sales", "order_count", 2).alias("avg_order_value"),
            ratio("net_profit", "gross_sales").alias("profit_margin"),
            zero_if_null("units_returned"),
            zero_if_null("returns_amount"),
            ratio(F.coalesce("returns_amount", F.lit(0)), F.col("gross_sales")).alias(
                "returns_rate"
            ),
            "share_of_total",
        )
    )


def mart_product_analytics(sales: DataFrame, returns: DataFrame, items: DataFrame) -> DataFrame:
    """One row per current item version, items without sales kept with zeros.

    Facts join on the version key, so sales of expired versions are not counted; their lines
    are left out before they are shuffled.
    """
    item_key = F.col("item_key")
    current = items.where("is_current = 1")
    keys = current.select("item_key")
    sales = sales.join(keys, F.col("item_sk") == item_key, "left_semi")
    returns = returns.join(keys, F.col("item_sk") == item_key, "left_semi")
    totals = (
        current.join(rollups.item_sales(sales), item_key == F.col("item_sk"), "left")
        .drop("item_sk")
        .join(rollups.item_returns(returns), item_key == F.col("item_sk"), "left")
        .select(
            "item_key",
            "item_id",
            "product_name",
            "brand",
            "category",
            "item_class",
            "manufacturer",
            "size",
            "color",
            "current_price",
            "wholesale_cost",
            zero_if_null("units_sold"),
            zero_if_null("gross_revenue"),
            zero_if_null("net_revenue"),
            zero_if_null("net_profit"),
            "avg_sales_price",
            zero_if_null("distinct_customers"),
            zero_if_null("units_returned"),
            zero_if_null("returns_amount"),
            ratio(F.coalesce("units_returned", F.lit(0)), F.col("units_sold")).alias(
                "returns_rate"
            ),
            "top_channel",
        )
    )
    ranks = {"rank_by_revenue": None, "rank_in_category": "category"}
    return with_ranks(totals, "gross_revenue", "item_key", ranks)


def rfm_scores(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Recency, frequency and money quintiles of the customers with sales.

    The most recent customers score 5; ties are broken by customer key.
    """
    customers = rollups.customer_sales(sales)
    last = dates.select(
        F.col("date_key").alias("last_purchase_date_key"),
        F.col("calendar_date").alias("last_purchase_date"),
    )
    today = rollups.date_anchor(sales, dates).scalar()
    recency = F.datediff(today, F.col("last_purchase_date"))
    customers = settle(
        customers.join(last, "last_purchase_date_key").withColumn("recency_days", recency)
    )
    return with_quintiles(
        customers,
        "customer_sk",
        {
            "r_score": F.negate("recency_days"),
            "f_score": F.col("frequency"),
            "m_score": F.col("lifetime_value"),
        },
    )


def segment_of() -> Column:
    label = F.lit(OTHER_SEGMENT)
    for name, rule in reversed(SEGMENTS):
        label = F.when(F.expr(rule), F.lit(name)).otherwise(label)
    return label


def mart_customer_360(sales: DataFrame, dates: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per customer, those without sales as Inactive."""
    scored = rfm_scores(sales, dates)
    code = F.concat(*[F.col(score).cast("string") for score in ("r_score", "f_score", "m_score")])
    return customers.join(
        scored, F.col("customer_key") == F.col("customer_sk"), "left"
    ).select(
        "customer_key",
        "customer_id",
        "customer_name",
        "email_address",
        "city",
        "state",
        "zip",
        "country",
        "gender",
        "marital_status",
        "education_status",
        "credit_rating",
        "income_lower_bound",
        "income_upper_bound",
        "is_preferred_customer",
        "first_purchase_date_key",
        "last_purchase_date_key",
        "last_purchase_date",
        "recency_days",
        "frequency",
        "lifetime_value",
        "lifetime_units",
        "channels_used",
        "r_score",
        "f_score",
        "m_score",
        code.alias("rfm_code"),
        segment_of().alias("segment"),
        "preferred_channel",
    )
