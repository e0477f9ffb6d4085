"""Which checks run on which table, per layer."""

from __future__ import annotations

from tallyhouse.operators.quality import Check, between, in_set, not_null, references, unique
from tallyhouse.operators.anomalies import RETURN_RULES, SALES_RULES
from tallyhouse.operators.staging import CHANNELS
from tallyhouse.plans.marts import OTHER_SEGMENT, SEGMENTS

Suite = dict[str, list[Check]]

# --- fixed values: expectation suites ----------------------------------------
SEGMENT_NAMES = [name for name, _ in SEGMENTS] + [OTHER_SEGMENT]

EXPECTATIONS: dict[str, Suite] = {
    "bronze": {
        "customer": not_null("c_customer_sk") + unique("c_customer_sk", "c_customer_id"),
        "store_sales": not_null("ss_item_sk", "ss_ticket_number")
        + between("ss_quantity", 0, 1000, mostly=0.999)
        + between("ss_sales_price", 0, 100000, mostly=0.999),
        "catalog_sales": not_null("cs_item_sk", "cs_order_number"),
        "web_sales": not_null("ws_item_sk", "ws_order_number"),
        "date_dim": unique("d_date_sk") + not_null("d_date_sk") + between("d_year", 1900, 2100),
        "item": unique("i_item_sk"),
        "store": unique("s_store_sk"),
    },
    "silver": {
        "fact_sales": not_null("item_sk", "sold_date_sk")
        + in_set("channel", *CHANNELS)
        + between("quantity", 1, 1000)
        + between("sales_price", 0, 100000, mostly=0.999),
        "fact_returns": not_null("item_sk")
        + in_set("channel", *CHANNELS)
        + between("return_quantity", 1, 1000),
        "dim_customer": not_null("customer_key") + unique("customer_key"),
        "dim_item": not_null("item_key") + unique("item_key"),
        "dim_date": not_null("date_key")
        + unique("date_key")
        + between("calendar_year", 1900, 2100),
        "dim_store": unique("store_key"),
    },
    "gold": {
        "mart_sales_performance": not_null("date_key")
        + in_set("channel", *CHANNELS)
        + between("units_sold", 1),
        "mart_customer_360": not_null("customer_key")
        + unique("customer_key")
        + in_set("segment", *SEGMENT_NAMES, None),
        "mart_product_analytics": unique("item_key")
        + between("returns_rate", 0, 1, mostly=0.99),
        "mart_channel_comparison": in_set("channel", *CHANNELS)
        + between("share_of_total", 0, 1, mostly=0.99),
    },
}

# --- fixed values: tests that run with every build ----------------------------
KEY = lambda column: not_null(column) + unique(column)

BUILD_TESTS: dict[str, Suite] = {
    "bronze": {
        "store_sales": not_null("ss_item_sk", "ss_ticket_number"),
        "catalog_sales": not_null("cs_item_sk", "cs_order_number"),
        "web_sales": not_null("ws_item_sk", "ws_order_number"),
        "inventory": not_null("inv_item_sk", "inv_warehouse_sk", "inv_date_sk"),
        "customer": KEY("c_customer_sk") + KEY("c_customer_id"),
        "customer_address": KEY("ca_address_sk"),
        "customer_demographics": KEY("cd_demo_sk"),
        "date_dim": KEY("d_date_sk"),
        "time_dim": KEY("t_time_sk"),
        "item": KEY("i_item_sk"),
        "promotion": KEY("p_promo_sk"),
        "store": KEY("s_store_sk"),
    },
    "silver": {
        "dim_customer": KEY("customer_key")
        + not_null("customer_id")
        + in_set("is_preferred_customer", 0, 1),
        "dim_item": KEY("item_key") + not_null("item_id") + in_set("is_current", 0, 1),
        "dim_date": KEY("date_key") + between("calendar_year", 1900, 2100),
        "dim_store": KEY("store_key"),
        "dim_promotion": KEY("promo_key"),
        "fact_sales": not_null("channel", "item_sk", "sold_date_sk")
        + in_set("channel", *CHANNELS)
        + references("item_sk", "dim_item", "item_key")
        + references("sold_date_sk", "dim_date", "date_key")
        + between("quantity", 1),
        "fact_returns": not_null("channel", "item_sk")
        + in_set("channel", *CHANNELS)
        + references("item_sk", "dim_item", "item_key"),
        "fact_inventory": not_null("item_sk", "warehouse_sk", "date_sk"),
        "fact_sales__anomalies": not_null("_anomaly_reason")
        + in_set("_anomaly_reason", *[reason for reason, _ in SALES_RULES]),
        "fact_returns__anomalies": not_null("_anomaly_reason")
        + in_set("_anomaly_reason", *[reason for reason, _ in RETURN_RULES]),
        "dim_channel": KEY("channel_key")
        + not_null("channel_code")
        + in_set("channel_code", *CHANNELS),
    },
    "gold": {
        "mart_sales_performance": not_null("date_key", "channel")
        + references("date_key", "dim_date", "date_key")
        + in_set("channel", *CHANNELS)
        + between("units_sold", 1),
        "mart_customer_360": KEY("customer_key")
        + in_set("segment", *SEGMENT_NAMES)
        + between("r_score", 1, 5, where="r_score IS NOT NULL"),
        "mart_product_analytics": KEY("item_key")
        + not_null("rank_by_revenue")
        + between("returns_rate", 0, 1),
        "mart_channel_comparison": not_null("channel")
        + in_set("channel", *CHANNELS)
        + between("share_of_total", 0, 1),
    },
}
# --- end of fixed values -----------------------------------------------------
