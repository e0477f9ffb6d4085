"""Six channel tables conformed to one sales shape and one returns shape.

A shape is the ordered list of unified fields. Per channel only the fields whose
raw name differs are listed; a field the raw table lacks becomes a typed NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.schemas import FIELDS, SCHEMAS, field_type

LINEAGE = ["_batch_id", "_ingested_at", "_source_file"]

# --- fixed values: unified field names and their raw names per channel -------
CHANNELS = ("store", "catalog", "web")

SALE_FIELDS = (
    "sale_order_id item_sk customer_sk cdemo_sk hdemo_sk addr_sk store_sk call_center_sk "
    "catalog_page_sk warehouse_sk web_page_sk web_site_sk ship_mode_sk promo_sk sold_date_sk "
    "ship_date_sk sold_time_sk quantity wholesale_cost list_price sales_price ext_discount_amt "
    "ext_sales_price ext_wholesale_cost ext_list_price ext_tax coupon_amt ext_ship_cost net_paid "
    "net_paid_inc_tax net_paid_inc_ship net_paid_inc_ship_tax net_profit"
).split()
RETURN_FIELDS = (
    "return_order_id item_sk refunded_customer_sk returning_customer_sk refunded_cdemo_sk "
    "refunded_hdemo_sk refunded_addr_sk store_sk call_center_sk catalog_page_sk warehouse_sk "
    "web_page_sk ship_mode_sk reason_sk returned_date_sk returned_time_sk return_quantity "
    "return_amt return_tax return_amt_inc_tax fee return_ship_cost refunded_cash "
    "reversed_charge credit net_loss"
).split()

# The payer is the customer of record, so the bill-to columns are taken.
BILLED = {
    "sale_order_id": "order_number",
    "customer_sk": "bill_customer_sk",
    "cdemo_sk": "bill_cdemo_sk",
    "hdemo_sk": "bill_hdemo_sk",
    "addr_sk": "bill_addr_sk",
}
SALE_SOURCES = {
    "store": ("store_sales", {"sale_order_id": "ticket_number"}),
    "catalog": ("catalog_sales", BILLED),
    "web": ("web_sales", BILLED),
}
RETURN_SOURCES = {
    "store": (
        "store_returns",
        {
            "return_order_id": "ticket_number",
            "refunded_customer_sk": "customer_sk",
            "returning_customer_sk": "customer_sk",
            "refunded_cdemo_sk": "cdemo_sk",
            "refunded_hdemo_sk": "hdemo_sk",
            "refunded_addr_sk": "addr_sk",
            "returned_time_sk": "return_time_sk",
            "credit": "store_credit",
            "return_ship_cost": None,  # never taken over for stores, though it is loaded
        },
    ),
    "catalog": (
        "catalog_returns",
        {"return_order_id": "order_number", "return_amt": "return_amount", "credit": "store_credit"},
    ),
    "web": ("web_returns", {"return_order_id": "order_number", "credit": "account_credit"}),
}
# --- end of fixed values -----------------------------------------------------


def raw_names(fields: list[str], source: tuple[str, dict]) -> dict[str, str | None]:
    """Unified field -> raw column of one channel, None where it has no such column."""
    table, renames = source
    prefix, known = FIELDS[table][0], set(SCHEMAS[table].names)
    raw = {field: renames.get(field, field) for field in fields}
    return {
        field: f"{prefix}_{name}" if name and f"{prefix}_{name}" in known else None
        for field, name in raw.items()
    }


def _null(field: str):
    unified_money = {"credit"}
    kind = "decimal(7,2)" if field in unified_money else field_type(field)
    return F.lit(None).cast(kind)


def _stage(raw: DataFrame, channel: str, fields: list[str], source: tuple[str, dict]) -> DataFrame:
    names = raw_names(fields, source)
    columns = [F.lit(channel).alias("channel")]
    for field in fields:
        column = F.col(names[field]) if names[field] else _null(field)
        if field.endswith("_order_id"):
            column = column.cast("bigint")
        columns.append(column.alias(field))
    return raw.select(*columns, *LINEAGE)


def stage_sales(raw: DataFrame, channel: str) -> DataFrame:
    return _stage(raw, channel, SALE_FIELDS, SALE_SOURCES[channel])


def stage_returns(raw: DataFrame, channel: str) -> DataFrame:
    return _stage(raw, channel, RETURN_FIELDS, RETURN_SOURCES[channel])


def union_channels(staged: list[DataFrame]) -> DataFrame:
    """UNION ALL of the channels, matched by column name."""
    return reduce(DataFrame.unionByName, staged)
