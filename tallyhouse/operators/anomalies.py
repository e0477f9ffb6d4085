"""Tag each row with the first business rule it breaks, then route it.

No row is lost: a frame's clean part and its anomalies add up to the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.staging import RETURN_FIELDS, SALE_FIELDS

REASON = "_anomaly_reason"

# --- fixed values: rules in order of priority; a NULL measure breaks none -----
SALES_RULES = (
    ("missing_item_sk", "item_sk IS NULL"),
    ("missing_order_id", "sale_order_id IS NULL"),
    ("missing_sold_date", "sold_date_sk IS NULL"),
    ("non_positive_quantity", "quantity <= 0"),
    ("negative_sales_price", "sales_price < 0"),
    ("negative_net_paid", "net_paid < 0"),
)
RETURN_RULES = (
    ("missing_item_sk", "item_sk IS NULL"),
    ("missing_order_id", "return_order_id IS NULL"),
    ("missing_returned_date", "returned_date_sk IS NULL"),
    ("non_positive_quantity", "return_quantity <= 0"),
    ("negative_return_amt", "return_amt < 0"),
)
# --- end of fixed values -----------------------------------------------------

SALES_FACT = ["channel", *SALE_FIELDS, "_batch_id"]
RETURNS_FACT = ["channel", *RETURN_FIELDS, "_batch_id"]


def tag_anomalies(df: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    reason = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        reason = F.when(F.expr(broken), F.lit(name)).otherwise(reason)
    return df.withColumn(REASON, reason)


def clean_rows(tagged: DataFrame, columns: list[str]) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).select(*columns)


def anomaly_rows(tagged: DataFrame, columns: list[str]) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull()).select(REASON, *columns)


def fact_sales(tagged: DataFrame) -> DataFrame:
    return clean_rows(tagged, SALES_FACT)


def fact_returns(tagged: DataFrame) -> DataFrame:
    return clean_rows(tagged, RETURNS_FACT)


def fact_sales_anomalies(tagged: DataFrame) -> DataFrame:
    return anomaly_rows(tagged, SALES_FACT)


def fact_returns_anomalies(tagged: DataFrame) -> DataFrame:
    return anomaly_rows(tagged, RETURNS_FACT)


def anomaly_breakdown(sidecars: dict[str, DataFrame]) -> DataFrame:
    """Rows per reason of each sidecar table."""
    counts = [
        df.groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.lit(name).alias("source_table"), REASON, "cnt")
        for name, df in sidecars.items()
    ]
    merged = counts[0]
    for part in counts[1:]:
        merged = merged.unionByName(part)
    return merged.orderBy("source_table", F.desc("cnt"), REASON)
