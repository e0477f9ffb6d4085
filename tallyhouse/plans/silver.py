"""Bronze tables to silver frames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.operators import anomalies, dimensions
from tallyhouse.operators.staging import (
    CHANNELS,
    RETURN_SOURCES,
    SALE_SOURCES,
    stage_returns,
    stage_sales,
    union_channels,
)


def tagged_sales(bronze: dict[str, DataFrame]) -> DataFrame:
    staged = [stage_sales(bronze[SALE_SOURCES[c][0]], c) for c in CHANNELS]
    return anomalies.tag_anomalies(union_channels(staged), anomalies.SALES_RULES)


def tagged_returns(bronze: dict[str, DataFrame]) -> DataFrame:
    staged = [stage_returns(bronze[RETURN_SOURCES[c][0]], c) for c in CHANNELS]
    return anomalies.tag_anomalies(union_channels(staged), anomalies.RETURN_RULES)


def silver_frames(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All silver tables, lazily."""
    sales, returns = tagged_sales(bronze), tagged_returns(bronze)
    return {
        "dim_customer": dimensions.dim_customer(
            bronze["customer"],
            bronze["customer_address"],
            bronze["customer_demographics"],
            bronze["household_demographics"],
            bronze["income_band"],
        ),
        "dim_item": dimensions.dim_item(bronze["item"]),
        "dim_date": dimensions.dim_date(bronze["date_dim"]),
        "dim_store": dimensions.dim_store(bronze["store"]),
        "dim_promotion": dimensions.dim_promotion(bronze["promotion"]),
        "fact_sales": anomalies.fact_sales(sales),
        "fact_returns": anomalies.fact_returns(returns),
        "fact_inventory": dimensions.fact_inventory(bronze["inventory"]),
        "fact_sales__anomalies": anomalies.fact_sales_anomalies(sales),
        "fact_returns__anomalies": anomalies.fact_returns_anomalies(returns),
    }
