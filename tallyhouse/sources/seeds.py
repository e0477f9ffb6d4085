"""Seed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values -------------------------------------------------------------
DIM_CHANNEL = [(1, "store", "Store"), (2, "catalog", "Catalog"), (3, "web", "Web")]
# --- end of fixed values --------------------------------------------------------


def dim_channel(spark: SparkSession) -> DataFrame:
    columns = "channel_key int, channel_code string, channel_name string"
    return spark.createDataFrame(DIM_CHANNEL, columns)
