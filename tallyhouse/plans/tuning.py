"""Timing of queries, and the physical tuning measured by it."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import UTC, datetime
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import date_bucket
from tallyhouse.operators.dimensions import with_date_bucket
from tallyhouse.plans.placement import (
    BUCKET_DAYS,
    PLACEMENTS,
    bucket_bounds,
    bucket_count,
    gathered,
)
from tallyhouse.sources.schemas import PERF_LOG
from tallyhouse.sources.tables import (
    STORED,
    Layers,
    append_log,
    each,
    new_version,
    publish,
    remove_table,
    write_full,
)

# --- fixed values: columns worth statistics per table --------------------------
SILVER_STATISTICS = {
    "fact_sales": "channel item_sk customer_sk sold_date_sk store_sk promo_sk",
    "fact_returns": "channel item_sk refunded_customer_sk returned_date_sk return_order_id",
    "fact_inventory": "item_sk warehouse_sk date_sk",
    "dim_customer": "customer_key customer_id state",
    "dim_date": "date_key calendar_year month_of_year",
    "dim_item": "item_key category brand is_current",
    "dim_store": "store_key state",
    "dim_promotion": "promo_key",
}
GOLD_STATISTICS = {
    "mart_sales_performance": "date_key channel calendar_year month_of_year",
    "mart_customer_360": "customer_key segment preferred_channel",
    "mart_product_analytics": "item_key category brand",
    "mart_channel_comparison": "calendar_year month_of_year channel",
}
# --- end of fixed values ---------------------------------------------------------


def time_queries(
    spark: SparkSession,
    queries: dict[str, Callable[[], DataFrame]],
    run_id: str,
    phase: str,
    iterations: int = 3,
) -> DataFrame:
    """Run each query to the end without keeping its rows; one timing row per iteration."""
    timings = []
    for name, build in queries.items():
        for iteration in range(1, iterations + 1):
            started, clock = datetime.now(UTC).replace(microsecond=0), time.monotonic()
            seen = Observation()
            rows = build().observe(seen, F.count(F.lit(1)).alias("rows"))
            rows.write.format("noop").mode("overwrite").save()
            seconds = Decimal(str(round(time.monotonic() - clock, 3)))
            timings.append(
                (run_id, phase, name, iteration, seconds, seen.get["rows"], started, None)
            )
    return spark.createDataFrame(timings, PERF_LOG)


def benchmark(
    spark: SparkSession,
    queries: dict[str, Callable[[], DataFrame]],
    layers: Layers,
    run_id: str,
    phase: str,
    iterations: int = 3,
) -> DataFrame:
    """Time the queries and append the timings to the performance log."""
    timings = time_queries(spark, queries, run_id, phase, iterations)
    append_log(timings, layers.perf_log)
    return timings


def analyze(spark: SparkSession, table: str, columns: str) -> None:
    listed = ", ".join(columns.split())
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {listed}")


def collect_statistics(
    spark: SparkSession, layers: Layers, layer: str | None = None
) -> dict[str, str]:
    """Column statistics of the planned tables of one layer or both; the reason per table
    that has none."""
    plans = {"silver": SILVER_STATISTICS, "gold": GOLD_STATISTICS}
    wanted = {
        f"{getattr(layers, name)}.{table}": columns
        for name, plan in plans.items()
        if layer in (None, name)
        for table, columns in plan.items()
    }

    def outcome(table: str) -> str:
        try:
            analyze(spark, table, wanted[table])
        except AnalysisException as missing:
            return f"no statistics: {missing}"
        return "analyzed"

    return {table.split(".")[1]: told for table, told in each(outcome, wanted).items()}


def bucketed_sales(sales: DataFrame) -> DataFrame:
    """The fact with its ``date_bucket``, bounds taken in the same plan."""
    bounds = sales.agg(
        (F.min("sold_date_sk") - BUCKET_DAYS).alias("low"),
        (F.max("sold_date_sk") + BUCKET_DAYS).alias("high"),
    )
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    return sales.withColumn("date_bucket", date_bucket("sold_date_sk", low, high, BUCKET_DAYS))


def rewrite_by_date_bucket(spark: SparkSession, layers: Layers) -> tuple[int, int]:
    """Rewrite the stored facts as the build places them, for tables that were stored
    otherwise: date buckets, in each the hash buckets of item and order. The calendar gets
    the same date buckets. All are published by rename, and the new versions analyzed.
    """
    calendar = f"{layers.silver}.dim_date"
    facts = [f for f in PLACEMENTS if spark.catalog.tableExists(f"{layers.silver}.{f}")]
    rows = {f: spark.table(f"{layers.silver}.{f}").drop("date_bucket") for f in facts}
    bounds = bucket_bounds(rows["fact_sales"])
    if bounds is None:
        raise ValueError("no dated sales to bucket")
    buckets = bucket_count(rows["fact_sales"].count())
    for fact, df in rows.items():
        new = f"{layers.silver}.{fact}_bucketed"
        keys = list(PLACEMENTS[fact].keys)
        remove_table(spark, new)
        folder = new_version(spark, new)
        for placed in gathered(df, PLACEMENTS[fact], bounds, buckets):
            writer = placed.write.format("parquet").options(**STORED, path=folder).mode("append")
            writer.partitionBy("date_bucket").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(new)
    dates = with_date_bucket(spark.table(calendar).drop("date_bucket"), *bounds, BUCKET_DAYS)
    write_full(dates, f"{calendar}_bucketed")
    for table in (*[f"{layers.silver}.{f}" for f in facts], calendar):
        publish(spark, f"{table}_bucketed", table, f"{table}_unbucketed")
        analyze(spark, table, SILVER_STATISTICS[table.split(".")[1]])
    return bounds


def write_hashed(df: DataFrame, table: str, buckets: int, keys: list[str]) -> None:
    """Store a table hashed by its join keys, so joins on them need no shuffle."""
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(
        table
    )
