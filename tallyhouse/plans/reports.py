"""Reporting queries over marts and operation logs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from threading import Timer

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import quotient
from tallyhouse.operators.ranking import with_position
from tallyhouse.sources.tables import each

SECONDS = "yyyy-MM-dd HH:mm:ss"


def _at(column: str) -> Column:
    return F.date_format(column, SECONDS).alias(column)


def recent_runs(run_log: DataFrame, limit: int = 50) -> DataFrame:
    ties = ["batch_id", "step", "status", "layer", "rows_in", "rows_out", "duration_sec"]
    latest = run_log.orderBy(F.desc("started_at"), *ties).limit(limit)
    return latest.select(
        "batch_id",
        "layer",
        "step",
        "status",
        "rows_in",
        "rows_out",
        _at("started_at"),
        "duration_sec",
        "tool",
    )


def dq_latest(dq_result: DataFrame, suite: str | None = None) -> DataFrame:
    """Results of the batch that ran last, failures first."""
    newest = F.max_by("batch_id", F.struct("run_at", "batch_id")).alias("newest")
    latest = dq_result.where(F.col("batch_id") == dq_result.agg(newest).scalar())
    if suite:
        latest = latest.where(F.col("suite") == suite)
    return latest.select(
        "suite", "table_name", "expectation", "success", "observed_value", _at("run_at")
    ).orderBy("success", "suite", "table_name", "expectation")


def layer_counts(
    spark: SparkSession,
    tables: dict[str, Callable[[], DataFrame]],
    at_once: int = 4,
    seconds: float | None = None,
) -> DataFrame:
    """Row count per table, or NULL and the error of one that cannot be counted.

    Each table is a job group of its own, several at once: a missing table, a lost file or a
    count that takes more than ``seconds`` fails its row alone.
    """
    context, run = spark.sparkContext, uuid.uuid4().hex[:8]

    def counted(name: str) -> tuple[int | None, str | None]:
        group = f"layer-counts-{run}-{name}"
        context.setJobGroup(group, f"rows of {name}", interruptOnCancel=True)
        late = Timer(seconds, context.cancelJobGroup, [group]) if seconds else None
        try:
            if late:
                late.start()
            return tables[name]().agg(F.count(F.lit(1))).first()[0], None
        except (PySparkException, Py4JError) as error:
            return None, str(error)
        finally:
            if late:
                late.cancel()
            context.setLocalProperty("spark.jobGroup.id", None)

    found = each(counted, tables, at_once)
    rows = [(name, *told) for name, told in found.items()]
    return spark.createDataFrame(rows, "table_name string, row_count bigint, error string")


def sales_summary(sales_performance: DataFrame) -> DataFrame:
    """Lifetime totals per channel; daily order counts add up as an order has one date."""
    totals = ["units_sold", "order_count", "gross_sales", "net_sales", "net_profit", "returns_amount"]
    return (
        sales_performance.groupBy("channel")
        .agg(*[F.sum(total).alias(total) for total in totals])
        .orderBy("channel")
    )


def top_products(product_analytics: DataFrame, limit: int = 20) -> DataFrame:
    best = product_analytics.orderBy("rank_by_revenue", "item_key").limit(limit)
    return best.select(
        "item_id",
        "product_name",
        "brand",
        "category",
        "units_sold",
        "gross_revenue",
        "returns_rate",
        "top_channel",
        "rank_by_revenue",
    )


def segment_summary(customer_360: DataFrame) -> DataFrame:
    def mean(column: str, kind: str):
        return quotient(F.sum(column), F.count(column)).cast(kind)

    whole_days = F.expr("SUM(recency_days) DIV NULLIF(COUNT(recency_days), 0)").cast("int")
    return (
        customer_360.where("segment IS NOT NULL")
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            mean("lifetime_value", "decimal(15,2)").alias("avg_ltv"),
            mean("frequency", "decimal(10,2)").alias("avg_frequency"),
            whole_days.alias("avg_recency_days"),
        )
        .orderBy(F.desc("customers"), "segment")
    )


def perf_runs(perf_log: DataFrame) -> DataFrame:
    """Benchmark runs, newest first, with the phases each one has."""

    def has(phase: str):
        return F.max(F.when(F.col("phase") == phase, 1).otherwise(0)).alias(f"has_{phase}")

    return (
        perf_log.groupBy("run_id")
        .agg(
            has("before"),
            has("after"),
            F.date_format(F.min("started_at"), SECONDS).alias("first_at"),
            F.count(F.lit(1)).alias("row_count"),
            F.max("started_at").alias("_last"),
        )
        .orderBy(F.desc("_last"), "run_id")
        .drop("_last")
    )


def perf_medians(perf_log: DataFrame) -> DataFrame:
    """Exact median duration per query and phase, from row positions."""
    group = ["query_name", "phase"]
    order = [F.asc("duration_sec"), F.asc("run_id"), F.asc("iteration")]
    timings = perf_log.select(*group, "duration_sec", "run_id", "iteration")
    placed = with_position(timings, "position", order, group, total="timings")
    middle = F.expr("position IN ((timings + 1) DIV 2, (timings + 2) DIV 2)")
    return placed.where(middle).groupBy(*group).agg(F.avg("duration_sec").alias("median_sec"))


def perf_compare(perf_log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Median seconds before and after per query; without ``run_id`` all runs are pooled."""
    if run_id:
        perf_log = perf_log.where(F.col("run_id") == run_id)
    speedup = quotient("before", "after").cast("decimal(10,2)")
    return (
        perf_medians(perf_log)
        .groupBy("query_name")
        .pivot("phase", ["before", "after"])
        .agg(F.first("median_sec"))
        .select(
            "query_name",
            F.col("before").cast("decimal(10,3)").alias("before_sec"),
            F.col("after").cast("decimal(10,3)").alias("after_sec"),
            (F.col("before") - F.col("after")).cast("decimal(10,3)").alias("delta_sec"),
            speedup.alias("speedup_x"),
        )
        .withColumn(
            "verdict",
            F.when(F.col("speedup_x") >= 1.10, "ok")
            .when(F.col("speedup_x") < 0.90, "bad")
            .otherwise(""),
        )
        .orderBy("query_name")
    )


def perf_raw(perf_log: DataFrame, run_id: str | None = None) -> DataFrame:
    if run_id:
        perf_log = perf_log.where(F.col("run_id") == run_id)
    return perf_log.select(
        "run_id",
        "phase",
        "query_name",
        "iteration",
        "duration_sec",
        "rows_returned",
        _at("started_at"),
    ).orderBy("query_name", "phase", "iteration", "run_id")
