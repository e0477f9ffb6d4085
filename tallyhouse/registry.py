"""Every query by name, over a folder of the driver's tables.

Each takes the whole tables. Results leave with plain types: decimals as double,
dates and timestamps as text, so that engines can be compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.expressions import date_bucket
from tallyhouse.operators import anomalies, quality, ranking, rollups
from tallyhouse.operators.dimensions import with_date_bucket
from tallyhouse.operators.quality import between, in_set, not_null, references, unique
from tallyhouse.operators.staging import (
    CHANNELS,
    RETURN_SOURCES,
    SALE_SOURCES,
    stage_returns,
    stage_sales,
)
from tallyhouse.plans import (
    benchmark_queries,
    column_groups,
    marts,
    placement,
    reports,
    silver,
    suites,
    tuning,
)
from tallyhouse.plans.full_run import WarehouseRun, run_warehouse
from tallyhouse.session import settle, shared_dir, shuffles_dropped
from tallyhouse.sources import runlog, seeds
from tallyhouse.sources.adapter import DriverTables
from tallyhouse.sources.delimited import load_all, write_raw
from tallyhouse.sources.tables import (
    Layers,
    delete_folder,
    ensure_layout,
    remove_table,
    write_full,
)

Query = Callable[[DriverTables], DataFrame]

GIVEN_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
RUN_AT = datetime(2026, 1, 1, tzinfo=UTC)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType)):
            column = column.cast("int")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- sources -------------------------------------------------------------------


@query
def bronze_lineage(d: DriverTables) -> DataFrame:
    return d.loaded("orders")


@query
def bronze_row_counts(d: DriverTables) -> DataFrame:
    return rollups.row_counts({name: d.table(name) for name in GIVEN_TABLES})


@query
def dim_channel(d: DriverTables) -> DataFrame:
    """The seed with each channel's clean sales lines."""
    lines = d.sales.groupBy("channel").agg(F.count(F.lit(1)).alias("sales_lines"))
    seed = seeds.dim_channel(d.spark)
    return seed.join(lines, F.col("channel_code") == F.col("channel"), "left").drop("channel")


# --- staging, anomaly routing, dimensions -----------------------------------------


@query
def stg_store_sales(d: DriverTables) -> DataFrame:
    return stage_sales(d.raw_sales("store"), "store")


@query
def stg_catalog_sales(d: DriverTables) -> DataFrame:
    return stage_sales(d.raw_sales("catalog"), "catalog")


@query
def stg_web_sales(d: DriverTables) -> DataFrame:
    return stage_sales(d.raw_sales("web"), "web")


@query
def stg_store_returns(d: DriverTables) -> DataFrame:
    return stage_returns(d.raw_returns("store"), "store")


@query
def stg_catalog_returns(d: DriverTables) -> DataFrame:
    return stage_returns(d.raw_returns("catalog"), "catalog")


@query
def stg_web_returns(d: DriverTables) -> DataFrame:
    return stage_returns(d.raw_returns("web"), "web")


@query
def int_sales_tagged(d: DriverTables) -> DataFrame:
    d.share_lines()
    return silver.tagged_sales({SALE_SOURCES[c][0]: d.raw_sales(c) for c in CHANNELS})


@query
def int_returns_tagged(d: DriverTables) -> DataFrame:
    d.share_lines()
    return silver.tagged_returns({RETURN_SOURCES[c][0]: d.raw_returns(c) for c in CHANNELS})


@query
def fact_sales(d: DriverTables) -> DataFrame:
    return d.sales


@query
def fact_returns(d: DriverTables) -> DataFrame:
    return d.returns


@query
def fact_sales_anomalies(d: DriverTables) -> DataFrame:
    return anomalies.fact_sales_anomalies(d.tagged_sales)


@query
def fact_returns_anomalies(d: DriverTables) -> DataFrame:
    return anomalies.fact_returns_anomalies(d.tagged_returns)


@query
def anomaly_breakdown(d: DriverTables) -> DataFrame:
    return anomalies.anomaly_breakdown(
        {
            "fact_sales__anomalies": fact_sales_anomalies(d),
            "fact_returns__anomalies": fact_returns_anomalies(d),
        }
    )


@query
def dim_customer(d: DriverTables) -> DataFrame:
    return d.customers


@query
def dim_date(d: DriverTables) -> DataFrame:
    return d.dates


@query
def dim_item(d: DriverTables) -> DataFrame:
    return d.items


@query
def dim_promotion(d: DriverTables) -> DataFrame:
    return d.promotions


@query
def dim_store(d: DriverTables) -> DataFrame:
    return d.stores


@query
def fact_inventory(d: DriverTables) -> DataFrame:
    return d.stock


# --- aggregation steps --------------------------------------------------------------


@query
def daily_sales(d: DriverTables) -> DataFrame:
    return rollups.daily_sales(d.sales)


@query
def daily_returns(d: DriverTables) -> DataFrame:
    return rollups.daily_returns(d.returns)


@query
def monthly_sales(d: DriverTables) -> DataFrame:
    return rollups.monthly_sales(d.sales, d.dates)


def _daily_keys(d: DriverTables) -> DataFrame:
    return settle(rollups.daily_keys(d.sales))


@query
def monthly_sales_from_days(d: DriverTables) -> DataFrame:
    """Month totals and distinct counts from daily totals and one daily state of keys."""
    return rollups.monthly_from_days(rollups.daily_sales(d.sales), _daily_keys(d), d.dates)


@query
def unique_per_year(d: DriverTables) -> DataFrame:
    """Distinct orders and customers of each year, all channels, from the daily state."""
    return rollups.unique_per_year(_daily_keys(d), d.dates)


@query
def monthly_returns(d: DriverTables) -> DataFrame:
    return rollups.monthly_returns(d.returns, d.dates)


@query
def item_sales(d: DriverTables) -> DataFrame:
    return rollups.item_sales(d.sales).drop("top_channel")


@query
def item_returns(d: DriverTables) -> DataFrame:
    return rollups.item_returns(d.returns)


@query
def item_top_channel(d: DriverTables) -> DataFrame:
    return rollups.item_top_channel(d.sales)


@query
def customer_sales(d: DriverTables) -> DataFrame:
    return rollups.customer_sales(d.sales).drop("preferred_channel")


@query
def preferred_channel(d: DriverTables) -> DataFrame:
    return rollups.preferred_channel(d.sales)


@query
def date_anchor(d: DriverTables) -> DataFrame:
    return rollups.date_anchor(d.sales, d.dates)


@query
def rfm_scores(d: DriverTables) -> DataFrame:
    return marts.rfm_scores(d.sales, d.dates).select(
        "customer_sk",
        "recency_days",
        "frequency",
        "lifetime_value",
        "r_score",
        "f_score",
        "m_score",
    )


@query
def channel_share(d: DriverTables) -> DataFrame:
    return marts.with_channel_share(monthly_sales(d)).select(
        "calendar_year", "month_of_year", "channel", "gross_sales", "share_of_total"
    )


# --- marts ---------------------------------------------------------------------------


@query
def mart_sales_performance(d: DriverTables) -> DataFrame:
    return marts.mart_sales_performance(d.sales, d.returns, d.dates)


@query
def mart_customer_360(d: DriverTables) -> DataFrame:
    return marts.mart_customer_360(d.sales, d.dates, d.customers)


@query
def mart_product_analytics(d: DriverTables) -> DataFrame:
    return marts.mart_product_analytics(d.sales, d.returns, d.items)


@query
def mart_channel_comparison(d: DriverTables) -> DataFrame:
    return marts.mart_channel_comparison(d.sales, d.returns, d.dates)


# --- benchmark queries -----------------------------------------------------------------


@query
def annual_sales_by_channel(d: DriverTables) -> DataFrame:
    return benchmark_queries.annual_sales_by_channel(d.sales, d.dates)


@query
def top_25_customers(d: DriverTables) -> DataFrame:
    return benchmark_queries.top_customers(d.sales, d.customers)


@query
def sales_by_category(d: DriverTables) -> DataFrame:
    return benchmark_queries.sales_by_category(d.sales, d.items)


@query
def daily_sales_one_month(d: DriverTables) -> DataFrame:
    return benchmark_queries.daily_sales_of_month(d.sales, d.dates, 2001, 1)


@query
def returns_rate_by_brand(d: DriverTables) -> DataFrame:
    return benchmark_queries.returns_rate_by_brand(d.sales, d.returns, d.items)


@query
def returns_rate_of_big_brands(d: DriverTables) -> DataFrame:
    """The same with a threshold that splits the brands at the checked scale."""
    return benchmark_queries.returns_rate_by_brand(d.sales, d.returns, d.items, 30000)


@query
def fact_sales_bucketed(d: DriverTables) -> DataFrame:
    return tuning.bucketed_sales(d.sales)


# --- reports ----------------------------------------------------------------------------


@query
def recent_runs(d: DriverTables) -> DataFrame:
    return reports.recent_runs(runlog.run_log_state(d.run_log()))


@query
def run_log_state(d: DriverTables) -> DataFrame:
    return runlog.run_log_state(d.run_log())


@query
def dq_latest(d: DriverTables) -> DataFrame:
    return reports.dq_latest(d.dq_result())


@query
def layer_counts(d: DriverTables) -> DataFrame:
    tables = {
        "dim_customer": lambda: d.customers,
        "dim_item": lambda: d.items,
        "dim_date": lambda: d.dates,
        "dim_store": lambda: d.stores,
        "fact_sales": lambda: d.sales,
        "fact_returns": lambda: d.returns,
        "fact_inventory": lambda: d.stock,
        "fact_sales__anomalies": lambda: fact_sales_anomalies(d),
        "fact_returns__anomalies": lambda: fact_returns_anomalies(d),
        "mart_sales_performance": lambda: mart_sales_performance(d),
        "mart_customer_360": lambda: mart_customer_360(d),
        "mart_product_analytics": lambda: mart_product_analytics(d),
        "mart_channel_comparison": lambda: mart_channel_comparison(d),
    }
    return reports.layer_counts(d.spark, tables)


@query
def sales_summary(d: DriverTables) -> DataFrame:
    return reports.sales_summary(mart_sales_performance(d))


@query
def top_products(d: DriverTables) -> DataFrame:
    return reports.top_products(mart_product_analytics(d))


@query
def segment_summary(d: DriverTables) -> DataFrame:
    return reports.segment_summary(mart_customer_360(d))


@query
def perf_runs(d: DriverTables) -> DataFrame:
    return reports.perf_runs(d.perf_log())


@query
def perf_compare(d: DriverTables) -> DataFrame:
    return reports.perf_compare(d.perf_log())


@query
def perf_raw(d: DriverTables) -> DataFrame:
    return reports.perf_raw(d.perf_log(), "perf-3")


# --- data quality ---------------------------------------------------------------------------


def _counts(suite: suites.Suite, tables: dict[str, DataFrame]) -> DataFrame:
    return quality.check_tables(suite, tables).drop("mostly")


@query
def dq_not_null(d: DriverTables) -> DataFrame:
    suite = {
        "sales": not_null("item_sk", "sale_order_id", "sold_date_sk", "customer_sk", "quantity"),
        "returns": not_null("item_sk", "return_order_id", "returned_date_sk", "return_amt"),
    }
    return _counts(suite, {"sales": d.tagged_sales, "returns": d.tagged_returns})


@query
def dq_unique(d: DriverTables) -> DataFrame:
    suite = {
        "customer": unique("c_customer_sk", "c_customer_id", "c_first_name"),
        "item": unique("i_item_sk", "i_item_id"),
        "sales": unique("sale_order_id"),
    }
    return _counts(suite, {"customer": d.customer(), "item": d.item(), "sales": d.tagged_sales})


@query
def dq_in_set(d: DriverTables) -> DataFrame:
    suite = {
        "sales": in_set("channel", "store", "catalog", "web") + in_set("quantity", 1, 2, 3),
        "item": in_set("i_manufact_id", 1) + in_set("i_class_id", 0, 1, 2, None),
    }
    return _counts(suite, {"sales": d.tagged_sales, "item": d.item()})


@query
def dq_range(d: DriverTables) -> DataFrame:
    suite = {
        "sales": between("quantity", 1)
        + between("quantity", None, 40)
        + between("sales_price", 0, 100000)
        + between("net_paid", 0, where="channel = 'web'"),
        "returns": between("return_amt", 0) + between("return_quantity", 1, 20),
    }
    return _counts(suite, {"sales": d.tagged_sales, "returns": d.tagged_returns})


@query
def dq_mostly(d: DriverTables) -> DataFrame:
    suite = {
        "sales": between("sales_price", 0, 100000, mostly=0.999)
        + between("quantity", 1, 1000, mostly=0.9999)
        + in_set("channel", "store", "web", mostly=0.6),
        "returns": between("return_amt", 0, mostly=0.99),
    }
    return _counts(suite, {"sales": d.tagged_sales, "returns": d.tagged_returns})


@query
def dq_relationships(d: DriverTables) -> DataFrame:
    current = d.items.where("is_current = 1")
    suite = {
        "fact_sales": references("item_sk", "dim_item", "item_key")
        + references("sold_date_sk", "dim_date", "date_key")
        + references("item_sk", "current_item", "item_key"),
        "fact_returns": references("item_sk", "dim_item", "item_key")
        + references("returning_customer_sk", "dim_customer", "customer_key"),
    }
    tables = {
        "fact_sales": d.sales,
        "fact_returns": d.returns,
        "dim_item": d.items,
        "current_item": current,
        "dim_date": d.dates,
        "dim_customer": d.customers,
    }
    return quality.check_tables(suite, tables).drop("mostly")


def _silver(d: DriverTables) -> dict[str, DataFrame]:
    return {
        "fact_sales": d.sales,
        "fact_returns": d.returns,
        "dim_customer": d.customers,
        "dim_item": d.items,
        "dim_date": d.dates,
        "dim_store": d.stores,
        "dim_promotion": d.promotions,
        "fact_inventory": d.stock,
        "fact_sales__anomalies": fact_sales_anomalies(d),
        "fact_returns__anomalies": fact_returns_anomalies(d),
        "dim_channel": seeds.dim_channel(d.spark),
    }


def _gold(d: DriverTables) -> dict[str, DataFrame]:
    built = {
        "mart_sales_performance": mart_sales_performance(d),
        "mart_customer_360": mart_customer_360(d),
        "mart_product_analytics": mart_product_analytics(d),
        "mart_channel_comparison": mart_channel_comparison(d),
    }
    return {name: settle(df) for name, df in built.items()}


@query
def dq_suite_bronze(d: DriverTables) -> DataFrame:
    return _counts(suites.EXPECTATIONS["bronze"], d.raw_tables())


@query
def dq_suite_silver(d: DriverTables) -> DataFrame:
    return _counts(suites.EXPECTATIONS["silver"], _silver(d))


@query
def dq_suite_gold(d: DriverTables) -> DataFrame:
    return _counts(suites.EXPECTATIONS["gold"], _gold(d))


@query
def build_tests_bronze(d: DriverTables) -> DataFrame:
    return _counts(suites.BUILD_TESTS["bronze"], d.raw_tables())


@query
def build_tests_silver(d: DriverTables) -> DataFrame:
    return _counts(suites.BUILD_TESTS["silver"], _silver(d))


@query
def build_tests_gold(d: DriverTables) -> DataFrame:
    return _counts(suites.BUILD_TESTS["gold"], {**_gold(d), "dim_date": d.dates})


@query
def dq_result_rows(d: DriverTables) -> DataFrame:
    """Verdicts in the shape of the result log."""
    checked = quality.check_tables(suites.EXPECTATIONS["silver"], _silver(d))
    return quality.as_dq_result(checked, "silver", "driver", RUN_AT)


@query
def dq_sample(d: DriverTables) -> DataFrame:
    """A check of a tenth of the rows, on request, sees about a tenth of them."""
    orders = d.table("orders")
    checked = quality.check_tables({"orders": unique("o_orderkey")}, {"orders": orders}, 0.1, 7)
    share = F.col("element_count") / orders.agg(F.count(F.lit(1))).scalar()
    within = F.when(share.between(0.05, 0.2), 1).otherwise(0)
    return checked.select("table_name", "column_name", within.alias("within"), "success")


@query
def dq_sample_rows(d: DriverTables) -> DataFrame:
    """Checks over exactly 1,000 orders, the same ones in any engine that has MD5."""
    orders = d.table("orders")
    suite = {
        "orders": unique("o_orderkey", "o_custkey")
        + between("o_totalprice", None, 150000)
        + in_set("o_orderstatus", "F")
        + references("o_custkey", "customer", "c_custkey")
    }
    tables = {"orders": orders, "customer": d.table("customer").where("c_custkey % 2 = 0")}
    checked = quality.check_tables(suite, tables, seed=7, rows=1000, sample_by=["o_orderkey"])
    return checked.drop("mostly")


@query
def quintile_with_nulls(d: DriverTables) -> DataFrame:
    """Quintiles of fine doubles and of dates, both with NULLs."""
    orders = d.table("orders").selectExpr(
        "o_orderkey",
        "IF(o_orderkey % 3 = 0, NULL, o_totalprice * 1e-9D) AS price",
        "IF(o_orderkey % 5 <> 1, CAST(o_orderdate AS DATE), NULL) AS day",
    )
    measures = {"by_price": F.col("price"), "by_day": F.col("day")}
    scored = ranking.with_quintiles(settle(orders), "o_orderkey", measures)
    return scored.select("o_orderkey", "by_price", "by_day")


# --- stored layers: files, the whole run, gate, tuning -------------------------------------


@contextmanager
def own_layers(spark: SparkSession) -> Iterator[Layers]:
    """Databases of a query's own in the shared folder, dropped with their files at its end."""
    tag = uuid.uuid4().hex[:8]
    layers = Layers(*[f"{layer}_{tag}" for layer in ("bronze", "silver", "gold", "dq")])
    try:
        ensure_layout(spark, layers, f"{shared_dir(spark)}/{tag}")
        with shuffles_dropped(spark):
            yield layers
    finally:
        for database in layers.names():
            if spark.catalog.databaseExists(database):
                for table in spark.catalog.listTables(database):
                    remove_table(spark, f"{database}.{table.name}")
                spark.sql(f"DROP DATABASE {database} CASCADE")


@contextmanager
def raw_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for raw files in the shared folder, removed with them at the end."""
    folder = f"{shared_dir(spark)}/raw-{uuid.uuid4().hex[:8]}"
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


@query
def bronze_from_files(d: DriverTables) -> DataFrame:
    """Rows per table after a load of all raw files."""
    with own_layers(d.spark) as layers, raw_folder(d.spark) as folder:
        d.write_raw_files(folder)
        loaded = load_all(d.spark, folder, "driver", layers, keep_files=False)
        tables = {name: d.spark.table(f"{layers.bronze}.{name}") for name in loaded}
        return settle(rollups.row_counts(tables))


@query
def customer_from_file(d: DriverTables) -> DataFrame:
    """Values of one table loaded from its file: quotes, separators, padding, empty fields."""
    with own_layers(d.spark) as layers, raw_folder(d.spark) as folder:
        write_raw(d.customer(), f"{folder}/customer.dat", "customer")
        load_all(d.spark, folder, "driver", layers, include={"customer"})
        names = "customer_sk customer_id first_name last_name preferred_cust_flag birth_year"
        loaded = d.spark.table(f"{layers.bronze}.customer")
        return settle(loaded.select(*[f"c_{name}" for name in names.split()]))


@query
def quoted_breaks_from_file(d: DriverTables) -> DataFrame:
    """Texts with line breaks, quotes and separators in them, loaded from a raw file."""
    texts = d.spark.read.parquet(f"{d.folder}/documents.parquet")
    reasons = texts.selectExpr("cast(doc_id as int) r_reason_sk", "source r_reason_id", "text r_reason_desc")
    with own_layers(d.spark) as layers, raw_folder(d.spark) as folder:
        write_raw(reasons, f"{folder}/reason.dat", "reason")
        load_all(d.spark, folder, "driver", layers, include={"reason"})
        return settle(d.spark.table(f"{layers.bronze}.reason").select(*reasons.columns))


@query
def full_run_steps(d: DriverTables) -> DataFrame:
    """A whole run over the driver data as raw files.

    The data is dirty on purpose, so the gates are logged but do not stop the run.
    """
    with own_layers(d.spark) as layers, raw_folder(d.spark) as folder:
        d.write_raw_files(folder)
        run_warehouse(
            d.spark, layers, folder, batch_id="driver", stop_on_failure=False, keep_files=False
        )
        state = runlog.run_log_state(d.spark.table(layers.run_log))
        return settle(state.select("batch_id", "layer", "step", "status", "rows_in", "rows_out"))


@query
def gate_steps(d: DriverTables) -> DataFrame:
    """Two gated checks of one table: sound keys pass, repeated ids stop the run."""
    with own_layers(d.spark) as layers:
        write_full(d.item(), f"{layers.bronze}.item")
        run = WarehouseRun(d.spark, layers, "driver")
        run.check("bronze", {"item": unique("i_item_sk")}, "dq_keys", "keys")
        try:
            suite = {"item": unique("i_item_id") + not_null("i_item_id")}
            run.check("bronze", suite, "dq_versions", "versions")
        except quality.ChecksFailed:
            pass  # the log has it
        steps = runlog.run_log_state(d.spark.table(layers.run_log)).select("step", "status")
        verdicts = d.spark.table(layers.dq_result).groupBy(
            F.concat(F.lit("dq_"), F.col("suite")).alias("step")
        )
        failed = F.count_if(F.col("success") == 0).alias("failed_checks")
        return settle(steps.join(verdicts.agg(failed, F.count("*").alias("checks")), "step"))


def _tuned(d: DriverTables, layers: Layers) -> None:
    for name, df in {"fact_sales": d.sales, "dim_date": d.dates}.items():
        write_full(df, f"{layers.silver}.{name}")
    tuning.rewrite_by_date_bucket(d.spark, layers)


@query
def daily_sales_tuned(d: DriverTables) -> DataFrame:
    """The one-month query over the fact and calendar in date buckets."""
    with own_layers(d.spark) as layers:
        _tuned(d, layers)
        sales, dates = (d.spark.table(f"{layers.silver}.{t}") for t in ("fact_sales", "dim_date"))
        return settle(benchmark_queries.daily_sales_of_month(sales, dates, 2001, 1))


@query
def published_versions(d: DriverTables) -> DataFrame:
    """Rows of the published and the kept versions after a second tuning."""
    with own_layers(d.spark) as layers:
        _tuned(d, layers)
        tuning.rewrite_by_date_bucket(d.spark, layers)
        names = ["fact_sales", "fact_sales_unbucketed", "dim_date", "dim_date_unbucketed"]
        tables = {name: d.spark.table(f"{layers.silver}.{name}") for name in names}
        return settle(rollups.row_counts(tables))


@query
def hashed_join(d: DriverTables) -> DataFrame:
    """Sale lines with their return lines, from tables hashed by the join's keys."""
    with own_layers(d.spark) as layers:
        parts = int(d.spark.conf.get("spark.sql.shuffle.partitions"))
        sales, returns = f"{layers.silver}.sales_hashed", f"{layers.silver}.returns_hashed"
        back = d.returns.withColumnRenamed("return_order_id", "sale_order_id").drop("channel")
        keys = ["item_sk", "sale_order_id"]
        tuning.write_hashed(d.sales.select("channel", *keys), sales, parts, keys)
        tuning.write_hashed(back.select(*keys, "return_quantity"), returns, parts, keys)
        joined = d.spark.table(sales).join(d.spark.table(returns), keys)
        units = F.sum("return_quantity").alias("units_returned")
        return settle(joined.groupBy("channel").agg(F.count("*").alias("pairs"), units))


def _placed(d: DriverTables, layers: Layers, times: int) -> dict[str, DataFrame]:
    """Facts, calendar and items as the build stores them, after so many builds."""
    bounds = placement.bucket_bounds(d.sales)
    tagged = {"fact_sales": d.tagged_sales, "fact_returns": d.tagged_returns}
    write_full(with_date_bucket(d.dates, *bounds, placement.BUCKET_DAYS), f"{layers.silver}.dim_date")
    write_full(d.items, f"{layers.silver}.dim_item")
    buckets = placement.bucket_count(d.table("lineitem").count())
    for _ in range(times):
        placement.store_facts(d.spark, layers, tagged, bounds, buckets)
    names = ["fact_sales", "fact_returns", "fact_sales__anomalies", "dim_date", "dim_item"]
    return {name: d.spark.table(f"{layers.silver}.{name}") for name in names}


@query
def placed_facts(d: DriverTables) -> DataFrame:
    """Lines per date bucket of the stored facts after a second build."""
    with own_layers(d.spark) as layers:
        stored = _placed(d, layers, 2)
        counts = [
            stored[name].groupBy("date_bucket").count().select(F.lit(name).alias("table_name"), "*")
            for name in ("fact_sales", "fact_sales__anomalies", "fact_returns")
        ]
        return settle(reduce(DataFrame.unionByName, counts).withColumnRenamed("count", "row_count"))


@query
def daily_sales_placed(d: DriverTables) -> DataFrame:
    """The one-month query over the facts as the build stores them."""
    with own_layers(d.spark) as layers:
        stored = _placed(d, layers, 1)
        return settle(
            benchmark_queries.daily_sales_of_month(stored["fact_sales"], stored["dim_date"], 2001, 1)
        )


@query
def returns_rate_placed(d: DriverTables) -> DataFrame:
    """Returns per brand over the facts as the build stores them, hashed by item and order."""
    with own_layers(d.spark) as layers:
        stored = _placed(d, layers, 1)
        facts = (stored[name] for name in ("fact_sales", "fact_returns", "dim_item"))
        return settle(benchmark_queries.returns_rate_by_brand(*facts, 30000))


@query
def failed_load(d: DriverTables) -> DataFrame:
    """Rows of a raw table after a load, and after a second load that fails in the middle."""
    with own_layers(d.spark) as layers, raw_folder(d.spark) as folder:
        table, counts = f"{layers.bronze}.customer", []
        for batch, spoilt in (("first", False), ("second", True)):
            customers = d.customer().withColumn(
                "c_birth_year", F.lit("MCMXC") if spoilt else F.col("c_birth_year")
            )
            write_raw(customers, f"{folder}/{batch}/customer.dat", "customer")
            try:
                load_all(d.spark, f"{folder}/{batch}", batch, layers, include={"customer"})
                outcome = "loaded"
            except (PySparkException, Py4JError):
                outcome = "failed"
            rows = d.spark.table(table).groupBy(F.col("_batch_id").alias("rows_of")).count()
            counts.append(settle(rows.select(F.lit(batch).alias("load"), F.lit(outcome).alias("outcome"), "*")))
        return reduce(DataFrame.unionByName, counts).withColumnRenamed("count", "row_count")


@query
def column_group_counts(d: DriverTables) -> DataFrame:
    """Rows and exact groups of each column group, and whether the estimate from the sketches
    of all parts lies within 3 % of them."""
    bounds = placement.bucket_bounds(d.sales)

    def dated(df: DataFrame, day: str) -> DataFrame:
        return df.withColumn("date_bucket", date_bucket(day, *map(F.lit, bounds)))

    tables = {
        "fact_sales": dated(d.sales, "sold_date_sk"),
        "fact_returns": dated(d.returns, "returned_date_sk"),
        "dim_date": d.dates,
        "mart_sales_performance": mart_sales_performance(d),
    }
    with own_layers(d.spark) as layers:
        column_groups.refresh(d.spark, layers, tables)
        told = settle(column_groups.estimates(d.spark.table(layers.column_groups)))
    exact = [
        df.groupBy(*group.split()).count().agg(F.count("*").alias("exact_groups")).select(
            F.lit(name).alias("table_name"), F.lit(group).alias("columns"), "exact_groups"
        )
        for name, df in tables.items()
        for group in column_groups.COLUMN_GROUPS[name]
    ]
    near = F.abs(F.col("group_count") - F.col("exact_groups")) <= 0.03 * F.col("exact_groups")
    return told.join(reduce(DataFrame.unionByName, exact), ["table_name", "columns"]).select(
        "table_name", "columns", "row_count", "exact_groups", F.when(near, 1).otherwise(0).alias("within")
    )


@query
def analyzed_columns(d: DriverTables) -> DataFrame:
    """What the catalog holds on analyzed columns of a stored fact and a dimension."""
    wanted = {"fact_sales": "item_sk customer_sk sold_date_sk store_sk", "dim_item": "item_key is_current"}
    with own_layers(d.spark) as layers:
        told = []
        for name, df in {"fact_sales": d.sales, "dim_item": d.items}.items():
            write_full(df, f"{layers.silver}.{name}")
            tuning.analyze(d.spark, f"{layers.silver}.{name}", wanted[name])
            known = column_groups.column_statistics(d.spark, f"{layers.silver}.{name}", wanted[name].split())
            told.append(known.select(F.lit(name).alias("table_name"), "*"))
        return settle(reduce(DataFrame.unionByName, told).drop("distincts"))


@query
def timed_queries(d: DriverTables) -> DataFrame:
    """The timing log of the benchmark queries, two iterations each."""
    plans = {
        "annual_sales_by_channel": lambda: annual_sales_by_channel(d),
        "top_25_customers": lambda: top_25_customers(d),
        "sales_by_category": lambda: sales_by_category(d),
        "daily_sales_one_month": lambda: daily_sales_one_month(d),
        "returns_rate_by_brand": lambda: returns_rate_by_brand(d),
    }
    with own_layers(d.spark) as layers:
        tuning.benchmark(d.spark, plans, layers, "driver", "before", iterations=2)
        log = d.spark.table(layers.perf_log)
        took = F.when(F.col("duration_sec") > 0, 1).otherwise(0).alias("took_time")
        return settle(log.select("query_name", "phase", "iteration", "rows_returned", took))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: plain(function(DriverTables(spark, folder)))

    return {name: bind(function) for name, function in QUERIES.items()}
