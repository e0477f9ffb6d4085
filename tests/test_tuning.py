from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import placement, tuning
from tallyhouse.plans.benchmark_queries import daily_sales_of_month
from tallyhouse.sources.adapter import DriverTables
from tallyhouse.sources.tables import append_log, location, publish, write_full

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def fact(spark, layers):
    driver = DriverTables(spark, FOLDER)
    write_full(driver.sales, f"{layers.silver}.fact_sales")
    write_full(driver.dates, f"{layers.silver}.dim_date")
    return driver


def test_date_buckets(spark):
    df = spark.createDataFrame([(1000,), (1364,), (1365,), (999,), (3000,), (None,)], "k int")
    from tallyhouse.functions.expressions import date_bucket

    buckets = [r[0] for r in df.select(date_bucket("k", F.lit(1000), F.lit(2000))).collect()]
    assert buckets == [0, 0, 1, -1, -1, None]


def test_bucketed_fact_is_published_and_pruned(spark, layers, fact):
    name = f"{layers.silver}.fact_sales"
    before = spark.table(name).count()
    tuning.rewrite_by_date_bucket(spark, layers)
    sales, dates = spark.table(name), spark.table(f"{layers.silver}.dim_date")
    assert sales.count() == before == spark.table(f"{name}_unbucketed").count()
    spans = sales.groupBy("date_bucket").agg((F.max("sold_date_sk") - F.min("sold_date_sk")).alias("d"))
    assert max(r.d for r in spans.collect()) < 365
    assert {r.date_bucket for r in spans.collect()} == set(
        r.date_bucket for r in tuning.bucketed_sales(fact.sales).select("date_bucket").distinct().collect()
    )
    pruned = daily_sales_of_month(sales, dates, 2001, 1)
    assert "dynamicpruning" in plan(pruned).lower()
    plain = daily_sales_of_month(fact.sales, fact.dates, 2001, 1)
    assert pruned.exceptAll(plain).isEmpty() and plain.exceptAll(pruned).isEmpty()


def test_statistics_report_per_table(spark, layers, fact):
    outcome = tuning.collect_statistics(spark, layers)
    assert outcome["fact_sales"] == "analyzed"
    assert "TABLE_OR_VIEW_NOT_FOUND" in outcome["mart_customer_360"]


def distinct_counts(spark, table, column):
    facts = spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()
    return {r["info_name"]: r["info_value"] for r in facts}["distinct_count"]


def test_the_rewritten_tables_are_analyzed(spark, layers, fact):
    for _ in range(2):
        tuning.rewrite_by_date_bucket(spark, layers)
        assert distinct_counts(spark, f"{layers.silver}.fact_sales", "item_sk") != "NULL"
        assert distinct_counts(spark, f"{layers.silver}.dim_date", "date_key") != "NULL"


def test_old_versions_leave_no_files(spark, layers, fact):
    for _ in range(3):
        tuning.rewrite_by_date_bucket(spark, layers)
    folder = Path(spark.catalog.getDatabase(layers.silver).locationUri.removeprefix("file:"))
    versions = [p for p in folder.iterdir() if p.name.startswith("fact_sales_bucketed_")]
    assert len(versions) == 2  # the published and the kept one


def test_buckets_grow_with_the_lines():
    counts = [tuning.bucket_count(n) for n in (0, 10**6, 10**8, 10**10, 10**13)]
    assert counts == [4, 4, 64, 8192, 32768]


def test_timings_reach_the_log(spark, layers):
    queries = {"small": lambda: spark.range(5), "none": lambda: spark.range(0)}
    tuning.benchmark(spark, queries, layers, "r1", "before", iterations=2)
    rows = spark.table(layers.perf_log).collect()
    assert sorted((r.query_name, r.iteration, r.rows_returned) for r in rows) == [
        ("none", 1, 0), ("none", 2, 0), ("small", 1, 5), ("small", 2, 5),
    ]
    assert all(r.phase == "before" and r.duration_sec > 0 for r in rows)


def test_hashed_tables_join_without_a_shuffle(spark, layers, conf):
    left, right = f"{layers.silver}.l", f"{layers.silver}.r"
    for table in (left, right):
        tuning.write_hashed(spark.range(100).withColumnRenamed("id", "k"), table, 4, ["k"])
    with conf(spark__sql__autoBroadcastJoinThreshold="-1"):
        joined = spark.table(left).join(spark.table(right), "k")
        assert joined.count() == 100
        assert "Exchange" not in plan(joined)


def test_publish_keeps_the_old_version(spark, layers):
    table = f"{layers.gold}.m"
    write_full(spark.range(1), table)
    write_full(spark.range(2), f"{table}_new")
    publish(spark, f"{table}_new", table, f"{table}_old")
    assert (spark.table(table).count(), spark.table(f"{table}_old").count()) == (2, 1)


def test_log_appends(spark, layers):
    row = spark.sql(
        "SELECT 'b' batch_id, 's' suite, 't' table_name, 'e' expectation, 1Y success, "
        "'' observed_value, TIMESTAMP'2026-01-01' run_at"
    )
    append_log(row, layers.dq_result)
    append_log(row, layers.dq_result)
    assert spark.table(layers.dq_result).count() == 2


def test_facts_are_rewritten_in_slices(spark, layers, fact, monkeypatch):
    monkeypatch.setattr(placement, "BUCKETS_AT_ONCE", 1)
    name = f"{layers.silver}.fact_sales"
    for _ in range(2):
        tuning.rewrite_by_date_bucket(spark, layers)
    for table in (name, f"{name}_unbucketed"):
        stored = spark.table(table).drop("date_bucket")
        assert stored.exceptAll(fact.sales).isEmpty() and fact.sales.exceptAll(stored).isEmpty()
    folder = Path(location(spark, name).removeprefix("file:"))
    cell = F.pmod(F.hash("item_sk", "sale_order_id"), F.lit(4))
    cells = spark.table(name).select("date_bucket", cell).distinct().count()
    found = list(folder.rglob("*.parquet"))
    assert len(found) <= 2 * cells and all(".zstd." in f.name for f in found)
