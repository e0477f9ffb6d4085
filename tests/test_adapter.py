from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans.benchmark_queries import annual_sales_by_channel
from tallyhouse.plans.silver import tagged_returns, tagged_sales
from tallyhouse.session import shared_dir
from tallyhouse.sources.adapter import DriverTables
from tallyhouse.sources.delimited import read_raw
from tallyhouse.sources.schemas import SCHEMAS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def driver(spark):
    return DriverTables(spark, FOLDER)


def same_rows(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty()
    assert right.exceptAll(left).isEmpty()


def test_one_pass_equals_the_union_of_channels(driver):
    raw = driver.raw_tables()
    same_rows(driver.tagged_sales, tagged_sales(raw))
    same_rows(driver.tagged_returns, tagged_returns(raw))


def test_raw_tables_keep_the_contract(driver):
    for name, df in driver.raw_tables().items():
        wanted = SCHEMAS[name].names
        assert [c for c in df.columns if not c.startswith("_")] == wanted


def test_no_row_is_lost(driver):
    for tagged, fact in [
        (driver.tagged_sales, driver.sales),
        (driver.tagged_returns, driver.returns),
    ]:
        assert tagged.count() == fact.count() + tagged.where("_anomaly_reason IS NOT NULL").count()


def test_expected_counts(driver):
    reasons = {
        r._anomaly_reason: r["count"]
        for r in driver.tagged_sales.groupBy("_anomaly_reason").count().collect()
    }
    assert reasons == {
        None: 5887,
        "missing_item_sk": 51,
        "missing_order_id": 21,
        "missing_sold_date": 26,
        "non_positive_quantity": 6,
        "negative_sales_price": 4,
        "negative_net_paid": 5,
    }
    assert driver.returns.count() == 1917


@pytest.mark.parametrize("years", [-2, 10])
def test_the_calendar_follows_the_data(spark, tmp_path, years):
    """No sale is lost in a date join, whenever trade took place."""
    shifted = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"]}
    for table, dates in shifted.items():
        df = spark.read.parquet(f"{FOLDER}/{table}.parquet")
        moved = {c: F.expr(f"{c} + INTERVAL {years} YEARS") for c in dates}
        df.withColumns(moved).write.parquet(f"{tmp_path}/{table}.parquet")
    driver = DriverTables(spark, str(tmp_path))
    yearly = annual_sales_by_channel(driver.sales, driver.dates)
    assert yearly.agg(F.sum("line_count")).first()[0] == driver.sales.count() == 5887


def test_raw_tables_have_the_types_of_the_contract(driver):
    for name, df in driver.raw_tables().items():
        kinds = {f.name: f.dataType for f in SCHEMAS[name].fields}
        assert {f.name: f.dataType for f in df.schema if f.name in kinds} == kinds, name


def test_bill_and_ship_refunded_and_returning_differ(driver):
    sales = driver.raw_sales("web").where("ws_bill_customer_sk IS NOT NULL")
    assert sales.where("ws_bill_customer_sk = ws_ship_customer_sk OR ws_bill_cdemo_sk = ws_ship_cdemo_sk").isEmpty()
    returns = driver.raw_returns("catalog")
    assert returns.where("cr_refunded_customer_sk = cr_returning_customer_sk").isEmpty()


def test_raw_files_leave_nothing_beside_them(spark, tmp_path):
    """The files hold the raw tables, and no lines are settled for them."""
    kept = Path(shared_dir(spark).removeprefix("file:"))
    settled = set(kept.glob("rdd-*"))
    DriverTables(spark, FOLDER).write_raw_files(str(tmp_path))
    assert set(kept.glob("rdd-*")) == settled
    for name, df in DriverTables(spark, FOLDER).raw_tables().items():
        assert list((tmp_path / f"{name}.dat").glob("*.csv.gz")), name
        read = read_raw(spark, f"{tmp_path}/{name}.dat", name).drop("_metadata")
        text = [F.trim(c).alias(c) if k == "string" else F.col(c) for c, k in df.dtypes if not c.startswith("_")]
        same_rows(read, df.select(*text))
