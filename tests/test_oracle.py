"""Registered queries against their SQL. tools/check_oracle.py runs all of them at any scale."""

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from tallyhouse.oracle import oracle_queries
from tallyhouse.registry import registered
from tools.check_oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
# One per operator family; the rest differ from these in the columns they keep.
CHECKED = (
    "bronze_lineage stg_web_returns int_sales_tagged fact_returns anomaly_breakdown dim_customer "
    "dim_date fact_inventory daily_sales monthly_sales item_sales customer_sales rfm_scores "
    "mart_sales_performance mart_channel_comparison mart_product_analytics mart_customer_360 "
    "top_25_customers sales_by_category returns_rate_by_brand fact_sales_bucketed run_log_state "
    "dq_latest perf_compare dq_unique dq_mostly dq_relationships build_tests_silver"
).split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_equal(spark, connection, name):
    assert differences(spark, connection, name, FOLDER) == []


def test_every_query_has_sql():
    assert set(registered()) == set(oracle_queries())
    assert set(registered()) <= set(spark_entry.queries())


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0 and "net_revenue" in df.columns
