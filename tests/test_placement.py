"""Facts placed by date and join key, and tables that keep their rows when a write fails."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import placement, tuning
from tallyhouse.plans.benchmark_queries import daily_sales_of_month, returns_rate_by_brand
from tallyhouse.sources.adapter import DriverTables
from tallyhouse.sources.delimited import load_all
from tallyhouse.sources.tables import location, properties, remove_table, write_full

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def driver(spark):
    return DriverTables(spark, FOLDER)


def build(spark, layers, driver):
    tagged = {"fact_sales": driver.tagged_sales, "fact_returns": driver.tagged_returns}
    bounds = placement.bucket_bounds(driver.sales)
    rows = placement.store_facts(spark, layers, tagged, bounds, 4)
    dates = tuning.with_date_bucket(driver.dates, *bounds, placement.BUCKET_DAYS)
    write_full(dates, f"{layers.silver}.dim_date")
    write_full(driver.items, f"{layers.silver}.dim_item")
    return rows


def test_the_layout_outlives_a_second_build(spark, layers, driver, conf):
    for _ in range(2):
        rows = build(spark, layers, driver)
        assert rows[f"{layers.silver}.fact_sales"] == driver.sales.count()
    sales, returns, dates, items = (
        spark.table(f"{layers.silver}.{t}") for t in ("fact_sales", "fact_returns", "dim_date", "dim_item")
    )
    assert same(sales.drop("date_bucket"), driver.sales)
    assert same(returns.drop("date_bucket"), driver.returns)
    month = daily_sales_of_month(sales, dates, 2001, 1)
    assert "dynamicpruning" in plan(month)
    assert same(month, daily_sales_of_month(driver.sales, driver.dates, 2001, 1))
    for name in ("dim_item", "fact_sales", "fact_returns"):
        spark.sql(f"ANALYZE TABLE {layers.silver}.{name} COMPUTE STATISTICS")
    with conf(spark__sql__autoBroadcastJoinThreshold="40000"):
        rate = returns_rate_by_brand(sales, returns, items, 0)
        told = plan(rate)
        assert told.count("Bucketed: true") == 2 and "SortMergeJoin" in told
        # What is shuffled is summed per item already.
        keys = [line for line in told.splitlines() if "Exchange hashpartitioning" in line]
        assert keys and not any("order_id" in line for line in keys)
        assert same(rate, returns_rate_by_brand(driver.sales, driver.returns, driver.items, 0))


def test_rows_of_one_bucket_lie_in_its_file(spark, layers, driver):
    build(spark, layers, driver)
    sales = spark.table(f"{layers.silver}.fact_sales")
    where = F.regexp_extract(F.input_file_name(), r"_(\d+)\.c\d+", 1).cast("int")
    bucket = F.pmod(F.hash("item_sk", "sale_order_id"), F.lit(4))
    assert sales.where(where != bucket).isEmpty()
    folder = Path(location(spark, f"{layers.silver}.fact_sales").removeprefix("file:"))
    cells = sales.select("date_bucket", bucket.alias("b")).distinct().count()
    assert len(list(folder.rglob("*.parquet"))) <= 2 * cells


def test_broken_lines_are_placed_beside(spark, layers, driver):
    build(spark, layers, driver)
    broken = spark.table(f"{layers.silver}.fact_sales__anomalies")
    assert broken.count() == driver.tagged_sales.where("_anomaly_reason IS NOT NULL").count()
    assert "date_bucket" in broken.columns


def failing(df):
    return df.withColumn("v", F.raise_error(F.lit("broken row")).cast("bigint"))


def test_a_failed_write_keeps_the_old_rows(spark, layers):
    table = f"{layers.gold}.m"
    write_full(spark.range(3).toDF("v"), table)
    folder = Path(location(spark, table).removeprefix("file:")).parent
    before = sorted(folder.iterdir())
    with pytest.raises(Exception, match="broken row"):
        write_full(failing(spark.range(5).toDF("v")), table)
    assert spark.table(table).count() == 3
    assert sorted(folder.iterdir()) == before


def test_a_failed_build_keeps_the_old_facts(spark, layers, driver):
    build(spark, layers, driver)
    broken = driver.tagged_sales.withColumn("quantity", F.raise_error(F.lit("broken row")).cast("int"))
    tagged = {"fact_sales": broken, "fact_returns": driver.tagged_returns}
    with pytest.raises(Exception, match="broken row"):
        placement.store_facts(spark, layers, tagged, (0, 10**7), 4)
    assert spark.table(f"{layers.silver}.fact_sales").count() == driver.sales.count()
    names = {t.name for t in spark.catalog.listTables(layers.silver)}
    assert not any(name.endswith(("__staged", "__new")) for name in names)


def test_a_failed_load_keeps_the_old_rows(spark, layers, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "income_band.dat").write_text("1|0|10000\n2|10001|20000\n")
    load_all(spark, str(folder), "b1", layers, include={"income_band"})
    (folder / "income_band.dat").write_text("1|0|10000\nnot a number|1|2\n")
    with pytest.raises(Exception):
        load_all(spark, str(folder), "b2", layers, include={"income_band"})
    rows = spark.table(f"{layers.bronze}.income_band").collect()
    assert {(r.ib_income_band_sk, r._batch_id) for r in rows} == {(1, "b1"), (2, "b1")}


def test_a_refresh_is_one_change_of_location(spark, layers):
    table = f"{layers.gold}.m"
    write_full(spark.range(1).toDF("v"), table)
    first = location(spark, table)
    reader = spark.table(table)
    reader.count()
    write_full(spark.table(table).union(spark.range(2).toDF("v")), table)  # reads what it replaces
    assert spark.table(table).count() == 3
    assert properties(spark, table)["version.before"] == first
    assert reader.count() in (1, 3)  # the files before are still there
    write_full(spark.range(9).toDF("v"), table)
    assert not Path(first.removeprefix("file:")).exists()
    write_full(spark.range(4).toDF("other"), table)  # other columns
    assert spark.table(table).columns == ["other"] and spark.table(table).count() == 4
    folder = Path(location(spark, table).removeprefix("file:"))
    remove_table(spark, table)
    assert not folder.exists() and not list(folder.parent.glob("m_*"))


def test_no_dated_sales(spark, layers, driver):
    nothing = {
        "fact_sales": driver.tagged_sales.where("false"),
        "fact_returns": driver.tagged_returns.where("false"),
    }
    placement.store_facts(spark, layers, nothing, (0, 0), 4)
    assert spark.table(f"{layers.silver}.fact_sales").count() == 0


def files(spark, table):
    return list(Path(location(spark, table).removeprefix("file:")).rglob("*.parquet"))


def test_facts_written_in_slices_are_whole(spark, layers, driver, monkeypatch):
    monkeypatch.setattr(placement, "BUCKETS_AT_ONCE", 1)
    assert len(placement.gathered(driver.sales, placement.PLACEMENTS["fact_sales"], (0, 10**7), 4)) == 4
    for _ in range(2):
        rows = build(spark, layers, driver)
    for fact, tagged in (("fact_sales", driver.tagged_sales), ("fact_returns", driver.tagged_returns)):
        name = f"{layers.silver}.{fact}"
        clean = tagged.where("_anomaly_reason IS NULL")
        assert same(spark.table(name).drop("date_bucket"), clean.select(spark.table(name).columns[:-1]))
        assert rows[name] == clean.count()
        assert rows[f"{name}__anomalies"] == spark.table(f"{name}__anomalies").count() > 0
        assert rows[name] + rows[f"{name}__anomalies"] == tagged.count()
        # Each cell lies in one slice: no more files than without slices.
        cell = F.pmod(F.hash(*placement.PLACEMENTS[fact].keys), F.lit(4))
        assert len(files(spark, name)) <= 2 * spark.table(name).select("date_bucket", cell).distinct().count()


def test_a_slice_that_fails_keeps_the_old_facts(spark, layers, driver, monkeypatch):
    monkeypatch.setattr(placement, "BUCKETS_AT_ONCE", 1)
    build(spark, layers, driver)
    folder = Path(location(spark, f"{layers.silver}.fact_sales").removeprefix("file:")).parent.parent
    before = sorted(folder.iterdir())
    last = F.pmod(F.hash("item_sk", "sale_order_id"), F.lit(4)) == 3
    broken = F.when(last, F.raise_error(F.lit("broken row")).cast("int")).otherwise(F.col("quantity"))
    tagged = {"fact_sales": driver.tagged_sales.withColumn("quantity", broken)}
    with pytest.raises(Exception, match="broken row"):
        placement.store_facts(spark, layers, tagged, (0, 10**7), 4)
    assert spark.table(f"{layers.silver}.fact_sales").count() == driver.sales.count()
    assert sorted(folder.iterdir()) == before
    names = {t.name for t in spark.catalog.listTables(layers.silver)}
    assert not any(name.endswith(("__staged", "__new")) for name in names)


def test_slices_without_rows(spark, layers, driver, monkeypatch):
    monkeypatch.setattr(placement, "BUCKETS_AT_ONCE", 1)
    test_no_dated_sales(spark, layers, driver)


def test_files_hold_the_columns_of_their_tables(spark, layers, driver):
    build(spark, layers, driver)
    table = spark.table(f"{layers.silver}.fact_sales")
    held = spark.read.parquet(*map(str, files(spark, f"{layers.silver}.fact_sales"))).columns
    assert set(table.columns) - {"date_bucket"} <= set(held) <= {*table.columns, "_anomaly_reason"}
    assert all(".zstd." in f.name for f in files(spark, f"{layers.silver}.fact_sales"))
