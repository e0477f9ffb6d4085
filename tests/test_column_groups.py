import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import column_groups
from tallyhouse.sources.tables import write_full


@pytest.fixture
def fact(spark):
    """60,000 lines of four date buckets, one of them without a date; a third of item 0."""
    return spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 'store', 'web') AS channel",
        "CAST(IF(id % 3 = 0, 0, id % 1000) AS INT) AS item_sk",
        "CAST(IF(id % 4 = 3, NULL, id % 365) AS INT) AS sold_date_sk",
        "CAST(IF(id % 4 = 3, NULL, id % 4) AS INT) AS date_bucket",
    )


def told(state):
    return {r.columns: r for r in column_groups.estimates(state).collect()}


def exact(df, columns):
    counts = df.groupBy(*columns.split()).count()
    return counts.agg(F.count(F.lit(1)), F.max("count")).first()


def test_parts_merge_to_the_whole_table(fact):
    groups = column_groups.COLUMN_GROUPS["fact_sales"]
    state = column_groups.part_sketches(fact, "fact_sales", groups, "date_bucket")
    assert state.count() == 4 * 2
    for columns, row in told(state).items():
        n, largest = exact(fact, columns)
        assert row.row_count == 60_000
        assert abs(row.group_count - n) <= 0.03 * n
        assert abs(row.largest_rows - largest) <= 60_000 / 500
    whole = told(column_groups.part_sketches(fact, "fact_sales", groups))
    assert {c: r.group_count for c, r in told(state).items()} == {c: r.group_count for c, r in whole.items()}
    assert told(state)["item_sk sold_date_sk"].skew > 10


def test_nulls_are_values_of_their_place(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL), (NULL, 1), (1, 1), (NULL, NULL), (1, NULL) AS t(a, b)")
    assert df.select(column_groups.group_key(["a", "b"])).distinct().count() == 4


def test_a_refresh_reads_the_parts_that_changed(spark, layers, fact):
    name = f"{layers.silver}.fact_sales"
    write_full(fact, name, partition_by=["date_bucket"])
    dates = spark.range(365).selectExpr("2001 AS calendar_year", "CAST(id / 31 AS INT) AS month_of_year")
    column_groups.refresh(spark, layers, {"fact_sales": spark.table(name), "dim_date": dates})
    before = told(spark.table(layers.column_groups))
    assert before["calendar_year month_of_year"].group_count == 12
    grown = fact.unionByName(
        spark.range(500).selectExpr(
            "'new' AS channel", "CAST(id + 5000 AS INT) AS item_sk",
            "CAST(NULL AS INT) AS sold_date_sk", "CAST(NULL AS INT) AS date_bucket",
        )
    )
    # Rows of a part that is not named count as read before.
    blind = grown.where("date_bucket IS NULL OR date_bucket = 0")
    column_groups.refresh(spark, layers, {"fact_sales": blind}, {"fact_sales": [None]})
    state = spark.table(layers.column_groups)
    after = told(state)
    assert after["channel sold_date_sk"].row_count == 60_500
    n, _ = exact(grown, "item_sk sold_date_sk")
    assert abs(after["item_sk sold_date_sk"].group_count - n) <= 0.03 * n
    assert after["calendar_year month_of_year"] == before["calendar_year month_of_year"]
    assert state.where("table_name = 'fact_sales'").count() == 8


def test_other_tables_and_empty_ones_have_no_groups(spark, layers, fact):
    column_groups.refresh(spark, layers, {"dim_store": spark.range(3), "fact_sales": fact.limit(0)})
    assert spark.table(layers.column_groups).count() == 0


def test_catalog_values(spark, layers):
    table = f"{layers.gold}.m"
    write_full(spark.sql("SELECT IF(id = 3, NULL, id) AS v, 'x' AS s FROM range(10)"), table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS v, s")
    rows = column_groups.column_statistics(spark, table, ["v", "s"]).collect()
    assert [(r.nulls, r.low, r.high) for r in rows] == [(1, "0", "9"), (0, None, None)]
    assert rows[0].distincts in (8, 9, 10)
