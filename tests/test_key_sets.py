import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import key_sets, rollups

EDGES = [
    -(2**63), -(2**63) + 1, -65537, -65536, -32769, -32768, -32767, -1, 0, 1, 32767, 32768, 65535,
    2**31, 2**62, 2**63 - 1,
]
WIDE = [-(10**37), -(2**64) - 1, -(2**64), -1, 0, 1, 2**63, 2**64, 2**64 + 32768, 10**37]


@pytest.mark.parametrize("kind,keys", [("bigint", EDGES), ("decimal(38,0)", WIDE)])
def test_every_key_has_its_own_place(spark, kind, keys):
    rows = [(n % 3, str(key)) for n, key in enumerate(keys * 3)] + [(0, None), (7, None)]
    df = spark.createDataFrame(rows, "g int, k string").select("g", F.col("k").cast(kind).alias("k"))
    cell, place = key_sets.cell_and_place(df, "k")
    assert df.where("k IS NOT NULL").select(cell, place).distinct().count() == len(keys)
    state = key_sets.key_sets(df, ["g"], {"key": "k"})
    exact = {r.g: r.n for r in df.groupBy("g").agg(F.countDistinct("k").alias("n")).collect() if r.n}
    assert {r.g: r.n for r in key_sets.distinct_counts(state, ["g"], {"key": "n"}).collect()} == exact
    assert key_sets.distinct_counts(state, [], {"key": "n"}).first().n == len(keys)


def test_sparse_and_dense_cells_merge(spark, monkeypatch):
    monkeypatch.setattr(key_sets, "SPARSE", 50)
    # Day 0 holds every key, each other day a few of them; day 9 one key a thousand times.
    lines = spark.range(2000).selectExpr("0 AS day", "id AS k")
    lines = lines.union(spark.range(300).selectExpr("CAST(1 + id % 8 AS INT)", "id * 7"))
    lines = lines.union(spark.range(1000).selectExpr("9", "40000L"))
    state = key_sets.key_sets(lines, ["day"], {"key": "k"})
    kinds = {r.day: (r.places is None) for r in state.collect()}
    assert kinds[0] and not kinds[1] and not kinds[9]
    halves = state.withColumn("half", F.col("day") % 2)
    want = lines.withColumn("half", F.col("day") % 2).groupBy("half").agg(F.countDistinct("k").alias("n"))
    got = key_sets.distinct_counts(halves, ["half"], {"key": "n"})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_state_answers_without_the_lines(spark):
    sales = spark.sql(
        "SELECT * FROM VALUES (1, 'store', 10L, 5), (1, 'store', 10L, NULL), (1, 'web', 11L, 5), "
        "(2, 'store', 12L, 6), (32, 'store', 10L, 5), (NULL, 'web', 13L, 9), (33, 'web', NULL, NULL) "
        "AS t(sold_date_sk, channel, sale_order_id, customer_sk)"
    ).selectExpr("*", "1 AS quantity", *[f"1.0 AS {c}" for c in ("ext_sales_price", "net_paid", "net_profit")])
    sales = sales.selectExpr("*", "0.0 AS ext_discount_amt", "0.0 AS ext_tax")
    dates = spark.range(1, 60).selectExpr(
        "CAST(id AS INT) AS date_key", "2001 AS calendar_year", "1 AS quarter_of_year",
        "CAST(1 + id DIV 32 AS INT) AS month_of_year",
    )
    keys = rollups.daily_keys(sales)
    months = rollups.monthly_from_days(rollups.daily_sales(sales), keys, dates)
    plain = rollups.monthly_sales(sales, dates).select(*months.columns)
    assert sorted(map(str, months.collect())) == sorted(map(str, plain.collect()))
    year = rollups.unique_per_year(keys, dates).collect()
    assert [(r.order_count, r.unique_customers) for r in year] == [(3, 2)]
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert rollups.unique_per_year(rollups.daily_keys(sales.limit(0)), dates).count() == 0


def test_other_keys_are_refused(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        key_sets.key_sets(spark.sql("SELECT 'a' AS k"), [], {"key": "k"})
