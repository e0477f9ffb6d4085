import random
from datetime import date

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.operators.ranking import (
    top1_per_group,
    with_position,
    with_quintiles,
    with_rank,
    with_ranks,
)

pytestmark = pytest.mark.usefixtures("many_slices")


def frame(spark, seed, n, groups=3, hot=0.4):
    """Keys with values of which one holds ``hot`` of all rows, and NULL groups."""
    pick = random.Random(seed)
    rows = [
        (
            key,
            5 if pick.random() < hot else pick.randrange(n),
            pick.choice([None, *range(groups)]),
        )
        for key in range(n)
    ]
    return spark.createDataFrame(rows, "k long, v long, g int")


def quintiles(spark, values, direction=1):
    df = spark.createDataFrame(list(enumerate(values)), "k long, v long")
    scored = with_quintiles(df, "k", {"q": F.col("v") * direction})
    return [r.q for r in scored.orderBy("k").collect()]


def test_quintile_of_seven(spark):
    assert quintiles(spark, [10, 20, 30, 40, 50, 60, 70]) == [1, 2, 3, 3, 4, 5, 5]


def test_quintile_descending(spark):
    assert quintiles(spark, [0, 10, 20, 30, 40], -1) == [5, 4, 3, 2, 1]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6])
def test_quintile_of_few(spark, n):
    assert quintiles(spark, list(range(n))) == [-(-5 * (i + 1) // n) for i in range(n)]


@pytest.mark.parametrize("seed, n", [(1, 500), (2, 503), (3, 37)])
def test_quintiles_equal_plain_window(spark, seed, n):
    df = frame(spark, seed, n)
    scored = with_quintiles(df, "k", {"up": F.col("v"), "down": F.negate("v")})

    def plain(order):
        place = F.row_number().over(W.orderBy(*order)) * 5.0 / F.count("*").over(W.partitionBy())
        return F.ceil(place).cast("int")

    wanted = df.select("k", plain([F.asc("v"), "k"]).alias("up"), plain([F.desc("v"), "k"]).alias("down"))
    assert scored.select("k", "up", "down").exceptAll(wanted).isEmpty()
    assert scored.count() == n


@pytest.mark.parametrize("share", [0.0, 0.3, 0.6, 1.0])
@pytest.mark.parametrize("n", [10, 333])
def test_quintiles_of_nulls_and_fine_values(spark, share, n):
    pick = random.Random(n)
    rows = [
        (
            k,
            None if pick.random() < share else pick.choice([1e-8, 2e-8, float("nan"), pick.random() * 1e-7]),
            None if pick.random() < share else pick.randrange(5),
            None if pick.random() < share else date(2000, 1, 1 + pick.randrange(28)),
        )
        for k in range(n)
    ]
    df = spark.createDataFrame(rows, "k long, fine double, v int, d date")
    measures = {"a": F.col("fine"), "b": F.col("v"), "c": F.col("d"), "e": F.negate("fine")}
    scored = with_quintiles(df, "k", measures).select("k", *measures)
    count = F.count("*").over(W.partitionBy())

    def plain(column):
        # Spark's ascending order has NULLs first.
        place = F.row_number().over(W.orderBy(column.asc(), "k"))
        return F.ceil(place * 5.0 / count).cast("int")

    wanted = df.select("k", *[plain(column).alias(name) for name, column in measures.items()])
    assert scored.exceptAll(wanted).isEmpty() and scored.count() == n


@pytest.mark.parametrize("group", [[], ["g"]])
@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_rank_equals_plain_window(spark, group, hot):
    df = frame(spark, 4, 400, hot=hot)
    ranked = with_rank(df, "r", "v", "k", group)
    wanted = df.withColumn("r", F.rank().over(W.partitionBy(*group).orderBy(F.desc("v"))))
    assert ranked.select("k", "v", "g", "r").exceptAll(wanted).isEmpty()
    assert ranked.count() == 400


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_ranks_of_several_scopes(spark, hot):
    df = frame(spark, 8, 300, hot=hot)
    ranked = with_ranks(df, "v", "k", {"overall": None, "inside": "g"})
    wanted = df.withColumn("overall", F.rank().over(W.orderBy(F.desc("v")))).withColumn(
        "inside", F.rank().over(W.partitionBy("g").orderBy(F.desc("v")))
    )
    assert ranked.select("k", "v", "g", "overall", "inside").exceptAll(wanted).isEmpty()
    assert ranked.count() == 300


def test_rank_shares_ties(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 5)], "k long, v long")
    assert sorted((r.k, r.r) for r in with_rank(df, "r", "v", "k").collect()) == [(1, 1), (2, 1), (3, 3)]


@pytest.mark.parametrize("group", [[], ["g"]])
def test_position_equals_plain_window(spark, group):
    df = frame(spark, 5, 300)
    placed = with_position(df, "p", [F.asc("v"), F.asc("k")], group, total="n")
    window = W.partitionBy(*group)
    wanted = df.withColumn("p", F.row_number().over(window.orderBy("v", "k"))).withColumn(
        "n", F.count("*").over(window)
    )
    assert placed.select("k", "v", "g", "p", "n").exceptAll(wanted).isEmpty()
    assert placed.count() == 300


def test_a_hot_value_is_spread_over_slices(spark):
    """A third of equal values must not meet in one task."""
    df = frame(spark, 6, 20000, hot=1.0)
    from tallyhouse.operators import ranking

    sizes = ranking._sliced(df, [F.desc("v"), F.asc("k")]).groupBy("_slice").count().collect()
    assert len(sizes) == 7
    assert max(r["count"] for r in sizes) < 20000 / 3


def test_top1(spark):
    df = spark.createDataFrame([(1, "web", 5), (1, "store", 5), (2, "web", 1)], "g int, c string, v int")
    top = top1_per_group(df, ["g"], [F.desc("v"), F.asc("c")])
    assert sorted((r.g, r.c) for r in top.collect()) == [(1, "store"), (2, "web")]


def test_only_slice_tables_meet_in_one_partition(spark):
    df = frame(spark, 7, 200)
    plans = [
        with_rank(df, "r", "v", "k"),
        with_position(df, "p", [F.asc("v"), F.asc("k")]),
        with_quintiles(df, "k", {"q": F.col("v")}),
    ]
    for planned in plans:
        lines = planned._jdf.queryExecution().executedPlan().toString().splitlines()
        for number, line in enumerate(lines):
            if "SinglePartition" in line:
                source = next(x for x in lines[number:] if "Aggregate(" in x or "Scan" in x)
                assert "HashAggregate(keys=[_cell" in source, source
