from datetime import datetime
from decimal import Decimal

import pytest

from tallyhouse.plans import reports
from tallyhouse.sources.schemas import DQ_RESULT, PERF_LOG

T0 = datetime(2026, 1, 1, 3, 0, 0)


def perf(spark, *rows):
    full = [(run, phase, q, i, Decimal(str(s)), 1, T0.replace(hour=i), None) for run, phase, q, i, s in rows]
    return spark.createDataFrame(full, PERF_LOG)


def test_compare_medians(spark, many_slices):
    log = perf(
        spark,
        *[("r1", "before", "q1", i, s) for i, s in enumerate([3, 1, 2])],
        *[("r1", "after", "q1", i, s) for i, s in enumerate([1, 4, 2, 1])],
        ("r1", "before", "q2", 1, 1),
        ("r1", "after", "q2", 1, 2),
        ("r2", "before", "q3", 1, 1),
    )
    rows = {r.query_name: r for r in reports.perf_compare(log).collect()}
    q1 = rows["q1"]
    assert (q1.before_sec, q1.after_sec, q1.delta_sec) == (Decimal("2.000"), Decimal("1.500"), Decimal("0.500"))
    assert (q1.speedup_x, q1.verdict) == (Decimal("1.33"), "ok")
    assert (rows["q2"].speedup_x, rows["q2"].verdict) == (Decimal("0.50"), "bad")
    assert (rows["q3"].after_sec, rows["q3"].speedup_x, rows["q3"].verdict) == (None, None, "")
    assert {r.query_name for r in reports.perf_compare(log, "r1").collect()} == {"q1", "q2"}


def test_runs_and_raw(spark):
    log = perf(spark, ("r1", "before", "q", 1, 1), ("r1", "after", "q", 2, 1), ("r2", "before", "q", 3, 1))
    rows = reports.perf_runs(log).collect()
    assert [(r.run_id, r.has_before, r.has_after, r.row_count) for r in rows] == [("r2", 1, 0, 1), ("r1", 1, 1, 2)]
    assert rows[1].first_at == "2026-01-01 01:00:00"
    assert [r.iteration for r in reports.perf_raw(log, "r1").collect()] == [2, 1]


def test_latest_dq_batch_is_the_last_run(spark):
    rows = [
        ("zzz", "silver", "t", "unique", 1, "", T0),
        ("aaa", "gold", "t", "unique", 1, "", T0.replace(hour=5)),
        ("aaa", "silver", "t", "not_null", 0, "", T0.replace(hour=4)),
    ]
    log = spark.createDataFrame(rows, DQ_RESULT)
    assert [(r.suite, r.success) for r in reports.dq_latest(log).collect()] == [("silver", 0), ("gold", 1)]
    assert [r.suite for r in reports.dq_latest(log, "gold").collect()] == ["gold"]


def test_counts_go_on_after_a_failing_table(spark):
    tables = {"a": lambda: spark.range(3), "b": lambda: spark.table("no_such_table"), "c": lambda: spark.range(2)}
    rows = {r.table_name: r for r in reports.layer_counts(spark, tables).collect()}
    assert (rows["a"].row_count, rows["b"].row_count, rows["c"].row_count) == (3, None, 2)
    assert "no_such_table" in rows["b"].error and rows["a"].error is None


def test_segments(spark):
    rows = [("Lost", Decimal("1.00"), 1, 10), ("Lost", Decimal("2.01"), 2, 15), ("Inactive", None, None, None)]
    df = spark.createDataFrame(
        rows, "segment string, lifetime_value decimal(17,2), frequency bigint, recency_days int"
    )
    out = {r.segment: r for r in reports.segment_summary(df).collect()}
    lost = out["Lost"]
    assert (lost.customers, lost.avg_frequency, lost.avg_recency_days) == (2, Decimal("1.50"), 12)
    assert out["Inactive"].avg_ltv is None


@pytest.mark.parametrize("limit", [1, 2])
def test_limits(spark, limit):
    log = spark.createDataFrame(
        [("b", "silver", s, "success", 1, 1, T0.replace(minute=m), None, None) for m, s in enumerate("xyz")],
        "batch_id string, layer string, step string, status string, rows_in long, rows_out long, "
        "started_at timestamp, duration_sec decimal(10,2), tool string",
    )
    assert [r.step for r in reports.recent_runs(log, limit).collect()] == ["z", "y"][:limit]


def test_a_table_that_cannot_be_counted_fails_alone(spark, tmp_path):
    """A file that is lost after planning, a missing table and a count that takes too long."""
    for name in ("lost", "good"):
        spark.range(7).repartition(1).write.parquet(str(tmp_path / name))
    lost = spark.read.parquet(str(tmp_path / "lost"))
    for file in (tmp_path / "lost").glob("*.parquet"):
        file.unlink()
    slow = spark.range(2).repartition(1).selectExpr("id", "java_method('java.lang.Thread', 'sleep', 60000L) AS z")
    tables = {
        "lost": lambda: lost.where("id > 3"),
        "good": lambda: spark.read.parquet(str(tmp_path / "good")),
        "missing": lambda: spark.table("no_such_table"),
        "slow": lambda: slow.where("z IS NULL"),
        "empty": lambda: spark.range(0),
    }
    rows = {r.table_name: r for r in reports.layer_counts(spark, tables, seconds=5).collect()}
    assert {name: r.row_count for name, r in rows.items()} == {
        "lost": None, "good": 7, "missing": None, "slow": None, "empty": 0,
    }
    assert "FILE" in rows["lost"].error and "no_such_table" in rows["missing"].error
    assert "cancelled" in rows["slow"].error
    assert rows["good"].error is None and spark.range(3).count() == 3
