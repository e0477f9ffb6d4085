from datetime import UTC, datetime

import pytest

from tallyhouse.operators.quality import (
    ChecksFailed,
    as_dq_result,
    assert_passed,
    between,
    check_tables,
    in_set,
    not_null,
    references,
    sampled_rows,
    unique,
)
from tallyhouse.plans.suites import BUILD_TESTS, EXPECTATIONS


def verdicts(spark, checks, values, parent=()):
    tables = {
        "t": spark.createDataFrame([(v,) for v in values], "v int"),
        "p": spark.createDataFrame([(v,) for v in parent], "k int"),
    }
    checked = check_tables({"t": checks}, tables).collect()
    return [(r.expectation, r.element_count, r.unexpected_count, r.success) for r in checked]


def test_not_null(spark):
    assert verdicts(spark, not_null("v"), [1, None, 2]) == [("not_null", 3, 1, 0)]


def test_unique_counts_every_row_of_a_repeated_key(spark):
    assert verdicts(spark, unique("v"), [1, 1, 1, 2, None, None]) == [("unique", 4, 3, 0)]


def test_in_set(spark):
    assert verdicts(spark, in_set("v", 1, 2, None), [1, 2, 3, None]) == [("in_set", 3, 1, 0)]


def test_range(spark):
    checks = between("v", 1, 3) + between("v", 2) + between("v", None, 2) + between("v", 2, where="v > 2")
    assert verdicts(spark, checks, [1, 2, 3, 4, None]) == [
        ("between", 4, 1, 0),
        ("between", 4, 1, 0),
        ("between", 4, 2, 0),
        ("between", 2, 0, 1),
    ]


def test_references_ignore_null_and_repeated_parents(spark):
    result = verdicts(spark, references("v", "p", "k"), [1, 1, 2, 9, 9, None], [1, 1, 2, None])
    assert result == [("references", 5, 2, 0)]


@pytest.mark.parametrize("bad, success", [(1, 1), (2, 0)])
def test_mostly(spark, bad, success):
    values = [0] * bad + [5] * (1000 - bad)
    assert verdicts(spark, between("v", 1, mostly=0.999), values)[0][3] == success


def test_nothing_seen_passes(spark):
    assert [v[3] for v in verdicts(spark, between("v", 1, mostly=0.9) + unique("v"), [None])] == [1, 1]
    assert [v[3] for v in verdicts(spark, not_null("v"), [])] == [1]


def test_gate(spark):
    tables = {"t": spark.createDataFrame([(1,), (None,)], "v int")}
    checked = check_tables({"t": not_null("v") + unique("v")}, tables)
    results = as_dq_result(checked, "s", "b1", datetime(2026, 1, 1, tzinfo=UTC))
    assert results.columns == [
        "batch_id", "suite", "table_name", "expectation", "success", "observed_value", "run_at",
    ]
    with pytest.raises(ChecksFailed, match="1 failed: t not_null .v: 1 of 2 unexpected"):
        assert_passed(results)
    assert_passed(results.where("success = 1"))


def test_suite_sizes():
    def sizes(suites):
        return [sum(len(checks) for checks in suites[s].values()) for s in ("bronze", "silver", "gold")]

    assert sizes(EXPECTATIONS) == [16, 16, 10]
    assert sizes(BUILD_TESTS) == [27, 37, 16]


def test_value_checks_share_one_pass(spark):
    tables = {"t": spark.range(10).toDF("v")}
    checked = check_tables({"t": not_null("v") + between("v", 1) + in_set("v", 1)}, tables)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 10") == 1


def test_key_checks_share_the_pass_with_value_checks(spark):
    tables = {"t": spark.range(10).toDF("v"), "p": spark.range(7, 20).toDF("k")}
    checks = not_null("v") + unique("v") + references("v", "p", "k") + between("v", 1)
    checked = check_tables({"t": checks}, tables)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 10") == 1 and plan.count("Range (7, 20") == 1
    assert [(r.expectation, r.element_count, r.unexpected_count) for r in checked.collect()] == [
        ("not_null", 10, 0), ("unique", 10, 0), ("references", 10, 7), ("between", 10, 1),
    ]


def test_keys_of_other_types_match(spark):
    tables = {"t": spark.sql("SELECT 1 AS v"), "p": spark.sql("SELECT CAST(1.00 AS DECIMAL(9,2)) AS k")}
    assert check_tables({"t": references("v", "p", "k")}, tables).first().unexpected_count == 0


def test_a_sample_is_only_taken_when_asked_for(spark):
    tables = {"t": spark.range(10000).toDF("v")}
    whole = check_tables({"t": not_null("v")}, tables).first()
    part = check_tables({"t": not_null("v")}, tables, fraction=0.1, seed=1).first()
    assert whole.element_count == 10000
    assert 800 < part.element_count < 1200


def test_keys_are_shuffled_as_numbers(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1L, 'a', DATE'2020-01-01', -0.0D, 1.50), (-1L, 'b', NULL, 0.0D, 2.5), "
        "(NULL, NULL, DATE'2020-01-01', NULL, 1.5), (-9223372036854775808L, 'a', NULL, 1D, NULL) "
        "AS t(n, s, d, f, m)"
    )
    parent = spark.sql("SELECT * FROM VALUES ('a', -1), (NULL, NULL), ('', 0) AS t(s, n)")
    checks = unique("n", "s", "d", "f", "m") + references("s", "p", "s") + references("n", "p", "n")
    checked = check_tables({"t": checks}, {"t": rows, "p": parent})
    plan = checked._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning(check_no" in line]
    assert shuffled and not any("key" in line for line in shuffled)
    fields = [f.dataType.simpleString() for f in checked.schema.fields[:3]]
    assert fields == ["string"] * 3  # names only
    assert [(r.element_count, r.unexpected_count) for r in checked.collect()] == [
        (3, 0), (3, 2), (2, 2), (3, 2), (3, 2), (3, 1), (3, 2),
    ]


def test_a_sample_of_exactly_n_rows(spark):
    df = spark.range(5000).selectExpr("id AS v", "IF(id % 3 = 0, NULL, id % 7) AS w")
    drawn = {r.v for r in sampled_rows(df, 1000).collect()}
    assert len(drawn) == 1000
    assert drawn == {r.v for r in sampled_rows(df.repartition(7), 1000).collect()}
    assert drawn != {r.v for r in sampled_rows(df, 1000, "other").collect()}
    assert sampled_rows(df, 10_000).count() == 5000
    plan = sampled_rows(df, 1000)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    checked = check_tables({"t": not_null("w") + unique("v")}, {"t": df}, rows=1000).collect()
    assert [r.element_count for r in checked] == [1000, 1000]
    bad = sum(v % 3 == 0 for v in drawn)
    assert [r.unexpected_count for r in checked] == [bad, 0]
