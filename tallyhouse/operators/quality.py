"""Data-quality checks counted on whole tables.

All checks of a table share one pass over it. A table with key checks is counted per
(check, key), value checks having one key, so a key with a third of all rows is one row
after the first counting; parents join their own keys there. NULLs are bad for
``not_null`` only; every other check leaves them out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, IntegralType

KEYED = ("unique", "references")


@dataclass(frozen=True)
class Check:
    kind: str  # not_null, unique, in_set, between, references
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    where: str | None = None
    parent: tuple[str, str] | None = None  # (table, key) for references


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", column) for column in columns]


def unique(*columns: str) -> list[Check]:
    return [Check("unique", column) for column in columns]


def in_set(column: str, *values, mostly: float = 1.0) -> list[Check]:
    return [Check("in_set", column, values=values, mostly=mostly)]


def between(
    column: str,
    low: float | None = None,
    high: float | None = None,
    mostly: float = 1.0,
    where: str | None = None,
) -> list[Check]:
    return [Check("between", column, low=low, high=high, mostly=mostly, where=where)]


def references(column: str, table: str, key: str) -> list[Check]:
    return [Check("references", column, parent=(table, key))]


def _unexpected(check: Check) -> Column:
    """True for a bad row; NULL or false otherwise."""
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "in_set":
        return ~column.isin([value for value in check.values if value is not None])
    too_low = F.lit(False) if check.low is None else column < check.low
    too_high = F.lit(False) if check.high is None else column > check.high
    return too_low | too_high


def _flags(check: Check) -> tuple[Column, Column]:
    """Whether a row counts for a check, and whether its value is unexpected."""
    scope = F.expr(check.where) if check.where else F.lit(True)
    seen = scope if check.kind == "not_null" else scope & F.col(check.column).isNotNull()
    bad = F.lit(False) if check.kind in KEYED else scope & _unexpected(check)
    return F.coalesce(seen, F.lit(False)), F.coalesce(bad, F.lit(False))


def _value_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``check_no element_count unexpected_count`` of value checks, from one aggregate."""
    counts, rows = [], []
    for i, check in enumerate(checks):
        seen, bad = _flags(check)
        counts += [F.count_if(seen).alias(f"e{i}"), F.count_if(bad).alias(f"u{i}")]
        rows.append(
            F.struct(
                F.lit(i).alias("check_no"),
                F.col(f"e{i}").alias("element_count"),
                F.col(f"u{i}").alias("unexpected_count"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def _hashed(column: Column, kind: DataType) -> list[Column]:
    """A key as two numbers, both NULL for NULL: whole numbers and dates are kept as they
    are, other values are two hashes of 64 bits, which do not collide in any table."""
    if isinstance(kind, IntegralType):
        pair = column.cast("bigint"), F.lit(0)
    elif isinstance(kind, DateType):
        pair = F.unix_date(column).cast("bigint"), F.lit(0)
    else:
        if isinstance(kind, (FloatType, DoubleType)):
            column = column + F.lit(0.0)  # -0.0 and 0.0 are equal
        pair = F.xxhash64(column), F.xxhash64(F.lit(1), column)
    return [F.when(column.isNotNull(), part.cast("bigint")) for part in pair]


def _keyed_counts(
    df: DataFrame, checks: list[Check], tables: dict[str, DataFrame]
) -> DataFrame:
    """The same with key checks among them: rows are counted per check and key. Keys are
    shuffled as numbers, whatever their type."""
    entries, parents = [], []
    for i, check in enumerate(checks):
        seen, bad = _flags(check)
        kind = df.schema[check.column].dataType
        key = F.col(check.column) if check.kind in KEYED else F.lit(None).cast(kind)
        first, second = _hashed(key, kind)
        entries.append(
            F.struct(
                F.lit(i).alias("check_no"),
                first.alias("first"),
                second.alias("second"),
                seen.alias("seen"),
                bad.alias("bad"),
            )
        )
        if check.kind == "references":
            table, name = check.parent
            first, second = _hashed(F.col(name).cast(kind), kind)
            parents.append(
                tables[table].select(F.lit(i).alias("check_no"), first.alias("first"), second.alias("second"))
            )
    counted = (
        df.select(F.inline(F.array(*entries)))
        .groupBy("check_no", "first", "second")
        .agg(F.count_if("seen").alias("rows"), F.count_if("bad").alias("bad"))
    )
    kinds = F.array(*[F.lit(check.kind) for check in checks])[F.col("check_no")]
    wrong = F.when((kinds == "unique") & (F.col("rows") > 1), F.col("rows"))
    if parents:
        known = reduce(DataFrame.unionByName, parents).where("first IS NOT NULL").distinct()
        counted = counted.join(
            known.withColumn("known", F.lit(True)), ["check_no", "first", "second"], "left"
        )
        wrong = wrong.when((kinds == "references") & F.col("known").isNull(), F.col("rows"))
    return counted.groupBy("check_no").agg(
        F.sum("rows").alias("element_count"),
        F.sum(wrong.otherwise(F.col("bad"))).alias("unexpected_count"),
    )


def check_table(name: str, checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check of table ``name``."""
    df = tables[name]
    if any(check.kind in KEYED for check in checks):
        counted = _keyed_counts(df, checks, tables)
    else:
        counted = _value_counts(df, checks)
    described = [
        F.struct(
            F.lit(i).alias("check_no"),
            F.lit(name).alias("table_name"),
            F.lit(check.column).alias("column_name"),
            F.lit(check.kind).alias("expectation"),
            F.lit(check.mostly).alias("mostly"),
        )
        for i, check in enumerate(checks)
    ]
    # A table without rows has no counts, but each of its checks has a verdict.
    about = df.sparkSession.range(1).select(F.inline(F.array(*described)))
    none = F.lit(0).cast("bigint")
    return about.join(counted, "check_no", "left").select(
        "table_name",
        "column_name",
        "expectation",
        "mostly",
        F.coalesce("element_count", none).alias("element_count"),
        F.coalesce("unexpected_count", none).alias("unexpected_count"),
    )


def sampled_rows(
    df: DataFrame, rows: int, seed: str = "0", by: list[str] | None = None
) -> DataFrame:
    """Exactly ``rows`` rows (all, if there are fewer): those with the smallest MD5 of the seed
    and the columns ``by`` as text, or the whole row as JSON, however the table is partitioned.
    Each task keeps its smallest, so no more than ``rows`` of them leave it. Equal rows have
    equal hashes; any of them do."""
    if by:
        told = F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in by])
    else:
        told = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), told).cast("binary"))).limit(rows)


def check_tables(
    suite: dict[str, list[Check]],
    tables: dict[str, DataFrame],
    fraction: float | None = None,
    seed: int = 0,
    rows: int | None = None,
    sample_by: list[str] | None = None,
) -> DataFrame:
    """One row per check with its counts and verdict.

    A check passes when the good share reaches ``mostly``, or nothing was seen. Whole
    tables are checked; on request a sample instead, against whole parent tables: a random
    ``fraction``, or exactly ``rows`` rows, the same ones every time (see ``sampled_rows``).
    """
    parts = []
    for name, checks in suite.items():
        seen = tables
        if fraction is not None:
            seen = {**tables, name: tables[name].sample(fraction=fraction, seed=seed)}
        elif rows is not None:
            seen = {**tables, name: sampled_rows(tables[name], rows, str(seed), sample_by)}
        parts.append(check_table(name, checks, seen))
    good = F.col("element_count") - F.col("unexpected_count")
    good_share = good / F.nullif(F.col("element_count"), F.lit(0))
    passed = (F.col("unexpected_count") == 0) | (good_share >= F.col("mostly"))
    return reduce(DataFrame.unionByName, parts).withColumn("success", passed.cast("tinyint"))


def as_dq_result(checked: DataFrame, suite: str, batch_id: str, run_at) -> DataFrame:
    """Verdicts as rows of the ``dq_result`` log."""
    observed = F.format_string(
        "%s: %d of %d unexpected", "column_name", "unexpected_count", "element_count"
    )
    return checked.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(suite).alias("suite"),
        "table_name",
        "expectation",
        "success",
        observed.alias("observed_value"),
        F.lit(run_at.replace(microsecond=0)).cast("timestamp").alias("run_at"),
    )


class ChecksFailed(RuntimeError):
    """Raised by the gate when a suite has failing checks."""


def assert_passed(results: DataFrame) -> None:
    """Gate: raise with the failing checks; a suite has one row per check."""
    failed = results.where("success = 0").collect()
    if failed:
        names = [f"{r['table_name']} {r['expectation']} ({r['observed_value']})" for r in failed]
        raise ChecksFailed(f"{len(failed)} failed: " + "; ".join(names))
