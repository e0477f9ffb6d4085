"""Statistics on groups of columns, from sketches that merge.

The catalog keeps statistics of single columns only. Here each part of a table (a date bucket
of a fact, else the whole table) has two sketches per column group: one that counts distinct
groups (HyperLogLog) and one that holds its most frequent groups. Sketches of parts merge, so
a refresh reads the parts that changed and the estimate for the table comes from the stored
state alone, without its rows. The state is a table beside the logs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.tables import Layers, write_full

# --- fixed values: groups worth statistics, per table -----------------------------------
COLUMN_GROUPS = {
    "fact_sales": ["channel sold_date_sk", "item_sk sold_date_sk"],
    "fact_returns": ["item_sk return_order_id"],
    "dim_date": ["calendar_year month_of_year"],
    "mart_sales_performance": ["calendar_year month_of_year"],
    "mart_channel_comparison": ["calendar_year month_of_year"],
}
# --- end of fixed values ------------------------------------------------------------------

LOG_K = 15  # 32 KB a sketch, a standard error of 0.6 %
TRACKED = 1024  # frequent groups a sketch holds


def group_key(columns: list[str]) -> Column:
    """One number for the values of some columns; NULLs count as values."""
    return F.xxhash64(*[part for c in columns for part in (F.isnull(c), F.col(c))])


def part_sketches(df: DataFrame, table: str, groups: list[str], part: str | None = None) -> DataFrame:
    """One row per part and column group, all from one pass over ``df``."""
    made, rows = [], []
    for i, group in enumerate(groups):
        keyed = f"_k{i}"
        df = df.withColumn(keyed, group_key(group.split()))
        made += [
            F.hll_sketch_agg(keyed, LOG_K).alias(f"g{i}"),
            F.expr(f"approx_top_k_accumulate({keyed}, {TRACKED})").alias(f"c{i}"),
        ]
        rows.append(
            F.struct(F.lit(group).alias("columns"), F.col(f"g{i}").alias("groups"), F.col(f"c{i}").alias("common"))
        )
    parts = df.withColumn("_part", F.col(part) if part else F.lit(0))
    counted = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("row_count"), *made)
    return counted.select(
        F.lit(table).alias("table_name"),
        F.col("_part").alias("part"),
        "row_count",
        F.inline(F.array(*rows)),
    ).select("table_name", "part", "columns", "row_count", "groups", "common")


def estimates(state: DataFrame) -> DataFrame:
    """Per table and column group: rows, estimated groups, rows of the largest group, and its
    skew, how many times the mean group it is; both NULL where groups are so many and so alike
    that none stands out. Sketches of all parts are merged."""
    merged = state.groupBy("table_name", "columns").agg(
        F.sum("row_count").alias("row_count"),
        F.hll_sketch_estimate(F.hll_union_agg("groups")).alias("group_count"),
        F.get(F.expr(f"approx_top_k_estimate(approx_top_k_combine(common, {TRACKED}), 1)"), F.lit(0))[
            "count"
        ].alias("largest_rows"),
    )
    mean = F.col("row_count") / F.nullif(F.col("group_count"), F.lit(0))
    return merged.withColumn("skew", F.round(F.col("largest_rows") / mean, 2))


def refresh(
    spark: SparkSession,
    layers: Layers,
    tables: dict[str, DataFrame],
    changed: dict[str, list[int | None]] | None = None,
) -> None:
    """Sketch the given tables anew and keep the state of all others.

    ``changed`` names the date buckets to read of a table (None: rows without a date); the
    sketches of its other parts stay. A table that lacks a group's columns has no state.
    """
    try:
        state = spark.table(layers.column_groups)
    except AnalysisException:
        state = part_sketches(spark.range(0), "none", ["id"])  # no rows, the state's columns
    fresh, gone = [], F.lit(False)
    for name, df in tables.items():
        part = "date_bucket" if "date_bucket" in df.columns and name.startswith("fact_") else None
        mine = F.col("table_name") == name
        groups = [g for g in COLUMN_GROUPS.get(name, []) if set(g.split()) <= set(df.columns)]
        if part and name in (changed or {}):
            wanted = changed[name]
            df = df.where(_among(part, wanted))
            mine = mine & _among("part", wanted)
        gone = gone | mine
        if groups:
            fresh.append(part_sketches(df, name, groups, part))
    kept = state.where(~gone)
    for sketches in fresh:
        kept = kept.unionByName(sketches)
    write_full(kept.coalesce(1), layers.column_groups)


def _among(column: str, parts: list[int | None]) -> Column:
    known = F.coalesce(F.col(column).isin([p for p in parts if p is not None]), F.lit(False))
    return known | F.isnull(column) if None in parts else known


def column_statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """What the catalog holds on analyzed columns: ``column_name nulls distincts low high``."""
    rows = []
    for column in columns:
        told = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()}
        known = {name: None if value == "NULL" else value for name, value in told.items()}
        counts = [known.get("num_nulls"), known.get("distinct_count")]
        rows.append((column, *[int(c) if c else None for c in counts], known.get("min"), known.get("max")))
    return spark.createDataFrame(
        rows, "column_name string, nulls bigint, distincts bigint, low string, high string"
    )
