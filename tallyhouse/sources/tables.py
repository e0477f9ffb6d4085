"""Stored tables: layer databases, full refresh, append-only logs, publish by rename."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.sources.schemas import DQ_RESULT, LINEAGE, PERF_LOG, RUN_LOG, SCHEMAS

T = TypeVar("T")
STORED = {"compression": "zstd"}  # a third less disk than by default
BEFORE = "version.before"  # table property: the folder that the last switch replaced


@dataclass(frozen=True)
class Layers:
    """The four layer databases, taken as absolute names."""

    bronze: str = "dw_bronze"
    silver: str = "dw_silver"
    gold: str = "dw_gold"
    dq: str = "dw_dq"

    def names(self) -> list[str]:
        return [self.bronze, self.silver, self.gold, self.dq]

    @property
    def run_log(self) -> str:
        return f"{self.dq}.run_log"

    @property
    def dq_result(self) -> str:
        return f"{self.dq}.dq_result"

    @property
    def perf_log(self) -> str:
        return f"{self.dq}.perf_log"

    @property
    def column_groups(self) -> str:
        return f"{self.dq}.column_groups"


def ensure_layout(spark: SparkSession, layers: Layers, location: str | None = None) -> None:
    """Create the databases, raw tables and log tables that do not exist yet.

    ``location`` puts the databases below one folder, else the session's warehouse
    folder holds them.
    """
    for name in layers.names():
        where = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    tables = {layers.run_log: RUN_LOG, layers.dq_result: DQ_RESULT, layers.perf_log: PERF_LOG}
    for table, columns in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")
    lineage = StructType.fromDDL(LINEAGE)
    for name, schema in SCHEMAS.items():
        table = f"{layers.bronze}.{name}"
        if not spark.catalog.tableExists(table):
            whole = StructType([*schema.fields, *lineage.fields])
            create_external(spark, table, whole, new_version(spark, table))


def write_full(
    df: DataFrame, table: str, partition_by: list[str] | None = None, path: str | None = None
) -> None:
    """Full refresh of a table, whose rows are all written before the table changes.

    The new rows go to a folder of their own (``path`` names it); if writing them fails, the
    folder goes and the table still holds its old rows. Then the table is switched over.
    """
    spark = df.sparkSession
    folder = path or new_version(spark, table)
    writer = df.write.options(**STORED)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    try:
        writer.parquet(folder)
    except Exception:
        delete_folder(spark, folder)
        raise
    switch(spark, table, df.schema, folder, partition_by)


def new_version(spark: SparkSession, table: str) -> str:
    """A folder of its own for a version of an external table."""
    database, name = table.split(".")
    return f"{spark.catalog.getDatabase(database).locationUri}/{name}_{uuid.uuid4().hex[:8]}"


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def make_folder(spark: SparkSession, folder: str) -> None:
    files, path = _path(spark, folder)
    files.mkdirs(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    files, path = _path(spark, folder)
    files.delete(path, True)


def create_external(
    spark: SparkSession,
    table: str,
    schema: StructType,
    folder: str,
    partition_by: list[str] | None = None,
    buckets: int = 0,
    keys: list[str] | None = None,
) -> None:
    """A table over files that are there already, partitions and hash buckets included."""
    make_folder(spark, folder)  # an empty part has none yet
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    placed = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    if buckets:
        by = ", ".join(keys)
        placed += f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {table} ({listed}) USING parquet{placed} LOCATION '{folder}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def switch(
    spark: SparkSession,
    table: str,
    schema: StructType,
    folder: str,
    partition_by: list[str] | None = None,
) -> None:
    """Let a table hold the rows of a folder that is written.

    A table over one folder with the same columns changes its location, one catalog entry:
    readers find the old rows or the new ones. The files before stay until the next switch,
    for readers that began with them. Other tables are replaced by name.
    """
    old = location(spark, table)
    listed = [(f.name, f.dataType) for f in schema.fields]
    plain = old and not partition_by and not is_placed(spark, table)
    if plain and [(f.name, f.dataType) for f in spark.table(table).schema.fields] == listed:
        before = properties(spark, table).get(BEFORE)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BEFORE}' = '{old}')")
        spark.catalog.refreshTable(table)
        if before:
            delete_folder(spark, before)
        return
    remove_table(spark, f"{table}__new")
    create_external(spark, f"{table}__new", schema, folder, partition_by)
    remove_table(spark, table)
    spark.sql(f"ALTER TABLE {table}__new RENAME TO {table}")


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in described}


def location(spark: SparkSession, table: str) -> str | None:
    """Where an external table's files lie; None for managed and missing tables."""
    if not spark.catalog.tableExists(table):
        return None
    facts = _facts(spark, table)
    return facts["Location"] if facts.get("Type") == "EXTERNAL" else None


def is_placed(spark: SparkSession, table: str) -> bool:
    """Whether a table has partitions or hash buckets."""
    facts = _facts(spark, table)
    return "# Partition Information" in facts or "Num Buckets" in facts


def remove_table(spark: SparkSession, table: str) -> None:
    """Drop a table and its files, also those of an external one."""
    folder = location(spark, table)
    before = properties(spark, table).get(BEFORE) if folder else None
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for files in filter(None, (folder, before)):
        delete_folder(spark, files)


def write_parts(
    slices: list[DataFrame],
    flag: str,
    parts: dict[str, tuple[bool, list[str]]],
    partition_by: list[str] | None = None,
    buckets: int = 0,
    keys: list[str] | None = None,
) -> dict[str, int]:
    """Write rows once, apart by a boolean column, and give each part to a table.

    ``slices`` are frames of the same columns that together hold the rows. They are written one
    after the other, so that no more than one is on its way between tasks.
    ``parts``: table -> (value of the flag, columns). The tables are external over the
    parts' folders, so rows that feed two tables are derived and written one time. Inside a
    part rows lie by ``partition_by`` and, hashed by ``keys``, in ``buckets``; the files are
    named by bucket, so a part's table has the same buckets. The tables change when all rows
    are written. Returns rows per table, counted on the way.
    """
    spark, schema = slices[0].sparkSession, slices[0].schema
    first = next(iter(parts))
    folder, staged = new_version(spark, first), f"{first}__staged"
    partition_by = partition_by or []
    counts = {
        table: F.count_if(F.col(flag) if value else ~F.col(flag)).alias(table)
        for table, (value, _) in parts.items()
    }
    rows = dict.fromkeys(parts, 0)
    remove_table(spark, staged)  # of a run that was killed
    try:
        for df in slices:
            seen = Observation()
            writer = df.observe(seen, *counts.values()).write.options(**STORED).mode("append")
            writer = writer.partitionBy(flag, *partition_by)
            if buckets:
                writer = writer.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
                writer.option("path", folder).saveAsTable(staged)
            else:
                writer.parquet(folder)
            rows = {table: n + seen.get[table] for table, n in rows.items()}
        spark.sql(f"DROP TABLE IF EXISTS {staged}")  # its files stay
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        delete_folder(spark, folder)
        raise
    for table, (value, columns) in parts.items():
        part = f"{folder}/{flag}={str(value).lower()}"
        hashed = buckets if buckets and set(keys) <= set(columns) else 0
        held = StructType([schema[c] for c in [*columns, *partition_by]])
        remove_table(spark, f"{table}__new")
        create_external(spark, f"{table}__new", held, part, partition_by, hashed, keys)
    for table in parts:
        remove_table(spark, table)
        spark.sql(f"ALTER TABLE {table}__new RENAME TO {table}")
    return rows


def write_counted(df: DataFrame, table: str, **how) -> int:
    """Full refresh that also returns the rows written, counted on the way."""
    seen = Observation()
    write_full(df.observe(seen, F.count(F.lit(1)).alias("rows")), table, **how)
    return seen.get["rows"]


def each(work: Callable[[str], T], names: Iterable[str], at_once: int = 4) -> dict[str, T]:
    """Run jobs for several tables at once, so small tables do not leave a cluster idle."""
    names = list(names)
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(names, pool.map(work, names)))


def append_log(df: DataFrame, table: str) -> None:
    """Append to a log table, columns matched by name; a batch of log rows is one file."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).coalesce(1).write.mode("append").insertInto(table)


def publish(spark: SparkSession, new: str, table: str, keep: str) -> None:
    """Swap ``new`` in for ``table`` by renaming; the old version stays as ``keep``, the one
    kept before goes with its files.

    A partitioned table must be external: a rename does not move the partitions a
    catalog has on record.
    """
    remove_table(spark, keep)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {keep}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
