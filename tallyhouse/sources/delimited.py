"""Pipe-delimited raw files into bronze tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.runlog import RunLog
from tallyhouse.sources.lineage import with_lineage
from tallyhouse.sources.records import cut_records, goes_over_lines
from tallyhouse.sources.schemas import SCHEMAS
from tallyhouse.sources.tables import Layers, delete_folder, each, write_counted
from tallyhouse.sources.versions import file_versions, fingerprint, made_rows, mark_made

PACKED_ROWS = 1_000_000  # of a compressed file
PACKED = {
    "compression": "gzip",
    "zlib.compress.level": "BEST_SPEED",
    "maxRecordsPerFile": PACKED_ROWS,
}
TOOL = "splits"  # files are read in splits, whatever their size
REUSED = "reused"  # the stored rows are those that the step would make


OPTIONS = {"sep": "|", "mode": "FAILFAST", "nullValue": "", "quote": '"', "escape": '"'}


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Headerless ``|`` file typed by the table's contract.

    Empty fields are NULL, other words stay text. A quoted field may hold separators, doubled
    quotes and line breaks; files are read in splits all the same. A value of the wrong type, a
    row with the wrong number of fields and a quote that does not close fail the load. Text is
    right-trimmed, as fixed-width columns arrive padded.
    """
    schema = SCHEMAS[table]
    if goes_over_lines(spark, path):
        fields = F.from_csv("record", schema.simpleString()[len("struct<") : -1].replace(":", " "), OPTIONS)
        raw = cut_records(spark, path).select(fields.alias("fields"), "_metadata").select("fields.*", "_metadata")
    else:
        raw = spark.read.csv(path, schema=schema, **OPTIONS)
    columns = [
        F.rtrim(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in schema.fields
    ]
    return raw.select(*columns, F.col("_metadata"))


def load_file(spark: SparkSession, path: str, table: str, batch_id: str, layers: Layers) -> int:
    """Replace a bronze table by a file's rows; the rows are counted as they are written."""
    if table not in SCHEMAS:
        raise ValueError(f"unknown table: {table}")
    rows = with_lineage(read_raw(spark, path, table), batch_id, datetime.now(UTC)).drop("_metadata")
    return write_counted(rows, f"{layers.bronze}.{table}")


def write_raw(df: DataFrame, path: str, table: str, packed: bool = False) -> None:
    """Rows as ``|`` text in the table's column order, as ``read_raw`` takes them.

    ``packed`` files are compressed and take a third of the disk; each is read as one split
    then, so none holds more than ``PACKED_ROWS`` rows.
    """
    df.select(*SCHEMAS[table].names).write.options(**(PACKED if packed else {})).csv(
        path, sep="|", quote='"', escape='"', emptyValue="", nullValue="", dateFormat="yyyy-MM-dd"
    )


def load_all(
    spark: SparkSession,
    data_dir: str,
    batch_id: str,
    layers: Layers,
    include: set[str] | None = None,
    exclude: set[str] | None = None,
    reuse: bool = False,
    keep_files: bool = True,
) -> dict[str, int]:
    """Load every ``<table>.dat`` found in ``data_dir``; returns rows per loaded table.

    With ``reuse`` a table that holds these same files stays as it is, its batch id too.
    Without ``keep_files`` a table's files go once all its rows are stored; those of a failed
    load stay.
    """
    log = RunLog(spark, layers.run_log)

    def load(table: str) -> int:
        path, name = f"{data_dir}/{table}.dat", f"{layers.bronze}.{table}"
        with log.step(batch_id, "bronze", f"load_{table}") as step:
            made_from = fingerprint(spark, f"load_{table}", file_versions(spark, path))
            rows, tool = made_rows(spark, name, made_from) if reuse else None, REUSED
            if rows is None:
                rows, tool = load_file(spark, path, table, batch_id, layers), TOOL
                mark_made(spark, name, made_from, rows)
            step.record(rows_in=rows, rows_out=rows, tool=tool)
        if not keep_files:
            delete_folder(spark, path)
        return rows

    wanted = [
        table
        for table in SCHEMAS
        if (not include or table in include)
        and not (exclude and table in exclude)
        and _exists(spark, f"{data_dir}/{table}.dat")
    ]
    return each(load, wanted)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
