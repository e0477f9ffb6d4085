"""Lineage columns of raw rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_lineage(df: DataFrame, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Stamp rows just read from files with load time (whole seconds), file and batch.

    The time is given, not taken per task, so all rows of a load carry one value.
    """
    return df.select(
        "*",
        F.lit(ingested_at.replace(microsecond=0)).cast("timestamp").alias("_ingested_at"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
    )
