"""Run log as events: a step appends ``started`` and then ``success`` or ``failed``.

Stored files are not updated in place, so a step's state is its latest event. The
step run's own id keeps reruns and killed steps apart.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.schemas import RUN_LOG
from tallyhouse.sources.tables import append_log

APPENDING = threading.Lock()


@dataclass
class Recorded:
    """What a step tells about itself; the last word counts."""

    rows_in: int | None = None
    rows_out: int | None = None
    tool: str | None = None

    def record(self, **facts) -> None:
        for name, value in facts.items():
            setattr(self, name, value)


class RunLog:
    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.table = table

    def _event(self, *values) -> None:
        fields = T.StructType.fromDDL(RUN_LOG).fields
        row = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, fields)]
        with APPENDING:  # appends to one folder share its commit area
            append_log(self.spark.range(1).select(*row), self.table)

    @contextmanager
    def step(self, batch_id: str, layer: str, step: str) -> Iterator[Recorded]:
        """Log a step around the enclosed work; errors are logged and raised again."""
        about = (uuid.uuid4().hex, batch_id, layer, step)
        started, clock = datetime.now(UTC).replace(microsecond=0), time.monotonic()
        done = Recorded()

        def ended() -> tuple:
            seconds = Decimal(str(round(time.monotonic() - clock, 2)))
            return datetime.now(UTC).replace(microsecond=0), seconds, done.tool

        self._event(*about, "started", None, None, started, None, None, None, None)
        try:
            yield done
        except Exception as error:
            self._event(*about, "failed", None, None, started, *ended(), str(error))
            raise
        self._event(*about, "success", done.rows_in, done.rows_out, started, *ended(), None)


def run_log_state(events: DataFrame) -> DataFrame:
    """One row per step run: its latest event, an end event before a start event."""
    state = [c for c in events.columns if c != "step_run"]
    newest = F.struct(
        F.coalesce("ended_at", "started_at").alias("at"),
        (F.col("status") != "started").alias("ended"),
        F.struct(*state).alias("state"),
    )
    return (
        events.groupBy("step_run")
        .agg(F.max(newest).alias("newest"))
        .select("step_run", "newest.state.*")
    )
