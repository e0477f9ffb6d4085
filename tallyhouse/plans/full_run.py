"""The whole run: load, test, silver, test, gold, test, one batch id through all."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators.quality import ChecksFailed, as_dq_result, assert_passed, check_tables
from tallyhouse.operators.dimensions import with_date_bucket
from tallyhouse.operators.staging import CHANNELS, SALE_SOURCES
from tallyhouse.plans import column_groups, marts
from tallyhouse.plans.placement import BUCKET_DAYS, bucket_bounds, bucket_count, store_facts
from tallyhouse.plans.tuning import collect_statistics
from tallyhouse.sources.runlog import RunLog
from tallyhouse.plans.silver import silver_frames, tagged_returns, tagged_sales
from tallyhouse.plans.suites import BUILD_TESTS, EXPECTATIONS, Suite
from tallyhouse.session import keep_compiled, settle, shuffles_dropped
from tallyhouse.sources.delimited import REUSED, load_all
from tallyhouse.sources.seeds import dim_channel
from tallyhouse.sources.tables import (
    Layers,
    append_log,
    each,
    ensure_layout,
    write_counted,
)
from tallyhouse.sources.versions import fingerprint, layer_rows, mark_layer, table_versions


FACTS = ("fact_sales", "fact_returns")  # with their sidecars


class WarehouseRun:
    """One batch over stored layers.

    ``stop_on_failure`` is the gate: the first failing suite ends the run. Without
    it failures are logged and the run goes on. With ``reuse`` the run goes on where another
    ended: loads and builds whose stored tables were made from the same inputs by the same code
    are logged as reused, all others are done again, those that were killed midway included.
    Checks always run.
    """

    def __init__(
        self,
        spark: SparkSession,
        layers: Layers,
        batch_id: str | None = None,
        stop_on_failure: bool = True,
        reuse: bool = False,
    ):
        self.spark = keep_compiled(spark)
        self.layers = layers
        self.batch_id = batch_id or f"run-{uuid.uuid4().hex[:8]}"
        self.stop_on_failure = stop_on_failure
        self.reuse = reuse
        self.log = RunLog(spark, layers.run_log)

    def stored(self, layer: str) -> dict[str, DataFrame]:
        database = getattr(self.layers, layer)
        names = [t.name for t in self.spark.catalog.listTables(database)]
        return {name: self.spark.table(f"{database}.{name}") for name in names}

    def _write(self, layer: str, frames: dict[str, DataFrame], at_once: int = 4) -> int:
        """Store a layer's tables; returns all rows written."""
        database = getattr(self.layers, layer)
        rows = each(lambda name: write_counted(frames[name], f"{database}.{name}"), frames, at_once)
        return sum(rows.values())

    def check(self, layer: str, suite: Suite, step_name: str, label: str) -> None:
        """Run a suite on the stored tables and log one row per check."""
        tables = {**self.stored("silver"), **self.stored(layer)}
        try:
            with self.log.step(self.batch_id, "dq", step_name) as step:
                checked = check_tables(suite, tables)
                now = datetime.now(UTC)
                results = settle(as_dq_result(checked, label, self.batch_id, now))
                append_log(results, self.layers.dq_result)
                step.record(rows_out=results.count(), tool="checks")
                assert_passed(results)
        except ChecksFailed:
            if self.stop_on_failure:
                raise

    def _statistics(self, layer: str) -> None:
        """Of single columns in the catalog, of column groups beside the logs."""
        collect_statistics(self.spark, self.layers, layer)
        stored = {n: df for n, df in self.stored(layer).items() if n in column_groups.COLUMN_GROUPS}
        column_groups.refresh(self.spark, self.layers, stored)

    def _built(self, layer: str, source: str, build: Callable[[], int]) -> None:
        """Log a build of a layer from another one; returns rows and marks the tables it made."""
        database, name = getattr(self.layers, layer), f"build_{layer}"
        with self.log.step(self.batch_id, layer, name) as step:
            inputs = table_versions(self.spark, getattr(self.layers, source))
            made_from = fingerprint(self.spark, name, inputs)
            rows, tool = layer_rows(self.spark, database, made_from) if self.reuse else None, REUSED
            if rows is None:
                rows, tool = build(), "spark"
                self._statistics(layer)
                mark_layer(self.spark, database, made_from, rows)
            step.record(rows_out=rows, tool=tool)

    def build_silver(self) -> None:
        self._built("silver", "bronze", self._silver)

    def build_gold(self) -> None:
        self._built("gold", "silver", self._gold)

    def _silver(self) -> int:
        """Dimensions, and facts placed by date and join key with the calendar to match."""
        bronze = self.stored("bronze")
        frames = {**silver_frames(bronze), "dim_channel": dim_channel(self.spark)}
        sales = frames["fact_sales"]
        frames = {name: df for name, df in frames.items() if not name.startswith(FACTS)}
        tagged = {"fact_sales": tagged_sales(bronze), "fact_returns": tagged_returns(bronze)}
        # Without a dated sale all rows lie outside any bounds.
        bounds = bucket_bounds(sales) or (0, 0)
        lines = sum(bronze[SALE_SOURCES[c][0]].count() for c in CHANNELS)
        frames["dim_date"] = with_date_bucket(frames["dim_date"], *bounds, BUCKET_DAYS)
        rows = self._write("silver", frames)
        placed = store_facts(self.spark, self.layers, tagged, bounds, bucket_count(lines))
        return rows + sum(placed.values())

    def _gold(self) -> int:
        silver = self.stored("silver")
        sales, returns, dates = silver["fact_sales"], silver["fact_returns"], silver["dim_date"]
        frames = {
            "mart_sales_performance": marts.mart_sales_performance(sales, returns, dates),
            "mart_customer_360": marts.mart_customer_360(sales, dates, silver["dim_customer"]),
            "mart_product_analytics": marts.mart_product_analytics(sales, returns, silver["dim_item"]),
            "mart_channel_comparison": marts.mart_channel_comparison(sales, returns, dates),
        }
        # Each shuffles all lines, so one at a time.
        return self._write("gold", frames, at_once=1)

    def run(self, data_dir: str, keep_files: bool = True) -> str:
        """Load the folder's ``<table>.dat`` files, then build and check every layer.

        Without ``keep_files`` a table's files go when it is loaded.
        """
        with shuffles_dropped(self.spark):
            return self._run(data_dir, keep_files)

    def _run(self, data_dir: str, keep_files: bool) -> str:
        load_all(
            self.spark, data_dir, self.batch_id, self.layers, reuse=self.reuse, keep_files=keep_files
        )
        self.check("bronze", BUILD_TESTS["bronze"], "tests_bronze", "bronze_tests")
        self.check("bronze", EXPECTATIONS["bronze"], "dq_bronze", "bronze")
        self.build_silver()
        self.check("silver", BUILD_TESTS["silver"], "tests_silver", "silver_tests")
        self.check("silver", EXPECTATIONS["silver"], "dq_silver", "silver")
        self.build_gold()
        self.check("gold", BUILD_TESTS["gold"], "tests_gold", "gold_tests")
        self.check("gold", EXPECTATIONS["gold"], "dq_gold", "gold")
        return self.batch_id


def run_warehouse(
    spark: SparkSession,
    layers: Layers,
    data_dir: str,
    batch_id: str | None = None,
    stop_on_failure: bool = True,
    location: str | None = None,
    reuse: bool = False,
    keep_files: bool = True,
) -> str:
    ensure_layout(spark, layers, location)
    return WarehouseRun(spark, layers, batch_id, stop_on_failure, reuse).run(data_dir, keep_files)
