"""Command line over stored layers: load, check, run, bench and tune.

    spark-submit --py-files ... tallyhouse/__main__.py run --data-dir /data
    python -m tallyhouse load --data-dir /data --table item

The session, its catalog and its shared folder come from the Spark configuration.
"""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from tallyhouse.operators.quality import ChecksFailed
from tallyhouse.plans import benchmark_queries as queries
from tallyhouse.plans import tuning
from tallyhouse.plans.full_run import WarehouseRun
from tallyhouse.plans.suites import EXPECTATIONS
from tallyhouse.sources.delimited import load_all
from tallyhouse.sources.tables import Layers, ensure_layout


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyhouse")
    for layer in ("bronze", "silver", "gold", "dq"):
        parser.add_argument(f"--{layer}", default=f"dw_{layer}", help=f"{layer} database")
    parser.add_argument("--batch-id", default=None)
    commands = parser.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="replace bronze tables by files")
    load.add_argument("--data-dir", required=True)
    load.add_argument("--table")
    load.add_argument("--include", nargs="*")
    load.add_argument("--exclude", nargs="*", default=[])

    check = commands.add_parser("check", help="run an expectation suite")
    check.add_argument("--suite", choices=list(EXPECTATIONS), default="bronze")

    run = commands.add_parser("run", help="load, build and check all layers")
    run.add_argument("--data-dir", required=True)
    run.add_argument("--reuse", action="store_true", help="go on from what an earlier run stored")

    bench = commands.add_parser("bench", help="time the benchmark queries")
    bench.add_argument("--phase", choices=["before", "after"], required=True)
    bench.add_argument("--iterations", type=int, default=3)
    bench.add_argument("--run-id", default=None)

    tune = commands.add_parser("tune", help="statistics and date buckets")
    tune.add_argument("--only", choices=["stats", "buckets", "both"], default="both")
    return parser.parse_args(arguments)


def new_id(of: str) -> str:
    """An id that sorts by the time it was given."""
    return f"{of}-{datetime.now(UTC):%Y%m%dT%H%M%S%f}"


def benchmark_plans(spark: SparkSession, layers: Layers) -> dict:
    silver = {t.name: f"{layers.silver}.{t.name}" for t in spark.catalog.listTables(layers.silver)}
    table = {name: spark.table(path) for name, path in silver.items()}
    sales, returns = table["fact_sales"], table["fact_returns"]
    items, customers, dates = table["dim_item"], table["dim_customer"], table["dim_date"]
    return {
        "annual_sales_by_channel": lambda: queries.annual_sales_by_channel(sales, dates),
        "top_25_customers": lambda: queries.top_customers(sales, customers),
        "sales_by_category": lambda: queries.sales_by_category(sales, items),
        "daily_sales_one_month": lambda: queries.daily_sales_of_month(sales, dates),
        "returns_rate_by_brand": lambda: queries.returns_rate_by_brand(sales, returns, items),
    }


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse(sys.argv[1:] if arguments is None else arguments)
    spark = spark or SparkSession.builder.appName("tallyhouse").getOrCreate()
    layers = Layers(args.bronze, args.silver, args.gold, args.dq)
    ensure_layout(spark, layers)
    batch = args.batch_id or new_id(args.command)
    try:
        if args.command == "load":
            include = {args.table} if args.table else set(args.include or ()) or None
            counts = load_all(spark, args.data_dir, batch, layers, include, set(args.exclude))
            print("\n".join(f"{table}: {rows} rows" for table, rows in sorted(counts.items())))
        elif args.command == "check":
            suite = EXPECTATIONS[args.suite]
            WarehouseRun(spark, layers, batch).check(
                args.suite, suite, f"dq_{args.suite}", args.suite
            )
        elif args.command == "run":
            WarehouseRun(spark, layers, batch, reuse=args.reuse).run(args.data_dir)
        elif args.command == "bench":
            plans = benchmark_plans(spark, layers)
            run_id = args.run_id or new_id("perf")
            tuning.benchmark(spark, plans, layers, run_id, args.phase, args.iterations)
            print(f"run id {run_id}")
        else:
            if args.only in ("stats", "both"):
                for table, outcome in tuning.collect_statistics(spark, layers).items():
                    print(f"{table}: {outcome}")
            if args.only in ("buckets", "both"):
                print("buckets from %d to %d" % tuning.rewrite_by_date_bucket(spark, layers))
    except ChecksFailed as failed:
        print(failed, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
