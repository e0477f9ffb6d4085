"""Where fact rows lie on disk: partitioned by date and hashed by join key, in one table.

A filter on the calendar then reads the date buckets it needs, and a join or grouping by item
and order needs no shuffle, as both facts have the same number of hash buckets. The build
writes facts this way every time, so the layout outlives a refresh.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import date_bucket
from tallyhouse.operators import anomalies
from tallyhouse.sources.tables import Layers, write_parts

BUCKET_DAYS = 365
LINES_PER_BUCKET = 2_000_000
MOST_BUCKETS = 1 << 15
BUCKETS_AT_ONCE = 32  # of a write, so some 64 million lines are between tasks at a time


@dataclass(frozen=True)
class Placement:
    day: str
    keys: tuple[str, ...]


PLACEMENTS = {
    "fact_sales": Placement("sold_date_sk", ("item_sk", "sale_order_id")),
    "fact_returns": Placement("returned_date_sk", ("item_sk", "return_order_id")),
}


def bucket_count(lines: int) -> int:
    """Hash buckets for a fact of that many lines: a power of two, so the counts of a small
    and a grown table divide each other and a join of both still needs no shuffle."""
    return min(1 << max(2, (lines // LINES_PER_BUCKET).bit_length()), MOST_BUCKETS)


def bucket_bounds(sales: DataFrame) -> tuple[int, int] | None:
    """Date key range of the fact, one bucket wider on both sides."""
    low, high = sales.agg(F.min("sold_date_sk"), F.max("sold_date_sk")).first()
    return None if low is None else (low - BUCKET_DAYS, high + BUCKET_DAYS)


def gathered(
    df: DataFrame, placement: Placement, bounds: tuple[int, int], buckets: int, *apart: str
) -> list[DataFrame]:
    """Rows with their ``date_bucket``, those of one date and hash bucket (and equal in
    ``apart``) in one task; adaptive execution merges small cells and splits a large one.

    They come in slices of whole hash buckets, to be written one after the other: a shuffle
    of all rows at once would take more disk than the table.
    """
    low, high = map(F.lit, bounds)
    bucket = date_bucket(placement.day, low, high, BUCKET_DAYS)
    cell = F.pmod(F.hash(*placement.keys), F.lit(buckets))  # as the engine places rows
    celled = df.withColumns({"date_bucket": bucket, "_cell": cell})
    firsts = range(0, buckets, BUCKETS_AT_ONCE)
    slices = [celled.where(F.col("_cell").between(n, n + BUCKETS_AT_ONCE - 1)) for n in firsts]
    return [
        part.hint("rebalance", *apart, "date_bucket", "_cell").drop("_cell")
        for part in (slices if len(slices) > 1 else [celled])
    ]


def store_facts(
    spark: SparkSession,
    layers: Layers,
    tagged: dict[str, DataFrame],
    bounds: tuple[int, int],
    buckets: int,
) -> dict[str, int]:
    """Clean and broken lines of each fact, derived and written once, both placed.

    ``tagged``: ``fact_sales`` and ``fact_returns`` with the reasons of broken lines. Returns
    rows per table.
    """
    rows = {}
    for fact, lines in tagged.items():
        placement = PLACEMENTS[fact]
        clean = getattr(anomalies, fact)(lines).columns
        broken = getattr(anomalies, f"{fact}_anomalies")(lines).columns
        name = f"{layers.silver}.{fact}"
        flagged = lines.select(
            *dict.fromkeys([*clean, *broken]), F.col("_anomaly_reason").isNotNull().alias("broken")
        )
        rows |= write_parts(
            gathered(flagged, placement, bounds, buckets, "broken"),
            "broken",
            {name: (False, clean), f"{name}__anomalies": (True, broken)},
            ["date_bucket"],
            buckets,
            list(placement.keys),
        )
    return rows
