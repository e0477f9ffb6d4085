"""Exact distinct counts that roll up: sets of keys in cells, merged without the rows.

A whole-number key is a cell number (its leading bits) and a place in the cell of 2**15. A
state holds, per group and cell, the places that occur: as a bitmap of 4 KB where they are
many, else as an array of short numbers, so a day with few keys stays small. Months, years or
all channels follow from the cells of their days: arrays and bitmaps of one cell are merged
and the bits counted. Rows are split by cell, so a group with a third of all rows is not one
task, and two kinds of keys need no copy of the rows for each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

WIDTH = 1 << 15  # fixed value: the bits of the engine's bitmaps
SPARSE = 2048  # places that take as many bytes as a bitmap


def cell_and_place(df: DataFrame, key: str) -> tuple[Column, Column]:
    """Cell number and place of a key, negative ones included. Keys beyond 64 bits are
    decimals without a fraction; others are no numbers and are refused."""
    kind, column = df.schema[key].dataType, F.col(key)
    if isinstance(kind, IntegralType):
        wide = column.cast("bigint")
        return F.shiftright(wide, 15).cast("decimal(38,0)"), wide.bitwiseAND(WIDTH - 1)
    if isinstance(kind, DecimalType) and kind.scale == 0:
        place = F.pmod(column, F.lit(WIDTH).cast("decimal(38,0)"))
        # The difference is a multiple of the width, so the quotient is whole.
        cell = F.call_function("div", column - place, F.lit(WIDTH).cast("decimal(38,0)"))
        return cell.cast("decimal(38,0)"), place.cast("bigint")
    raise TypeError(f"{key} is {kind.simpleString()}, key sets hold whole numbers")


def key_sets(df: DataFrame, by: list[str], keys: dict[str, str]) -> DataFrame:
    """State of the keys of each group: ``*by kind cell places bits``, one of the last two.

    ``keys``: kind -> column. NULL keys are left out.
    """
    parts = []
    for kind, key in keys.items():
        cell, place = cell_and_place(df, key)
        known = df.where(F.col(key).isNotNull())
        cells = known.groupBy(*by, F.lit(kind).alias("kind"), cell.alias("cell")).agg(
            F.collect_set(place.cast("smallint")).alias("places"),
            F.bitmap_construct_agg(place).alias("bits"),
        )
        few = F.size("places") <= SPARSE
        parts.append(
            cells.withColumns(
                {"places": F.when(few, F.array_sort("places")), "bits": F.when(~few, F.col("bits"))}
            )
        )
    return reduce(DataFrame.unionByName, parts)


def merged(state: DataFrame, by: list[str]) -> DataFrame:
    """One bitmap per group of ``by``, kind and cell."""
    cells = [*by, "kind", "cell"]
    few = state.where("places IS NOT NULL").select(*cells, F.explode("places").alias("place"))
    few = few.groupBy(*cells).agg(F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("bits"))
    many = state.where("bits IS NOT NULL").select(*cells, "bits")
    return few.unionByName(many).groupBy(*cells).agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(state: DataFrame, by: list[str], kinds: dict[str, str]) -> DataFrame:
    """Exact distinct keys per group: ``*by`` and a column for each kind (kind -> name).
    ``by`` may be any columns that the state has or was joined with; none gives one row."""
    counts = [
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits"))), F.lit(0)).alias(name)
        for kind, name in kinds.items()
    ]
    return merged(state, by).groupBy(*by).agg(*counts)
