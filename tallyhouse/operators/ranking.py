"""Exact row positions, ranks and quintiles without a single-task sort.

A window without PARTITION BY, or one whose group holds a third of all rows,
sorts everything in one task. Here the rows are cut into ordered slices by a
range shuffle that includes a unique key, so equal values may span slices, and
each row's place is its place inside the slice plus the rows before the slice.
What is joined back has one row per slice and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.session import settle

_SLICE = "_slice"
# Group and slice of a row as one struct: equal NULL groups match in a plain join,
# and the window before the join already has the rows where the join needs them.
_CELL = "_cell"


def top1_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each group; for inputs already aggregated to a few rows per group."""
    first = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def _sliced(df: DataFrame, order: list[Column]) -> DataFrame:
    """Cut ``df`` into ordered slices and fix each row's slice number."""
    ranged = df.repartitionByRange(*order)
    return settle(ranged.withColumn(_SLICE, F.spark_partition_id()))


def _celled(sliced: DataFrame, group: list[str]) -> DataFrame:
    return sliced.withColumn(_CELL, F.struct(*group, _SLICE))


def _with_cell_facts(df: DataFrame, facts: DataFrame, group: list[str]) -> DataFrame:
    """Join facts about the cells back to the rows.

    Without groups there is one cell per slice, so broadcasting them is bounded; with
    groups their size decides.
    """
    return df.join(facts if group else F.broadcast(facts), _CELL)


def _parts(group: list[str]) -> list[Column]:
    return [F.col(_CELL)[g] for g in group]


def with_position(
    df: DataFrame,
    name: str,
    order: list[Column],
    group: list[str] | None = None,
    total: str = "_total",
) -> DataFrame:
    """ROW_NUMBER of each row in its group, and the group's row count as ``total``.

    ``order`` must end in a unique key, or equal rows take any order among them.
    """
    group = group or []
    celled = _celled(_sliced(df, [*[F.asc(g) for g in group], *order]), group).drop(_SLICE)
    whole = W.partitionBy(*_parts(group))
    earlier = whole.orderBy(F.col(_CELL)[_SLICE]).rowsBetween(W.unboundedPreceding, -1)
    sizes = celled.groupBy(_CELL).agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.select(
        _CELL,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias(total),
    )
    local = F.row_number().over(W.partitionBy(_CELL).orderBy(*order))
    placed = _with_cell_facts(celled.withColumn("_local", local), before, group)
    return placed.withColumn(name, F.col("_local") + F.col("_before")).drop(
        "_local", "_before", _CELL
    )


def with_rank(
    df: DataFrame, name: str, value: str, key: str, group: list[str] | None = None
) -> DataFrame:
    """RANK by ``value`` descending in each group; ``value`` not NULL, ``key`` unique in it."""
    order = [*[F.asc(g) for g in group or []], F.desc(value), F.asc(key)]
    sliced = _sliced(df, order)
    return _ranked(sliced, sliced, name, value, group or []).drop(_SLICE)


def _ranked(
    rows: DataFrame, sliced: DataFrame, name: str, value: str, group: list[str]
) -> DataFrame:
    """Ranks of ``rows`` from ordered slices: a row's rank is its rank in its cell (slice and
    group) after the rows of the group's earlier cells, ties across cells put right.

    ``sliced`` has the same rows as settled; the facts about cells come from there.
    """
    inside = W.partitionBy(_CELL).orderBy(F.desc(value))
    local = F.rank().over(inside)
    ranked = _celled(rows, group).withColumn("_local", local)

    edges = _celled(sliced, group).withColumn("_local", local).groupBy(_CELL).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max(value).alias("_top"),
        F.min(value).alias("_low"),
        F.max("_local").alias("_low_rank"),
    )
    in_order = W.partitionBy(*_parts(group)).orderBy(F.col(_CELL)[_SLICE])
    same_low = W.partitionBy(*_parts(group), "_low").orderBy(F.col(_CELL)[_SLICE])
    # Rows equal to a cell's lowest value, in it and in the cells before it.
    edges = edges.withColumn(
        "_ties", F.sum(F.col("_rows") - F.col("_low_rank") + 1).over(same_low)
    )
    # When the previous cell ends in this cell's top value, its ties rank equal.
    carried = F.lag("_low").over(in_order) == F.col("_top")
    facts = edges.select(
        _CELL,
        "_top",
        (F.sum("_rows").over(in_order) - F.col("_rows")).alias("_before"),
        F.when(carried, F.lag("_ties").over(in_order)).otherwise(0).alias("_carry"),
    )
    placed = _with_cell_facts(ranked, facts, group)
    ties = F.when(F.col(value) == F.col("_top"), F.col("_carry")).otherwise(0)
    rank = F.col("_local") + F.col("_before") - ties
    return placed.withColumn(name, rank).drop("_local", "_before", "_carry", "_top", _CELL)


def with_ranks(df: DataFrame, value: str, key: str, scopes: dict[str, str | None]) -> DataFrame:
    """Several ranks by ``value``: one per name, over all rows or within a column's groups.

    Slices in the order of ``value`` are ordered for every group too, so one range shuffle
    of whole rows, settled once, serves all scopes and ``df`` is computed once.
    """
    sliced = rows = _sliced(df, [F.desc(value), F.asc(key)])
    for name, column in scopes.items():
        rows = _ranked(rows, sliced, name, value, [column] if column else [])
    return rows.drop(_SLICE)


def quintile_cuts(
    df: DataFrame, key: str, measures: dict[str, Column], bins: int = 5
) -> dict[str, list[tuple[int, object, int]]]:
    """For each measure the last (value, key) of bins 1 to 4, by exact position, NULLs first.

    All measures are cut in one range shuffle of narrow rows: a row's value is a struct
    with a field per measure, so each keeps its own type and order. What reaches the
    driver is one size per slice and measure, then at most four rows per measure.
    """
    types = dict(df.select(*[c.alias(name) for name, c in measures.items()]).dtypes)
    entries = [
        F.struct(
            F.lit(name).alias("measure"),
            F.struct(
                *[
                    (column if name == other else F.lit(None)).cast(types[other]).alias(other)
                    for other, column in measures.items()
                ]
            ).alias("value"),
        )
        for name in measures
    ]
    long = df.select(key, F.inline(F.array(*entries)))
    order = [F.asc("value"), F.asc(key)]
    sliced = _sliced(long, [F.asc("measure"), *order])
    sizes: dict[str, list[tuple[int, int]]] = {name: [] for name in measures}
    counted = sliced.groupBy("measure", _SLICE).count().collect()
    for row in sorted(counted, key=lambda row: row[_SLICE]):
        sizes[row["measure"]].append((row[_SLICE], row["count"]))

    wanted: dict[tuple[str, int, int], list[int]] = {}
    for name, slices in sizes.items():
        total = sum(count for _, count in slices)
        for cut in range(1, bins):
            place = cut * total // bins
            for number, count in slices:
                if 0 < place <= count:
                    wanted.setdefault((name, number, place), []).append(cut)
                    break
                place -= count
    cuts: dict[str, list[tuple[int, object, int]]] = {name: [] for name in measures}
    if wanted:
        spots = {(name, number) for name, number, _ in wanted}
        in_spots = F.struct("measure", _SLICE).isin([F.struct(*map(F.lit, s)) for s in spots])
        inside = W.partitionBy("measure", _SLICE).orderBy(*order)
        at_spots = F.struct("measure", _SLICE, "_rn").isin(
            [F.struct(*map(F.lit, s)) for s in wanted]
        )
        found = sliced.where(in_spots).withColumn("_rn", F.row_number().over(inside))
        for row in found.where(at_spots).collect():
            for cut in wanted[row["measure"], row[_SLICE], row["_rn"]]:
                cuts[row["measure"]].append((cut, row["value"][row["measure"]], row[key]))
    return cuts


def _behind(value: Column, kind: str, key: str, cut_value, cut_key) -> Column:
    """Whether a row comes after the cut row, NULLs before all values."""
    later = F.col(key) > F.lit(cut_key)
    if cut_value is None:
        return value.isNotNull() | later
    cut = F.lit(cut_value).cast(kind)
    return F.coalesce((value > cut) | ((value == cut) & later), F.lit(False))


def with_quintiles(
    df: DataFrame, key: str, measures: dict[str, Column], bins: int = 5
) -> DataFrame:
    """Add ceil(bins * row_number / count) per measure, ascending, NULLs first, ties by ``key``.

    A row's bin is one more than the number of cuts it lies behind for the bins
    that are not empty, so scoring is a projection: no shuffle, no join back. Measures
    keep their types. ``df`` is read twice and should be settled; ``key`` is not NULL.
    """
    cuts = quintile_cuts(df, key, measures, bins)
    kinds = dict(df.select(*[c.alias(name) for name, c in measures.items()]).dtypes)
    scores = {}
    for name, column in measures.items():
        # With fewer rows than bins the first bins are empty: no row lies before their cut.
        score = F.lit(bins - len(cuts[name]))
        for _, cut_value, cut_key in cuts[name]:
            behind = _behind(column, kinds[name], key, cut_value, cut_key)
            score = score + F.when(behind, 1).otherwise(0)
        scores[name] = score.cast("int")
    return df.withColumns(scores)
