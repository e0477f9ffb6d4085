"""Mixing sources to target weights by systematic sampling.

Sources in code point order, null last, take the weights in turn and share the words of
all documents by them. A source's target stops at ``most`` times its words; what is over
is shared again by weight until no target is above its stop. Within a source every
document is expected ``target / words`` times: these expectations are summed in a fixed
order, one random offset is added, and a document leaves once for each whole number that
its interval crosses. So it leaves the expected number of times rounded down or up, and a
source's count is within one of its sum.

The order goes by size class first (four classes to each doubling), so a source's words
follow its target as closely as its count does. Summing needs no ordered pass over a
source: rows are counted per cell (source, size class and a hash of the id), cells are
summed within their source, and a row's place is its cell's start plus its place in the
cell. A source with a third of all rows is cut into many cells.

Defined cases: a text that is null or has no word has size 0 and is taken as often as its
source's other documents; a null source is a source of its own; null and repeated ids are
rows of their own (equal rows take the places next to each other); a source without any
word has target 0 and is not taken; no documents give no rows. Columns of the input are
kept, the added ones get a tail if the input has their name.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.common import WORD, column, fresh

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20
HASHED = 64  # cells per source and size class


def offset(seed: int = SEED) -> float:
    """The random offset; one for all sources."""
    return random.Random(seed).random()


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source (``src``, ``source_size``) with its ``target``.

    Sources over their stop come first when ordered by stop per weight: a source is over if
    its stop is below its share of what the sources before it left. One row per source is
    sorted in one task; a mixture names its sources, so they are few.
    """
    turn = F.row_number().over(W.orderBy(F.col("src.source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    order = [
        (F.lit(float(most)) * F.col("source_size") / F.col("weight")),
        F.col("src.source").asc_nulls_last(),
    ]
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    zero = F.lit(0).cast("long")
    left = (
        sizes.withColumn("weight", weight)
        .withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_weights", F.sum("weight").over(everything))
        .withColumn(
            "_left", F.col("_all") - most * F.coalesce(F.sum("source_size").over(before), zero)
        )
        .withColumn("_open", F.col("_weights") - F.coalesce(F.sum("weight").over(before), zero))
    )
    stop = F.lit(float(most)) * F.col("source_size")
    over = stop * F.col("_open") < F.col("weight") * F.col("_left").cast("double")
    level = F.when(~F.col("_over"), F.col("_left").cast("double") / F.col("_open"))
    # The first source that is not over sees what all stopped ones left: the common level.
    first = F.first(level, ignorenulls=True).over(
        W.orderBy(*order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    return (
        left.withColumn("_over", over)
        .withColumn("_level", first)
        .withColumn(
            "target", F.when(F.col("_over"), stop).otherwise(F.col("weight") * F.col("_level"))
        )
        .select("src", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """Each row (columns ``keep``, all by default) with ``size``, ``source_size``, ``target``,
    ``copies`` (how often the mix takes it) and ``taken`` (words taken)."""
    keep = docs.columns if keep is None else keep
    added = ["size", "source_size", "target", "copies", "taken"]
    kept = [column(docs, name).alias(f"_in_{i}") for i, name in enumerate(keep)]
    rows = docs.select(
        *kept,
        F.struct(column(docs, source_col).alias("source")).alias("src"),
        column(docs, id_col).alias("_id"),
        F.coalesce(F.regexp_count(column(docs, text_col), F.lit(WORD)), F.lit(0))
        .cast("long")
        .alias("size"),
    )
    bits = F.length(F.bin("size"))
    rows = rows.withColumn(
        "cell",
        F.struct(
            "src",
            (
                bits * 4
                + F.when(bits < 3, F.col("size") % 4).otherwise(
                    F.expr("shiftright(size, length(bin(size)) - 3) - 4")
                )
            )
            .cast("int")
            .alias("class"),
            (F.conv(F.substring(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit(""))), 1, 4), 16, 10).cast("int") % HASHED).alias("part"),
        ),
    )
    cells = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    sizes = cells.groupBy(F.col("cell.src").alias("src")).agg(F.sum("words").alias("source_size"))
    starts = cells.select(
        "cell",
        F.coalesce(
            F.sum("n").over(
                W.partitionBy("cell.src")
                .orderBy("cell.class", "cell.part")
                .rowsBetween(W.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("start"),
    )
    facts = (
        starts.join(targets(sizes, weights, most), F.col("cell.src") == F.col("src"))
        .select(F.col("cell").alias("_cell"), "start", "source_size", "target")
    )
    inside = F.row_number().over(W.partitionBy("cell").orderBy("size", F.col("_id").asc_nulls_last()))
    placed = rows.withColumn("place", inside).join(facts, F.col("cell") == F.col("_cell"))
    place = (F.col("start") + F.col("place")).cast("double")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shift = F.lit(offset(seed))
    copies = F.floor(shift + place * rate) - F.floor(shift + (place - 1) * rate)
    out = placed.withColumn("copies", copies.cast("long")).withColumn(
        "taken", F.col("copies") * F.col("size")
    )
    names = fresh(docs.select(*[column(docs, name) for name in keep]), *added)
    return out.select(
        *[F.col(f"_in_{i}").alias(name) for i, name in enumerate(keep)],
        *[F.col(name).alias(new) for name, new in zip(added, names, strict=True)],
    )


def sample(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its own columns."""
    mixed = mix(docs, **options)
    copies = mixed.columns[len(docs.columns) + 3]
    return mixed.withColumn(
        fresh(mixed, "_copy")[0], F.explode(F.sequence(F.lit(1), F.col(f"`{copies}`")))
    ).where(F.col(f"`{copies}`") > 0).select(*[column(mixed, name) for name in docs.columns])
