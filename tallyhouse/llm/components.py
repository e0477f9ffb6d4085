"""Connected components by alternating large-star and small-star rounds.

Before a round, each task joins the links it reads itself, ``PER_TASK`` at a time, and hands
on one link per node: to the smallest node that these links reach. Rounds join what lies in
several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import settle


PER_TASK = 200_000  # narrow rows that one task reads


def compact(df: DataFrame) -> DataFrame:
    """Settled narrow rows in as many partitions as they fill, so that what follows does not
    write a file per empty one. Large frames keep their partitions."""
    rows = settle(df)
    return rows.coalesce(max(1, -(-rows.count() // PER_TASK)))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one around the node."""
    around = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    linked = around.join(least, "u").where("v > u")
    return linked.select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(least, "hi")
    others = joined.where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return others.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def lowest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links ``a, b``, sorted, and the smallest node that each reaches by them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = (np.concatenate([batch.column(i).to_numpy() for batch in held]) for i in (0, 1))
        nodes, least = lowest(*ends)
        links = nodes != least
        return pa.RecordBatch.from_arrays([pa.array(nodes[links]), pa.array(least[links])], names=["hi", "lo"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= PER_TASK:
            yield stars(held)
            held, rows = [], 0
    if rows:
        yield stars(held)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger node has one link, and no smaller node is a larger one elsewhere."""
    ends = edges.select(F.col("hi").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("lo", F.lit(0), F.lit(1))
    )
    ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id in links ``a, b``.

    Rounds go on until the links are stars around the smallest ids, each cut into the shared
    folder. Only whether they are, and counts, come to the driver. A node with very many links
    is a key of counted aggregates and of joins that adaptive execution splits.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = links
    while True:
        edges = settle(edges.mapInArrow(_joined, "hi long, lo long"))
        edges = compact(_small_star(settle(_large_star(edges))))
        if _are_stars(edges):
            break
    pairs = edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component"))
    return pairs.union(roots.distinct())
