"""Nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

The largest inner product is the smallest distance once each vector gets one more
coordinate that brings all to the same length (queries get 0 there, and that length, which
changes no order). Vectors are rotated at random, so that any block of columns says something
about the whole distance, and dealt to lists by their nearest centroid; centroids come from a
bounded sample. Vectors over ``FAR`` times longer than the median would drown the others'
differences: they lie in a list of their own that every query visits, where nothing is given
up. Besides it a query visits the lists whose centroids are nearest, a share of all lists, and
further ones until they hold k + 1 vectors. In a list it is compared block of
columns by block, in double precision: after each block a test on the partial distance gives up candidates that,
with high confidence, are farther than the k-th best found so far; the others go on. What is
left is ordered by inner product, and scored by that of the original vectors.

A list is cut into blocks of bounded size by hash, so a crowded list is many tasks. Equal
vectors are one item of the index; only the ``k + 1`` smallest ids of such a class can ever
be among k results, so these alone are expanded.

The share of lists is high (``SHARE``) because the given vectors have no clusters: with a
tenth of the lists half of the true neighbours are found, with 0.8 of them about 0.95 after tests that give up early. Clustered
vectors need far less; ``share`` is a parameter.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components,
those of another length than most, and null ids take no part; rows that share an id are one
candidate, with their best score, and are never each other's neighbours; with fewer than k
candidates all found are returned; no vectors give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.buckets import BLOCK, runs
from tallyhouse.llm.common import column
from tallyhouse.llm.lattice import usable
from tallyhouse.session import settle

K = 20
SHARE = 0.8
SAMPLE = 20_000  # vectors that centroids are fitted on
COLUMNS = 16  # columns of one block
DOUBT = 2.1  # standard errors that a partial distance may be off
FEW = 0.03  # share of a block's pairs below which they are compared one by one
SPARE = 10  # candidates kept beyond k until the exact scores decide
HELD = 200_000  # queries whose results a task holds before it hands them on
FAR = 1000.0  # times the median length beyond which vectors have a list of their own
SEED = 7


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    """Lloyd's rounds on a bounded sample; fewer centroids if the sample has fewer points."""
    points = np.unique(sample, axis=0)
    lists = min(lists, len(points))
    centres = points[np.random.default_rng(seed).permutation(len(points))[:lists]].copy()
    for _ in range(rounds):
        own = nearest(points, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=lists)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each point, nearest first."""
    out = []
    for start in range(0, len(points), 4096):
        gap = (centres**2).sum(axis=1) - 2 * points[start : start + 4096] @ centres.T
        if n == 1:
            out.append(gap.argmin(axis=1)[:, None])
        else:
            out.append(np.argsort(gap, axis=1, kind="stable")[:, :n])
    return np.concatenate(out) if out else np.zeros((0, n), dtype=int)


def scan(queries: np.ndarray, points: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, ...]:
    """Query, point and squared distance of the pairs that no test gives up.

    ``bound``: per query, the squared distance to beat.
    """
    dim = queries.shape[1]
    partial = np.zeros((len(queries), len(points)))
    alive = np.ones(partial.shape, dtype=bool)
    a = b = None
    for start in range(0, dim, COLUMNS):
        stop = min(start + COLUMNS, dim)
        q, p = queries[:, start:stop], points[:, start:stop]
        slack = (1 + DOUBT / np.sqrt(stop)) ** 2 if stop < dim else 1 + 1e-5
        most = (slack * bound + 1e-6) * (stop / dim)
        if a is None:
            partial += (q**2).sum(axis=1)[:, None] + (p**2).sum(axis=1) - 2 * q @ p.T
            alive &= partial <= most[:, None]
            if np.count_nonzero(alive) < FEW * alive.size:
                a, b = np.nonzero(alive)
                partial = partial[a, b]
        else:
            partial += ((q[a] - p[b]) ** 2).sum(axis=1)
            go = partial <= most[a]
            a, b, partial = a[go], b[go], partial[go]
    if a is None:
        a, b = np.nonzero(alive)
        partial = partial[a, b]
    return a, b, partial


def search(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    share: float = SHARE,
    lists: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``query_id rank vec_id score`` of each query's ``k`` nearest rows but its own.

    ``is_query`` is a condition on ``vectors``; ``lists`` defaults to the square root of the
    number of different vectors, at most one per eight sampled ones.
    """
    spark = vectors.sparkSession
    raw = column(vectors, vector_col)
    rows = vectors.select(
        column(vectors, id_col).cast("long").alias("id"),
        is_query.alias("asks"),
        raw.cast("array<double>").alias("v"),
    ).where(usable(raw) & F.col("id").isNotNull())
    rows = settle(
        rows.withColumns({"c0": F.xxhash64("v"), "c1": F.xxhash64(F.lit(1), F.col("v"))})
    )
    # One row per vector length and per length of the norm's scale: facts of fixed size.
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")
    )
    facts = lengths.orderBy(F.desc("n"), "dim").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if facts is None:
        return spark.createDataFrame([], empty)
    dim, scale = facts["dim"], facts["most"]
    rows = rows.where(F.size("v") == dim)

    by_class = W.partitionBy("c0", "c1").orderBy("id")
    smallest = (
        rows.groupBy("c0", "c1", "id")
        .agg(F.first("v").alias("v"))
        .withColumn("nth", F.row_number().over(by_class))
        .where(F.col("nth") <= k + 1)
    )
    smallest = settle(smallest)
    heads = smallest.where("nth = 1").select(F.col("id").alias("rep"), "c0", "c1", "v")
    members = smallest.select("c0", "c1", "id").join(
        heads.select("c0", "c1", "rep"), ["c0", "c1"]
    ).select("rep", "id")
    asking = rows.where("asks").select("id", "c0", "c1").distinct().join(
        heads.select("c0", "c1", "rep"), ["c0", "c1"]
    ).select(F.col("id").alias("query_id"), F.col("rep").alias("query"))
    asking = settle(asking)

    # Lengths relative to the largest component, so that no square overflows.
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / scale) * (x / scale)))
    lengths = heads.select(length.alias("length"), "rep", "v")
    middle = lengths.agg(F.percentile_approx("length", 0.5)).first()[0]
    usual = lengths.where(F.col("length") <= FAR * middle)
    number = usual.agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("length")).first()
    unit = number["length"] or 1.0
    drawn = usual.orderBy(F.xxhash64("rep", F.lit(seed))).limit(SAMPLE).select("v").collect()
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]

    def rotated(values, as_query: bool) -> np.ndarray:
        """Rotated vectors, the longest usual one of length one, and the coordinate besides."""
        v = np.stack(list(values)).astype(float) / scale
        if as_query:
            v = v / np.abs(v).max(axis=1)[:, None]
            v = v / np.linalg.norm(v, axis=1)[:, None]
            return np.column_stack([v @ rotation, np.zeros(len(v))])
        v = v / unit
        return np.column_stack([v @ rotation, np.maximum(1 - (v**2).sum(axis=1), 0) ** 0.5])

    want = lists or min(int(np.ceil(number["n"] ** 0.5)), max(1, SAMPLE // 8))
    centres = spark.sparkContext.broadcast(
        fit_centroids(rotated([r["v"] for r in drawn], False), want, seed=seed)
    )
    visits = max(1, int(np.ceil(share * len(centres.value))))

    def filed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            at = rotated(frame["v"], False)
            own = nearest(at, centres.value, 1)[:, 0]
            own[(frame["length"] > FAR * middle).to_numpy()] = -1
            data = [row.tobytes() for row in at]
            yield pd.DataFrame({"list": own, "id": frame["rep"], "data": data})

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            at = rotated(frame["v"], True)
            data = [row.tobytes() for row in at]
            near = nearest(at, centres.value, len(centres.value))
            held = np.cumsum(filled.value[near], axis=1)
            lists = [
                [-1, *row[: max(visits, int(np.searchsorted(sums, k + 1)) + 1)]]
                for row, sums in zip(near, held, strict=True)
            ]
            yield pd.DataFrame({"lists": lists, "id": frame["rep"], "data": data})

    index = settle(lengths.mapInPandas(filed, "list int, id long, data binary"))
    # One row per list, and there are no more lists than the square root of the vectors.
    sizes = index.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(len(centres.value), dtype=np.int64)
    for r in sizes.where("list >= 0").collect():
        counts[r["list"]] = r["n"]
    filled = spark.sparkContext.broadcast(counts)
    sizes = sizes.select("list", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    queries = heads.join(asking.select(F.col("query").alias("rep")).distinct(), "rep", "left_semi")
    queries = queries.select("rep", "v").mapInPandas(asked, "lists array<int>, id long, data binary")
    queries = queries.select(F.explode("lists").alias("list"), "id", "data").join(sizes, "list")
    # Queries of a list are cut into blocks as well; each meets each block of the list.
    per_list = queries.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("turns"))
    dealt_queries = (
        queries.join(per_list, "list")
        .withColumn("turn", F.pmod(F.xxhash64("id"), F.col("turns")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("list", "block", "turn", F.lit(True).alias("asks"), "id", "data")
    )
    dealt_index = (
        index.join(sizes, "list")
        .join(per_list, "list")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        .select("list", "block", "turn", F.lit(False).alias("asks"), "id", "data")
    )
    most = k + 1 + SPARE

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The best so far of each query in this task, by inner product.
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def hand_on() -> pd.DataFrame:
            parts = [
                pd.DataFrame({"query": query, "id": ids, "gap": gaps})
                for query, (ids, gaps) in held.items()
            ]
            return pd.concat(parts, ignore_index=True)

        for run in runs(frames, ["list", "block", "turn"]):
            asks, ids = run["asks"].astype(bool), run["id"]
            data = np.frombuffer(b"".join(run["data"]), dtype=float).reshape(len(ids), -1)
            who, what = ids[asks], ids[~asks]
            nothing = (np.zeros(0, dtype=np.int64), np.zeros(0))
            before = [held.get(int(query), nothing) for query in who]
            # Queries and padded vectors have length one. Far vectors have not: all are scored.
            usual = run["list"][0] >= 0
            bound = np.array([2 + 2 * g[-1] if usual and len(g) >= most else np.inf for _, g in before])
            bound = np.maximum(bound, 0)
            if usual:
                a, b, distance = scan(data[asks], data[~asks], bound)
                gap = distance / 2 - 1
            else:
                a, b = np.divmod(np.arange(len(who) * len(what)), max(1, len(what)))
                gap = -(data[asks] @ data[~asks].T).ravel()
            starts = np.searchsorted(a, np.arange(len(who) + 1))
            for i, query in enumerate(who):
                part = slice(starts[i], starts[i + 1])
                if part.start == part.stop:
                    continue
                new_ids = np.concatenate([before[i][0], what[b[part]]])
                new_gaps = np.concatenate([before[i][1], gap[part]])
                if len(new_gaps) > 4 * most:
                    near = np.argpartition(new_gaps, most - 1)[:most]
                    reach = new_gaps <= new_gaps[near].max()
                    new_ids, new_gaps = new_ids[reach], new_gaps[reach]
                order = np.lexsort((new_ids, new_gaps))[:most]
                held[int(query)] = (new_ids[order], new_gaps[order])
            if len(held) > HELD:
                yield hand_on()
                held.clear()
        if held:
            yield hand_on()

    found = (
        dealt_queries.union(dealt_index)
        .repartition("list", "block", "turn")
        .sortWithinPartitions("list", "block", "turn")
        .mapInPandas(probe, "query long, id long, gap double")
    )
    per_query = W.partitionBy("query").orderBy("gap", "id")
    near = found.withColumn("nth", F.row_number().over(per_query)).where(F.col("nth") <= most)

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            dots = [float(np.dot(x, y)) for x, y in zip(frame["x"], frame["y"], strict=True)]
            yield pd.DataFrame({"query": frame["query"], "rep": frame["id"], "score": dots})

    exact = (
        near.select("query", "id")
        .join(heads.select(F.col("rep").alias("query"), F.col("v").alias("x")), "query")
        .join(heads.select(F.col("rep").alias("id"), F.col("v").alias("y")), "id")
        .mapInPandas(scored, "query long, rep long, score double")
    )
    by_score = [F.desc("score"), F.asc("id")]
    first = W.partitionBy("query").orderBy(*by_score)
    expanded = (
        exact.join(members, "rep")
        .groupBy("query", "id")
        .agg(F.max("score").alias("score"))
        .withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= k + 1)
    )
    own = W.partitionBy("query_id").orderBy(*by_score)
    return (
        asking.join(expanded, "query")
        .where("id <> query_id")
        .groupBy("query_id", "id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
