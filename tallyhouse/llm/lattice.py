"""Near-duplicate vectors by lattice hashing.

Vectors are brought to length one and projected at random to a few blocks of eight
dimensions, scaled so that a projected distance is on average the true one. The nearest
points of the E8 lattice are the cell; several tables with other projections hash each
vector, and each also into the neighbouring cells next in distance. Members of a cell are
candidates; a sketch of 128 projection signs drops most, and the rest is verified by cosine
in double precision.

Links join vectors to components (see ``buckets``: no list of all pairs of a cell is made).
The number of links of a vector is then counted inside its component, block against block,
as links never leave it. Equal vectors are one item with a count.

With a cosine of 0.9 in 64 dimensions a pair meets in one of the tables with a probability
of 0.9997 (measured; see the tests); nearer pairs meet more surely.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
have no link; vectors of different lengths are compared by none; a null id is never a
component's name and has no links but those of its copies; rows that share an id and a
vector are one vector; no vectors give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.buckets import Filter, in_blocks, linked_components, runs
from tallyhouse.llm.common import column
from tallyhouse.llm.minhash import mixed
from tallyhouse.session import settle

LEAST = 0.9
TABLES, BLOCKS, PROBES = 12, 2, 3  # probes per block of eight dimensions
CELL = 1.5  # lattice scale, in distances of a pair at the threshold
SEED = 3


@cache
def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to neighbouring cells."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        signs = np.array([1 if bits >> k & 1 else -1 for k in range(8)])
        if (signs < 0).sum() % 2 == 0:
            out.append(signs / 2)
    return np.array(out)


def _d8(x: np.ndarray) -> np.ndarray:
    """The nearest points of D8: whole coordinates with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    gap = x[odd] - near[odd]
    worst = np.abs(gap).argmax(axis=1)
    step = np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    near[odd, worst] += step
    return near


def e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, which is D8 and D8 moved by one half."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@cache
def projections(dim: int, tables: int, blocks: int, seed: int) -> list[np.ndarray]:
    draw = np.random.default_rng([seed, dim])
    out = []
    for _ in range(tables):
        plane = draw.standard_normal((dim, 8 * blocks))
        if dim >= 8 * blocks:
            plane = np.linalg.qr(plane)[0] * np.sqrt(dim / 8)
        else:
            plane /= np.sqrt(8)
        out.append(plane)
    return out


@cache
def _signs(dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, 1]).standard_normal((dim, 128))


def cells(
    unit: np.ndarray, least: float, tables: int, blocks: int, probes: int, seed: int, scale: float = CELL
) -> np.ndarray:
    """Keys (vectors x tables * (1 + blocks * probes)) of the own and neighbouring cells."""
    size = scale * np.sqrt(2 * (1 - least))
    odd = np.random.default_rng([seed, 2]).integers(1, 2**62, 8 * blocks, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = []
    for number, plane in enumerate(projections(unit.shape[1], tables, blocks, seed)):
        x = (unit @ plane / size).reshape(-1, blocks, 8)
        own = np.stack([e8(x[:, b]) for b in range(blocks)], axis=1)
        chosen = [own]
        for b in range(blocks):
            # Neighbours in order of distance: |e - r|^2 = |e|^2 - 2 e.r + 2.
            ahead = (x[:, b] - own[:, b]) @ _roots().T
            best = np.argpartition(-ahead, range(probes), axis=1)[:, :probes]
            for k in range(probes):
                moved = own.copy()
                moved[:, b] += _roots()[best[:, k]]
                chosen.append(moved)
        for point in chosen:
            # Doubled coordinates are whole numbers.
            code = (2 * point).astype(np.int64).reshape(len(unit), -1).astype(np.uint64)
            with np.errstate(over="ignore"):
                out.append(mixed((mixed(code) * odd).sum(axis=1) + np.uint64(number)).view(np.int64))
    return np.stack(out, axis=1)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: some component is not 0, all are finite numbers."""
    wide = vector.cast("array<double>")
    finite = F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(wide, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = LEAST,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    probes: int = PROBES,
    seed: int = SEED,
) -> DataFrame:
    """Per row: ``vec_id n_links component_id kept``."""
    value = column(vectors, vector_col).cast("array<double>")
    rows = vectors.select(
        column(vectors, id_col).cast("long").alias("id"),
        F.when(usable(column(vectors, vector_col)), value).alias("v"),
    ).withColumns({"c0": F.xxhash64("v"), "c1": F.xxhash64(F.lit(1), F.col("v"))})
    rows = settle(rows)
    classes = (
        rows.where("v is not null")
        .dropDuplicates(["id", "c0", "c1"])
        .groupBy("c0", "c1")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    )
    first = rows.join(classes, ["c0", "c1"]).where("id = rep").dropDuplicates(["c0", "c1"])

    # Bits that differ on average at the threshold, plus five deviations.
    p = float(np.arccos(least) / np.pi)
    most = int(128 * p + 5 * np.sqrt(128 * p * (1 - p)))

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["v"].map(len)
            for dim, some in frame.groupby(sizes):
                unit = unit_rows(np.stack(some["v"].to_list()))
                signs = np.packbits(unit @ _signs(dim, seed) > 0, axis=1).view(np.int64)
                keys = cells(unit, least, tables, blocks, probes, seed)
                yield pd.DataFrame(
                    {
                        "id": some["id"].to_numpy(),
                        "copies": some["copies"].to_numpy(),
                        "s0": signs[:, 0],
                        "s1": signs[:, 1],
                        "n": np.ones(len(some), dtype=np.int64),
                        "unit": [row.tobytes() for row in unit],
                        "keys": list(keys),
                    }
                )

    schema = "id long, copies long, s0 long, s1 long, n long, unit binary, keys array<long>"
    items = settle(first.select("id", "copies", "v").mapInPandas(hashed, schema))
    buckets = items.select(F.explode("keys").alias("key"), "id").distinct()

    def linked(x: bytes, y: bytes) -> bool:
        return len(x) == len(y) and float(np.dot(np.frombuffer(x), np.frombuffer(y))) >= least

    def units(ids: DataFrame) -> DataFrame:
        return items.join(ids, "id", "left_semi").select("id", F.col("unit").alias("payload"))

    none, no_keys = F.lit(b"").alias("sig"), F.array().cast("array<long>").alias("keys")
    facts = items.select("id", "s0", "s1", "n", none, no_keys)
    found = settle(linked_components(buckets, facts, Filter(most), units, linked))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(frames, ["component", "i", "j"]):
            side, ids, copies = run["side"], run["id"], run["copies"]
            same = run["i"][0] == run["j"][0]
            lengths = np.array([len(unit) for unit in run["unit"]])
            for length in np.unique(lengths):
                some = np.flatnonzero(lengths == length)
                unit = np.frombuffer(b"".join(run["unit"][some])).reshape(len(some), -1)
                at = [np.flatnonzero(side[some] == run[s][0]) for s in ("i", "j")]
                near = unit[at[0]] @ unit[at[1]].T >= least
                if same:
                    np.fill_diagonal(near, False)
                a, b = some[at[0]], some[at[1]]
                for x, hits, y in [(a, near, b), (b, near.T, a)][: 1 if same else 2]:
                    yield pd.DataFrame({"id": ids[x], "others": hits @ copies[y]})

    members = items.select("id", "copies", "unit").join(found, "id")
    counts = (
        in_blocks(members, "component", "id")
        .mapInPandas(count, "id long, others long")
        .groupBy("id")
        .agg(F.sum("others").alias("others"))
    )
    names = (
        classes.join(found, F.col("rep") == F.col("id"), "left").drop("id")
        .join(counts, F.col("rep") == F.col("id"), "left")
        .select(
            "c0",
            "c1",
            F.coalesce("component", "rep").alias("component"),
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
        )
    )
    taken = F.col("v").isNotNull()
    own = F.when(taken, F.col("component")).otherwise(F.col("id"))
    return (
        rows.join(names, ["c0", "c1"], "left")
        .select(
            F.col("id").alias("vec_id"),
            F.when(taken, F.col("links")).otherwise(0).cast("long").alias("n_links"),
            own.alias("component_id"),
        )
        .withColumn(
            "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
        )
    )
