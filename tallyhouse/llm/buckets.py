"""Links between the members of hash buckets, without writing down all pairs of a bucket.

Each item carries a 128-bit sketch (``s0``, ``s1``) whose differing bits grow with the
items' distance, a size ``n``, and possibly a longer signature ``sig`` whose equal bytes
decide more sharply. Whether two items are linked is decided on their payloads.

1. Every member of a bucket is compared with the bucket's smallest id alone; the links that
   hold are joined to components. From here on two members of a bucket matter only if their
   components differ, and only buckets that hold several components are looked at.
2. These are compared whole, in blocks. Of the pairs that sketches, sizes and signatures
   allow, the few nearest of each member leave and are decided; components are joined again.
3. Buckets that had more such pairs get their members' payloads, and all their pairs between
   components are decided where they lie; only links leave.

So a bucket of many near copies costs a few comparisons each, no pair that is not a link is
written beyond a few per member, and no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.components import compact, components
from tallyhouse.session import settle

BLOCK = 1024  # rows on either side of one comparison
NEAREST = 4  # pairs of each member that leave its bucket undecided


def differing(a: str, b: str) -> Column:
    """Differing sketch bits of the structs ``a`` and ``b``."""
    bits = [F.bit_count(F.col(a)[s].bitwiseXOR(F.col(b)[s])) for s in ("s0", "s1")]
    return bits[0] + bits[1]


def runs(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The runs of equal keys of a sorted partition, the columns of each as arrays."""
    rest: dict[str, np.ndarray] = {}
    for frame in frames:
        if frame.empty:
            continue
        columns = {name: frame[name].to_numpy() for name in frame.columns}
        if rest:
            columns = {name: np.concatenate([rest[name], v]) for name, v in columns.items()}
        new = np.logical_or.reduce([columns[key][1:] != columns[key][:-1] for key in keys])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield {name: v[begin:end] for name, v in columns.items()}
        rest = {name: v[cuts[-1] :] for name, v in columns.items()}
    if rest:
        yield rest


def in_blocks(members: DataFrame, key: str, item: str, facts: DataFrame | None = None) -> DataFrame:
    """Rows of each comparison (``key, i, j``), with their ``side``: a group of at most
    ``BLOCK`` rows is one, a larger one is cut into blocks, each compared with each.

    ``facts`` of each ``item`` are joined once groups are counted: ``members``, read twice,
    stays narrow.
    """
    sizes = members.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, key).withColumn(
        "side", F.pmod(F.xxhash64(item), F.col("blocks")).cast("int")
    )
    if facts is not None:
        dealt = dealt.join(facts, item)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return (
        dealt.select("*", other)
        .withColumn("i", F.least("side", "other"))
        .withColumn("j", F.greatest("side", "other"))
        .drop("blocks", "other")
        .repartition(key, "i", "j")
        .sortWithinPartitions(key, "i", "j")
    )


class Filter:
    """Which pairs of a block's two sides can be linked, by what travels with every member."""

    def __init__(self, most: int, agree: int = 0):
        self.most, self.agree = most, agree

    def __call__(self, run: dict[str, np.ndarray]) -> tuple[dict, dict, np.ndarray, np.ndarray]:
        a = b = run
        if run["i"][0] != run["j"][0]:
            first = run["side"] == run["i"][0]
            a, b = ({c: v[at] for c, v in run.items()} for at in (first, ~first))
        bits = np.bitwise_count(a["s0"][:, None] ^ b["s0"]).astype(np.int16)
        bits += np.bitwise_count(a["s1"][:, None] ^ b["s1"])
        wanted = (bits <= self.most) & (a["component"][:, None] != b["component"])
        if wanted.any():
            n, m = a["n"][:, None], b["n"]
            able = (4 * np.minimum(n, m) >= 3 * np.maximum(n, m)) & (a["id"][:, None] != b["id"])
            bits[~able] = 999
            wanted &= able
            if self.agree:
                self._signatures(a, b, wanted)
        return a, b, bits, wanted

    def _signatures(self, a: dict, b: dict, wanted: np.ndarray) -> None:
        """Take back pairs whose signatures agree in too few bytes."""
        first, second = (
            np.frombuffer(b"".join(x["sig"]), np.uint8).reshape(len(x["id"]), -1) for x in (a, b)
        )
        x, y = np.nonzero(wanted)
        for start in range(0, len(x), 20_000):
            i, j = x[start : start + 20_000], y[start : start + 20_000]
            wanted[i, j] = (first[i] == second[j]).sum(axis=1) >= self.agree


def nearest_pairs(rows: DataFrame, facts: DataFrame, allowed: Filter) -> DataFrame:
    """Pairs ``a < b`` that may be linked, of which one is among the other's ``NEAREST``; and
    for each bucket with more pairs a row with its key in ``b`` and no ``a``.

    ``rows``: ``key id component``; ``facts``: ``id s0 s1 n sig``.
    """

    def near(bits: np.ndarray) -> np.ndarray:
        if max(bits.shape) <= NEAREST:
            return np.ones(bits.shape, dtype=bool)
        at = np.zeros(bits.shape, dtype=bool)
        np.put_along_axis(at, np.argsort(bits, axis=1, kind="stable")[:, :NEAREST], True, axis=1)
        np.put_along_axis(at, np.argsort(bits, axis=0, kind="stable")[:NEAREST], True, axis=0)
        return at

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, crowded = [], []
        for run in runs(frames, ["key", "i", "j"]):
            a, b, bits, wanted = allowed(run)
            if wanted.any():
                close = near(bits)
                if (wanted & ~close).any():
                    crowded.append(int(run["key"][0]))
                x, y = np.nonzero(wanted & close)
                pair = np.sort(np.stack([a["id"][x], b["id"][y]], axis=1), axis=1)
                found.append(np.unique(pair, axis=0))
            if len(found) > 10_000:
                yield pd.DataFrame(np.concatenate(found), columns=["a", "b"], dtype="Int64")
                found = []
        if found:
            yield pd.DataFrame(np.concatenate(found), columns=["a", "b"], dtype="Int64")
        if crowded:
            yield pd.DataFrame({"a": [None] * len(crowded), "b": crowded}, dtype="Int64")

    return in_blocks(rows, "key", "id", facts).mapInPandas(compare, "a long, b long").distinct()


def links_inside(
    rows: DataFrame, facts: DataFrame, allowed: Filter, linked: Callable[[bytes, bytes], bool]
) -> DataFrame:
    """Links ``a, b`` that join the components of each bucket, decided on ``payload``.

    ``rows``: ``key id component``; ``facts``: ``id s0 s1 n sig keys payload``. With ``keys``, a pair is decided only in the first bucket that both its members are in.
    """

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(frames, ["key", "i", "j"]):
            a, b, bits, wanted = allowed(run)
            x, y = np.nonzero(wanted)
            if len(x) and len(run["keys"][0]):
                k, m = np.stack(a["keys"]), np.stack(b["keys"])
                first = np.zeros(len(x), dtype=bool)
                for start in range(0, len(x), 20_000):
                    part = slice(start, start + 20_000)
                    shared = k[x[part]] == m[y[part]]
                    at = shared.argmax(axis=1)
                    first[part] = k[x[part], at] == run["key"][0]
                x, y = x[first], y[first]
            root = {c: c for c in np.unique(run["component"]).tolist()}

            def top(c: int, root=root) -> int:
                while root[c] != c:
                    c = root[c] = root[root[c]]
                return c

            links = []
            for at in np.argsort(bits[x, y], kind="stable"):
                i, j = x[at], y[at]
                c, d = top(int(a["component"][i])), top(int(b["component"][j]))
                if c != d and linked(a["payload"][i], b["payload"][j]):
                    root[c] = d
                    links.append((a["id"][i], b["id"][j]))
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    return in_blocks(rows, "key", "id", facts).mapInPandas(compare, "a long, b long").distinct()


def linked_components(
    buckets: DataFrame,
    sketches: DataFrame,
    allowed: Filter,
    payloads: Callable[[DataFrame], DataFrame],
    linked: Callable[[bytes, bytes], bool],
) -> DataFrame:
    """``id`` and ``component`` of all items that have a link.

    ``buckets``: ``key id``; ``sketches``: ``id s0 s1 n sig keys``; ``payloads`` gives ``id
    payload`` of a frame of ids, and ``linked`` decides on two payloads. Payloads are made
    once, for the items that share a bucket with another.
    """

    def decided(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = [linked(x, y) for x, y in zip(frame["x"], frame["y"], strict=True)]
            yield frame.loc[keep, ["a", "b"]]

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs
        for side, name in (("a", "x"), ("b", "y")):
            facts = held.select(F.col("id").alias(side), F.col("payload").alias(name))
            both = both.join(facts, side)
        return compact(both.mapInPandas(decided, "a long, b long").distinct())

    leaders = (
        buckets.groupBy("key")
        .agg(F.min("id").alias("leader"), F.max("id").alias("last"))
        .where("leader < last")
        .drop("last")
    )
    crowded = compact(buckets.join(leaders, "key"))
    held = settle(payloads(crowded.select("id").distinct()))
    stars = crowded.where("leader < id").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    near = stars.distinct()
    for side in ("a", "b"):
        facts = sketches.select(F.col("id").alias(side), F.struct("s0", "s1", "n").alias(f"{side}_"))
        near = near.join(facts, side)
    sizes = F.least("a_.n", "b_.n") * 4 >= F.greatest("a_.n", "b_.n") * 3
    links = verify(near.where((differing("a_", "b_") <= allowed.most) & sizes).select("a", "b"))
    found = components(links)

    def open_rows(found: DataFrame) -> DataFrame:
        """Members of the buckets that hold several components: ``key id component``."""
        known = crowded.join(found, "id", "left").select(
            "key", "id", F.coalesce("component", "id").alias("component")
        )
        several = (
            known.groupBy("key")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low < high")
            .select("key")
        )
        return known.join(several, "key", "left_semi")

    pairs = compact(nearest_pairs(compact(open_rows(found)), sketches.drop("keys"), allowed))
    if pairs.isEmpty():
        return found
    more = verify(pairs.where("a is not null"))
    if not more.isEmpty():
        links = compact(links.union(more))
        found = components(links)
    rest = pairs.where("a is null").select(F.col("b").alias("key"))
    if rest.isEmpty():
        return found
    rows = compact(open_rows(found).join(rest, "key", "left_semi"))
    more = compact(links_inside(rows, sketches.join(held, "id"), allowed, linked))
    return found if more.isEmpty() else components(links.union(more))
