"""Near-duplicate documents by MinHash with banding.

A document is the set of its distinct five-word shingles (words between white space, A-Z in
lower case; fewer words are one shingle). 256 universal hash functions give the set's
signature of minima. Bands of four minima, 32 of them, are bucket keys; a bit of each of
their 128 minima makes a sketch, and a byte of all 256 the signature that candidate pairs
are verified with. What passes is confirmed on the full sets: a link is an intersection of
at least 75 % of the union. Components come from alternating large-star and small-star
rounds.

Two sets at the threshold share no band with probability 5e-6; the bounds on sketch and
signature lie five standard deviations off. Documents with the same words are one item: copies meet as
equal sequence hashes and are never paired. A document's id stands for all rows with it.

Defined cases: a null, empty or blank text has no shingle and no link; a null id is never a
component's name, a row without id belongs to its copies' component or, without copies, to
none (null) and is kept; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.buckets import Filter, linked_components
from tallyhouse.llm.common import WORD, column, fresh
from tallyhouse.session import settle

WORDS = 5
HASHES, BANDED, ROWS = 256, 128, 4
MOST_BITS = 35  # 128 / 8 bits differ on average at the threshold, plus five deviations
LEAST_AGREE = 158  # 256 * 0.751 bytes agree on average at the threshold, less five deviations
SLICE = 4_000_000  # bytes of text that are hashed at once

_DRAW = np.random.default_rng(5)
_BASE, _SEQ1, _SEQ2 = (int(x) | 1 for x in _DRAW.integers(2**62, 2**63, 3))
_LETTERS = _DRAW.integers(1, 2**63, 256, dtype=np.uint64)
_LETTERS[ord("A") : ord("Z") + 1] = _LETTERS[ord("a") : ord("z") + 1]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True
_PLACES = _DRAW.integers(2**62, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
_TIMES = _DRAW.integers(0, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_PLUS = _DRAW.integers(0, 2**63, HASHES, dtype=np.uint64)
_BANDS = _DRAW.integers(0, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _spans(values: np.ndarray, base: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial hash of each span of ``values``, modulo 2**64."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=sums[1:])
    back = _powers(pow(base, -1, 2**64), len(values) + 1)
    return (sums[end] - sums[begin]) * back[begin]


def spans_of_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where words begin and end in texts that lie one after another, and words per text.

    ``data``: the bytes; ``offsets``: where texts begin, and the end.
    """
    solid = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True  # words end with their text
    before = np.concatenate([[False], solid[:-1]])
    begin = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.concatenate([solid[1:], [False]])
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return begin, end, np.diff(np.searchsorted(begin, offsets))


def word_hashes(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, letters: np.ndarray = _LETTERS
) -> np.ndarray:
    return mixed(_spans(letters[data], _BASE, begin, end))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many each text has."""
    begin, end, counts = spans_of_words(data, offsets)
    return word_hashes(data, begin, end), counts


def shingles(hashes: np.ndarray) -> np.ndarray:
    """The sorted set of a document's shingles, from its words."""
    n = len(hashes) - WORDS + 1
    if n > 0:
        parts = sum(hashes[i : i + n] * _PLACES[i] for i in range(WORDS))
        return np.unique(mixed(parts))
    if len(hashes):
        return mixed(np.array([(hashes * _PLACES[: len(hashes)]).sum() + np.uint64(len(hashes))]))
    return hashes


def signature(items: np.ndarray) -> np.ndarray:
    """The minima of a set that is not empty."""
    least = np.full(HASHES, np.uint64(2**64 - 1))
    for start in range(0, len(items), 1024):
        some = items[start : start + 1024]
        np.minimum(least, (_TIMES[:, None] * some + _PLUS[:, None]).min(axis=1), out=least)
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    parts = mixed(signatures[:, :BANDED]) * _BANDS[:BANDED]
    parts = parts.reshape(len(signatures), BANDED // ROWS, ROWS).sum(axis=2)
    return mixed(parts + np.arange(BANDED // ROWS, dtype=np.uint64)).view(np.int64)


def sketches(signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bit of each banded minimum as two numbers, and a byte of every minimum."""
    spread = mixed(signatures ^ np.uint64(77)) >> np.uint64(40)
    bits = (spread[:, :BANDED] & np.uint64(1)).astype(np.uint8)
    bits = np.packbits(bits, axis=1).view(np.int64).reshape(len(bits), 2)
    return bits, (spread & np.uint64(255)).astype(np.uint8)


def texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each slice of a batch: its first row, word hashes, words per text, text starts."""
    column_ = batch.column(1).fill_null(b"")
    offsets = np.frombuffer(column_.buffers()[1], dtype=np.int32)
    offsets = offsets[column_.offset : column_.offset + len(column_) + 1].astype(np.int64)
    data = column_.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column_):
        stop = int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1
        stop = min(max(stop, row + 1), len(column_))
        part = data[offsets[row] : offsets[stop]]
        hashes, counts = words(part, offsets[row : stop + 1] - offsets[row])
        yield row, hashes, counts, np.concatenate([[0], np.cumsum(counts)])
        row = stop


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        column(docs, id_col).cast("long").alias("id"),
        column(docs, text_col).cast("binary").alias("text"),
    )


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for row, hashes, counts, starts in texts(batch):
            full = [shingles(hashes[s : s + c]) for s, c in zip(starts, counts, strict=False)]
            n = np.array([len(x) for x in full], dtype=np.int64)
            some = np.flatnonzero(n)
            minima = np.stack([signature(full[i]) for i in some]) if len(some) else np.zeros((0, HASHES), np.uint64)
            keys = band_keys(minima)
            bits, bytes_ = sketches(minima)
            sequence = [_spans(hashes, base, starts[:-1], starts[1:]) for base in (_SEQ1, _SEQ2)]
            bands = BANDED // ROWS
            sigs = [b""] * len(n)
            for place, sig in zip(some, bytes_, strict=True):
                sigs[place] = sig.tobytes()
            lengths = np.where(n > 0, bands, 0)
            wide = np.zeros((len(n), 2), dtype=np.int64)
            wide[some] = bits
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(row, len(n)),
                    pa.array(n),
                    pa.array((mixed(sequence[0]) + counts.astype(np.uint64)).view(np.int64)),
                    pa.array(mixed(sequence[1]).view(np.int64)),
                    pa.array(wide[:, 0]),
                    pa.array(wide[:, 1]),
                    pa.array(sigs, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)),
                        pa.array(keys.ravel()),
                    ),
                ],
                names=["id", "n", "c0", "c1", "s0", "s1", "sig", "keys"],
            )


_SIGNED = "id long, n long, c0 long, c1 long, s0 long, s1 long, sig binary, keys array<long>"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, hashes, counts, starts in texts(batch):
            full = [shingles(hashes[s : s + c]).tobytes() for s, c in zip(starts, counts, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(full)), pa.array(full, pa.binary())],
                names=["id", "payload"],
            )


def _linked(x: bytes, y: bytes) -> bool:
    """Whether two full sets share at least three quarters of their union."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 75 * (len(x) + len(y) - both)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``doc_id n_shingles component_id kept``."""
    narrow = _narrow(docs, id_col, text_col)
    signed = settle(narrow.mapInArrow(_signed, _SIGNED))
    classes = signed.where("n > 0").groupBy("c0", "c1").agg(F.min("id").alias("rep"))
    first = signed.join(classes.where("rep is not null"), ["c0", "c1"]).where("id = rep")
    first = settle(first.select("id", "n", "s0", "s1", "sig", "keys"))
    buckets = first.select(F.explode("keys").alias("key"), "id")

    def sets(ids: DataFrame) -> DataFrame:
        held = narrow.join(ids, "id", "left_semi")
        return held.mapInArrow(_sets, "id long, payload binary")

    facts = first.select("id", "s0", "s1", "n", "sig", "keys")
    found = linked_components(buckets, facts, Filter(MOST_BITS, LEAST_AGREE), sets, _linked)
    names = classes.join(found, classes["rep"] == found["id"], "left").select(
        "c0", "c1", F.coalesce("component", "rep").alias("component_id")
    )
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return (
        signed.select("id", "n", "c0", "c1")
        .join(names, ["c0", "c1"], "left")
        .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id"))
        .withColumn(
            "kept",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()),
        )
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, repeated rows included.

    Rows are compared by a hash of id and text, so texts under one id are decided apart and
    rows without id like others. Of a group the smallest id stays, a row without id if there is
    no other; of rows with equal id and text one stays, any of them. Rows without words are in
    no group and all stay. Other columns are kept, whatever their names.
    """
    key, mark, again = fresh(docs, "_key", "_mark", "_again")
    id_, text = column(docs, id_col).cast("long"), column(docs, text_col)
    keyed = docs.withColumn(key, F.xxhash64(id_, text))
    report = near_duplicates(keyed, key, text_col).where("n_shingles > 0")
    groups = report.groupBy(F.col("doc_id").alias("key"), F.col("component_id").alias("group"))
    groups = groups.agg((F.count(F.lit(1)) > 1).alias("repeated"))
    ids = keyed.select(F.col(key).alias("key"), id_.alias("id")).distinct()
    groups = settle(groups.join(ids, "key"))
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "key"))["key"].alias("first"))
    # Few rows as a rule: keys that go, and keys that are held by several rows and stay.
    marks = groups.join(first, "group").where("key <> first or repeated").groupBy("key")
    marks = marks.agg(F.max(F.col("key") != F.col("first")).alias("goes"))
    marks = settle(marks.select(F.col("key").alias(mark), F.col("goes").alias(again)))
    once = keyed.join(marks, keyed[key] == marks[mark], "left_anti")
    stay = marks.where(~F.col(again))
    one = keyed.join(stay, keyed[key] == stay[mark], "left_semi").dropDuplicates([key])
    return once.union(one).drop(key)
