"""Packing tokenised documents into sequences by vector best-fit.

A document becomes its token ids and an end id. Documents over the capacity are cut into
pieces of exactly the capacity, the first of which may be shorter. Pieces go to bins in
order of falling length. Every bin has three residual capacities: tokens, documents and
attention cost (the sum of squared lengths); among the bins that hold the piece under all
three, the one with the smallest norm of the residuals left over is taken (``rule="norm"``),
or the one with the largest weighted product of piece and residuals (``rule="dot"``).

A piece's demand follows from its length alone, so equal lengths are interchangeable and
bins with equal residuals are too. The plan is therefore made on the histogram of lengths,
which has at most ``capacity`` rows whatever the input, over classes of equal bins; it says
for the n-th piece of a length which bin and offset it has. Pieces learn their n from
counts per partition and length, and look up their place: no piece passes the driver, and
every bin is filled as if one machine had seen all pieces.

Defined cases: a null or empty text is the end id alone; a null id is kept; repeated rows
are packed as often as they come; no documents give no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.common import column
from tallyhouse.session import settle

CAPACITY = 1024
END_ID = 2
CACHED = 600_000  # words a worker remembers
SLICE = 1_000_000  # bytes of text that are cut into words at once

# A single space between two other characters: the tokenizer always begins a word there.
# Some characters count as white space here and not there; they only make longer chunks.
_BREAK = re.compile(r"(?<=\S) (?=\S)")


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _begins_with_space(path: str) -> np.ndarray:
    """By id, whether the token begins with a space."""
    tokens = _tokenizer(path).get_vocab(with_added_tokens=True)
    begins = np.zeros(max(tokens.values()) + 1, dtype=bool)
    # Fixed value: U+0120 stands for the space in byte-level vocabularies.
    begins[[i for token, i in tokens.items() if token.startswith("\u0120")]] = True
    return begins


@cache
def _known(path: str) -> dict[bytes, bytes]:
    """Ids of words met before (in UTF-8), each as it is after a space."""
    return {}


def _ids(path: str, texts: list[str]) -> list[bytes]:
    encoded = _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)
    return [np.asarray(got.ids, dtype="<u4").tobytes() for got in encoded]


def _learn(path: str, words: list[str], known: dict[bytes, bytes]) -> None:
    """Many words as one text; its ids are cut where a token begins with a space."""
    for start in range(0, len(words), 500):
        some = words[start : start + 500]
        ids = np.frombuffer(_ids(path, [" " + " ".join(some)])[0], dtype="<u4")
        at = np.flatnonzero(_begins_with_space(path)[ids]).tolist()
        for word, begin, end in zip(some, at, [*at[1:], len(ids)], strict=True):
            known[word.encode()] = ids[begin:end].tobytes()


def sliced(texts: pd.Series) -> Iterator[pd.Series]:
    """Rows in turn, so many that their texts have ``SLICE`` bytes, or a single one."""
    ends = texts.str.len().cumsum().to_numpy()
    begin = 0
    while begin < len(texts):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        yield texts.iloc[begin:end]
        begin = end


def encode(texts: list[bytes], path: str) -> list[bytes]:
    """Ids of each text (in UTF-8) as little-endian unsigned 32-bit numbers.

    Equal to encoding the whole texts: they are cut only where a word begins anyway, and
    words met before are not encoded again. Texts with other white space beside a space
    are cut by a pattern, chunk by chunk.
    """
    known = _known(path)
    if len(known) > CACHED:
        known.clear()
    # Every word is looked up once: what is missing is filled in when the batch has learnt it.
    found, gaps, missing = [], [], set()
    for text in texts:
        first, *words = text.split(b" ")
        ids = list(map(known.get, words))
        holes = []
        if None in ids:
            holes = [(i, words[i]) for i, word_ids in enumerate(ids) if word_ids is None]
            missing.update([word for _, word in holes])
        gaps.append(holes)
        found.append((first, ids))
    decoded = [word.decode("utf-8", "replace") for word in missing]
    _learn(path, [w for w in decoded if w and w == w.strip()], known)
    out = []
    for text, (first, ids), holes in zip(texts, found, gaps, strict=True):
        for i, word in holes:
            ids[i] = known.get(word)
        begin = first.decode("utf-8", "replace")
        if None in ids or (ids and begin != begin.rstrip()) or (ids and not begin):
            begin, *others = _BREAK.split(text.decode("utf-8", "replace"))
            out.append(b"".join(_ids(path, [begin, *[" " + chunk for chunk in others]])))
        else:
            out.append(_ids(path, [begin])[0] + b"".join(ids))
    return out


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id piece start length ids_crc32``, on request ``ids``."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            encoded = (ids for some in sliced(frame["text"]) for ids in encode(list(some), tokenizer_path))
            for doc_id, ids in zip(frame["doc_id"], encoded, strict=True):
                ids += end
                total = len(ids) // 4
                begin, piece = 0, 0
                stop = (total - 1) % capacity + 1
                while begin < total:
                    part = ids[4 * begin : 4 * stop]
                    row = (doc_id, piece, begin, stop - begin, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4")) if with_ids else row)
                    begin, stop, piece = stop, stop + capacity, piece + 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    narrow = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        F.coalesce(column(docs, text_col), F.lit("")).cast("binary").alias("text"),
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return narrow.mapInPandas(cut, schema + ", ids array<long>" * with_ids)


def plan(
    lengths: dict[int, int],
    capacity: int = CAPACITY,
    most_docs: int | None = None,
    most_cost: int | None = None,
    rule: str = "norm",
) -> np.ndarray:
    """Rows ``(length, rank, bin, each, offset)``, sorted: from the piece of that length with
    that rank (from 0) on, ``each`` pieces go to a bin, beginning with ``bin`` at ``offset``."""
    limit = np.array([capacity, most_docs or capacity, most_cost or capacity**2], dtype=float)
    total = sum(lengths.values()) or 1
    mean = np.array(
        [sum(n * v for n, v in zip(lengths.values(), values, strict=True)) / total
         for values in (lengths, [1] * len(lengths), [x * x for x in lengths])]
    )
    weights = mean / limit
    bins: dict[tuple[int, int, int], list[list[int]]] = {}
    out, opened = [], 0
    for length in sorted(lengths, reverse=True):
        need = np.array([length, 1, length * length])
        if (need > limit).any():
            raise ValueError(f"a piece of {length} tokens exceeds a bin's capacity")
        left, rank = lengths[length], 0
        states = np.array(list(bins), dtype=np.int64).reshape(-1, 3)
        states = states[(states >= need).all(axis=1)]
        if rule == "norm":
            score = (((states - need) / limit) ** 2).sum(axis=1)
        else:
            score = -((states / limit) * (need / limit) * weights).sum(axis=1)
        # A piece more makes the residuals smaller, so a bin that was best stays best.
        for state in map(tuple, states[np.lexsort((states[:, 0], score))].tolist()):
            if not left:
                break
            each = int(min(np.array(state) // need))
            new = tuple((np.array(state) - each * need).tolist())
            runs = bins.pop(state)
            while runs and left:
                first, count = runs.pop()
                used = min(count, -(-left // each))
                out.append((length, rank, first, each, capacity - state[0]))
                if used < count:
                    runs.append([first + used, count - used])
                placed = min(left, used * each)
                whole, rest = divmod(placed, each)
                if whole:
                    bins.setdefault(new, []).append([first, whole])
                if rest:
                    half = tuple((np.array(state) - rest * need).tolist())
                    bins.setdefault(half, []).append([first + whole, 1])
                left, rank = left - placed, rank + placed
            if runs:
                bins.setdefault(state, []).extend(runs)
        if left:
            each = int(min(limit // need))
            out.append((length, rank, opened, each, 0))
            whole, rest = divmod(left, each)
            if whole:
                full = tuple((limit - each * need).astype(int).tolist())
                bins.setdefault(full, []).append([opened, whole])
            if rest:
                half = tuple((limit - rest * need).astype(int).tolist())
                bins.setdefault(half, []).append([opened + whole, 1])
            opened += whole + bool(rest)
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    most_docs: int | None = None,
    most_cost: int | None = None,
    rule: str = "norm",
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset`` there.

    ``most_docs`` and ``most_cost`` (sum of squared lengths) bound a sequence besides its
    tokens; with ``most_cost`` documents are cut so that a piece alone keeps to it.
    """
    spark = docs.sparkSession
    longest = min(capacity, isqrt(most_cost)) if most_cost else capacity
    cut = pieces(docs, tokenizer_path, longest, end_id, id_col, text_col, with_ids)
    cut = settle(cut.withColumn("slice", F.spark_partition_id()))

    cells = cut.groupBy("slice", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most one row per length, and there are no more lengths than the capacity.
    lengths = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = spark.sparkContext.broadcast(plan(lengths, capacity, most_docs, most_cost, rule))

    earlier = W.partitionBy("length").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.select(
        F.struct("slice", "length").alias("cell"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    inside = W.partitionBy("cell").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        cut.withColumn("cell", F.struct("slice", "length"))
        .withColumn("rank", F.row_number().over(inside))
        .join(starts, "cell")
        .withColumn("rank", F.col("rank") + F.col("before") - 1)
        .drop("cell", "before", "slice")
    )

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = steps.value
        at = table[:, 0] << 48 | table[:, 1]
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame.pop("rank").to_numpy()
            step = table[np.searchsorted(at, length << 48 | rank, side="right") - 1]
            behind = rank - step[:, 1]
            frame["sequence_id"] = step[:, 2] + behind // np.maximum(step[:, 3], 1)
            frame["offset"] = step[:, 4] + behind % np.maximum(step[:, 3], 1) * length
            yield frame

    columns = [c for c in ranked.columns if c != "rank"]
    schema = ", ".join(f"{c} {dict(ranked.dtypes)[c]}" for c in columns)
    return ranked.select(*columns, "rank").mapInPandas(
        place, schema + ", sequence_id long, offset long"
    )
