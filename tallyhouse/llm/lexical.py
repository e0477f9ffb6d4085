"""Ranked lexical search with hashed max-sketches and exact rescoring.

A document's score for an item sums, over the item's terms, a weight that falls with the
number of documents holding the term times an impact that grows with the term's occurrences
in the document and falls with its length, all in whole numbers. Both kinds of numbers need
statistics of the whole corpus, which a first pass counts.

In a second pass every task takes its documents in blocks. The impacts of all terms of a
document are folded into ``tables`` sketches of ``width`` coordinates: a coordinate keeps the
largest impact of the terms hashed to it. For an item, the smallest of a term's coordinates
is no less than the term's impact, so the weighted sum over its terms is an upper bound of
the score; one look-up gives it for all documents of a block. Documents are rescored exactly
in order of falling bounds until a bound is below the item's ``k``-th best score so far in
the task. No document is left out that could be among an item's best, in any task, so the
best of all tasks' are the best of all: they meet in two rounds, by a salt first.

Items come to the tasks in blocks of some ``ITEM_BYTES`` of text; each block is a pass over
the documents. Their terms and weights are what the driver sees.

Defined cases: a document or item that is null or has no term scores nothing; rows with one
item id (or none) are one item with the terms of all; a null doc_id comes last among equal
scores; repeated rows are ranked each; very long texts are counted in parts; no documents or
no items give no rows. Only ids and texts of the inputs are read, so other columns may have
any name.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.common import column, partitions

TABLES, WIDTH = 2, 4096
BLOCK_DOCS, BLOCK_BYTES = 512, 4_000_000
ITEM_BYTES = 16_000_000
PART = 4_000_000  # bytes of a text that are cut into terms at once
NO_ID = 2**63

# Fixed value: bytes outside terms are the ASCII ones but digits and letters; A-Z are lowered.
_FOLDED = bytes(
    ord(chr(byte).lower()) if byte < 128 and chr(byte).isalnum() else byte if byte > 127 else 32
    for byte in range(256)
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text (in UTF-8) in order, some at a time."""
    begin = 0
    while begin < len(text):
        end = begin + PART
        while end < len(text) and _FOLDED[text[end]] != 32:
            end += 1
        yield text[begin:end].translate(_FOLDED).split()
        begin = end


def counted(text: bytes) -> Counter[bytes]:
    out: Counter[bytes] = Counter()
    for some in terms(text):
        out.update(some)
    return out


def impacts(times: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + 20 * norms)


def weight(n_docs: int, holding: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * holding + 1)))


def statistics(docs: DataFrame, vocabulary: list[bytes]) -> tuple[int, int, list[int]]:
    """Documents with a term, all terms with repeats, documents holding each word."""
    known = docs.sparkSession.sparkContext.broadcast({term: i for i, term in enumerate(vocabulary)})

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = known.value
        held = np.zeros(len(numbers) + 2, dtype=np.int64)
        for frame in frames:
            for text in frame["text"]:
                size, found = 0, set()
                for some in terms(text):
                    size += len(some)
                    found |= numbers.keys() & set(some)
                held[[numbers[term] for term in found]] += 1
                held[-2] += size > 0
                held[-1] += size
        some = np.flatnonzero(held)
        yield pd.DataFrame({"term": some, "n": held[some]})

    per_task = docs.select("text").mapInPandas(count, "term long, n long")
    totals = dict(per_task.groupBy("term").agg(F.sum("n").alias("n")).collect())
    known.destroy()
    size = len(vocabulary)
    return totals.get(size, 0), totals.get(size + 1, 0), [totals.get(i, 0) for i in range(size)]


class Best:
    """The best ``k`` documents of an item so far; of equal scores the smaller id is better."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> int:
        """A document with a smaller score cannot enter."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def offer(self, score: int, order: int) -> None:
        if score <= 0:
            return
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, (score, -order))
        elif (score, -order) > self.heap[0]:
            heapq.heapreplace(self.heap, (score, -order))


class Block:
    """Some documents with their sketches."""

    def __init__(self, ids: list, texts: list[bytes], n_docs: int, n_terms: int, width: int, tables: int):
        self.orders = [NO_ID if pd.isna(doc_id) else int(doc_id) for doc_id in ids]
        self.counts = [counted(text) for text in texts]
        sizes = np.array([sum(c.values()) for c in self.counts], dtype=np.int64)
        self.norms = 50 + (50 * sizes * n_docs) // max(n_terms, 1)
        distinct = [len(c) for c in self.counts]
        at = np.repeat(np.arange(len(texts)), distinct)
        total = sum(distinct)
        times = np.fromiter((n for c in self.counts for n in c.values()), dtype=np.int64, count=total)
        hashed = np.fromiter((crc32(t) for c in self.counts for t in c), dtype=np.uint32, count=total)
        folded = impacts(times, self.norms[at]).astype(np.float32)  # below 2 ** 24: exact
        self.sketches = np.zeros((tables, width, len(texts)), dtype=np.float32)
        for sketch, spot in zip(self.sketches, coordinates(hashed, width, tables), strict=True):
            np.maximum.at(sketch, (spot, at), folded)

    def bounds(self, spots: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
        """Of each document, no less than its score; whole numbers, exact in doubles."""
        least = reduce(np.minimum, [sketch[spot] for sketch, spot in zip(self.sketches, spots, strict=True)])
        return weights @ least

    def score(self, i: int, wanted: list[tuple[bytes, int]]) -> int:
        times, norm, total = self.counts[i], 20 * int(self.norms[i]), 0
        for term, weighs in wanted:
            n = times.get(term)
            if n:
                total += weighs * ((1_000_000_000 * n) // (1000 * n + norm))
        return total

    def rank(self, wanted: list[tuple[bytes, int]], spots: list, weights: np.ndarray, best: Best) -> None:
        bounds = self.bounds(spots, weights)
        some = np.flatnonzero(bounds >= best.least())
        for i in some[np.argsort(-bounds[some], kind="stable")].tolist():
            if bounds[i] < best.least():
                break
            best.offer(self.score(i, wanted), self.orders[i])


def coordinates(hashed: np.ndarray, width: int, tables: int) -> list[np.ndarray]:
    """A coordinate per table: of odd multiples of the hash, the leading bits."""
    # Odd numbers near 2 ** 32 over the golden ratio and over its powers.
    odd = np.array([0x9E3779B1, 0x61C88647, 0x3C6EF373], dtype=np.uint32)[:tables]
    return [((hashed * number) >> np.uint32(16)) % np.uint32(width) for number in odd]


def _blocks(frame: pd.DataFrame) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, begin = list(frame["doc_id"]), list(frame["text"]), 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and end - begin < BLOCK_DOCS and (end == begin or size < BLOCK_BYTES):
            size += len(texts[end])
            end += 1
        yield ids[begin:end], texts[begin:end]
        begin = end


def _best_of_tasks(docs: DataFrame, wanted: list[dict[bytes, int]], n_docs: int, n_terms: int,
                   k: int, width: int, tables: int) -> DataFrame:
    """``item doc_id score`` of each item's (by its number) ``k`` best per task."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def ranked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = []
        for weighed in shared.value:
            hashed = np.fromiter(map(crc32, weighed), dtype=np.uint32, count=len(weighed))
            weights = np.fromiter(weighed.values(), dtype=np.float64, count=len(weighed))
            items.append((list(weighed.items()), coordinates(hashed, width, tables), weights, Best(k)))
        for frame in frames:
            for ids, texts in _blocks(frame):
                block = Block(ids, texts, n_docs, n_terms, width, tables)
                for item in items:
                    block.rank(*item)
        for number, (*_, best) in enumerate(items):
            if best.heap:
                scores, orders = zip(*best.heap, strict=True)
                ids = [None if order == -NO_ID else -order for order in orders]
                found = pd.DataFrame({"item": number, "doc_id": pd.array(ids, "Int64"), "score": scores})
                yield found

    return docs.mapInPandas(ranked, "item long, doc_id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    tables: int = TABLES,
) -> DataFrame:
    """``item_id rank doc_id score`` of each item's ``k`` best documents, ranks from 1."""
    spark = docs.sparkSession
    narrow = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        F.coalesce(column(docs, text_col), F.lit("")).cast("binary").alias("text"),
    )
    asked = items.select(
        column(items, item_col).alias("item_id"), column(items, item_text_col).cast("binary").alias("text")
    ).where("text is not null")
    kind = asked.schema["item_id"].dataType.simpleString()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // ITEM_BYTES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)))
    found = []
    for number in range(n_blocks):
        sets: dict = {}
        for row in asked.where(F.col("block") == number).select("item_id", "text").collect():
            sets.setdefault(row["item_id"], set()).update(t for some in terms(bytes(row["text"])) for t in some)
        ids = list(sets)
        vocabulary = sorted(set().union(*sets.values()))
        n_docs, n_terms, holding = statistics(narrow, vocabulary)
        weights = {t: weight(n_docs, n) for t, n in zip(vocabulary, holding, strict=True) if n}
        wanted = [{t: weights[t] for t in sorted(sets[i]) if t in weights} for i in ids]
        best = _best_of_tasks(narrow, wanted, n_docs, n_terms, k, width, tables)
        # Numbers of the block's items, as many as were asked.
        names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {kind}")
        found.append(_first(best, k).join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionAll, found)


def _first(best: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item, cut down by a salt before an item's rows meet."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salt = F.pmod(F.hash("doc_id", "score"), F.lit(partitions(best.sparkSession)))
    salted = W.partitionBy("item", "salt").orderBy(*order)
    some = best.withColumn("salt", salt).withColumn("rank", F.row_number().over(salted))
    some = some.where(F.col("rank") <= k).drop("salt", "rank")
    whole = W.partitionBy("item").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
