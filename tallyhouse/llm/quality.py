"""Quality by logistic regression over hashed word n-grams, trained by FTRL-proximal updates.

A text's words lie between white space. Its features are hashed n-grams: words and pairs of
words as they stand, and single, double and triple shapes of words (which kinds of
characters a word has, how it ends, whether it repeats the word before). A feature's value
is one plus the logarithm of its count; a text's vector has length one. Follow-the-
regularised-leader updates go over the training rows in the order of a hash of their ids,
``EPOCHS`` times; rows of the rarer label weigh more, by the square root of the ratio.

The model is fitted on at most ``SAMPLE`` labelled documents, drawn by hash, in one task of
that bounded size; its weights (2**``BITS`` numbers) go to all tasks. Every text is scored
whole, where it is read, as a sparse dot product.

Defined cases: null, empty and blank texts have no feature and get the score of the bias;
without labelled rows all scores are 0.5; repeated labels of a document are averaged, ties
count as 1; a null id teaches nothing and is not held out; repeated rows are scored each; no
documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import column, named
from tallyhouse.llm.minhash import mixed, spans_of_words, word_hashes
from tallyhouse.llm.toxicity import clean_labels
from tallyhouse.session import settle

SAMPLE = 20_000
BITS = 18
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.1
THRESHOLD = 0.5
SLICE = 2_000_000  # bytes of text that are hashed at once

_DRAW = np.random.default_rng(8)
_LETTERS = _DRAW.integers(1, 2**63, 256, dtype=np.uint64)  # case counts here
_TIMES = _DRAW.integers(2**62, 2**63, 8, dtype=np.uint64) | np.uint64(1)
_KIND = np.full(256, 4, dtype=np.uint8)  # 0 lower, 1 upper, 2 digit, 3 beyond ASCII, 4 other
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[128:] = 3


def shapes(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray, firsts: np.ndarray
) -> np.ndarray:
    """A number per word: its kinds of characters, first kind, last character, repetition.

    ``firsts``: which words begin a text and so repeat none.
    """
    if not len(begin):
        return np.zeros(0, dtype=np.uint64)
    bit = np.left_shift(1, _KIND[data], dtype=np.uint64)
    kinds = np.bitwise_or.reduceat(bit, np.stack([begin, np.minimum(end, len(bit) - 1)], axis=1).ravel())[::2]
    # Words end where white space begins, except the last of all.
    if end[-1] == len(data):
        kinds[-1] = np.bitwise_or.reduce(bit[begin[-1] :])
    last = np.where(_KIND[data[end - 1]] == 4, data[end - 1], _KIND[data[end - 1]]).astype(np.uint64)
    again = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    again[firsts] = False
    again = again.astype(np.uint64)
    first = _KIND[data[begin]].astype(np.uint64)
    return mixed(kinds | first << np.uint64(8) | last << np.uint64(16) | again << np.uint64(32))


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> Iterator[tuple]:
    """``(buckets, values)`` of each text; texts lie one after another in ``data``."""
    begin, end, counts = spans_of_words(data, offsets)
    words = word_hashes(data, begin, end, _LETTERS)
    stops = np.cumsum(counts)
    shape = shapes(data, begin, end, words, (stops - counts)[counts > 0])
    pairs = words[:-1] * _TIMES[1] + words[1:] * _TIMES[2]
    two = shape[:-1] * _TIMES[3] + shape[1:] * _TIMES[4]
    three = two[:-1] + shape[2:] * _TIMES[5]
    grams = [words, mixed(pairs), mixed(shape * _TIMES[6]), mixed(two), mixed(three * _TIMES[7])]
    grams = [(g >> np.uint64(64 - bits)).astype(np.int32) for g in grams]
    sizes = [1, 2, 1, 2, 3]
    for stop, count in zip(stops, counts, strict=True):
        parts = [g[stop - count : stop - n + 1] for g, n in zip(grams, sizes, strict=True) if count >= n]
        if not parts:
            yield np.zeros(0, dtype=np.int32), np.zeros(0)
            continue
        buckets, found = np.unique(np.concatenate(parts), return_counts=True)
        values = 1 + np.log(found)
        yield buckets, values / np.linalg.norm(values)


def of_batch(batch: pa.RecordBatch, at: int, bits: int = BITS) -> Iterator[tuple]:
    """The features of each row; column ``at`` holds the texts as binary."""
    texts = batch.column(at).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        yield from features(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], bits)
        row = stop


class Leader:
    """Follow-the-regularised-leader with per-coordinate rates."""

    def __init__(self, bits: int = BITS):
        # The last coordinate is the bias; it is not regularised away.
        self.z, self.n = np.zeros(2**bits + 1), np.zeros(2**bits + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, buckets: np.ndarray, values: np.ndarray, label: float, weight: float) -> None:
        at, x = np.append(buckets, len(self.z) - 1), np.append(values, 1.0)
        w = self.weights(at)
        wrong = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label
        g = weight * wrong * x
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] += g * g


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    sample: int = SAMPLE,
    bits: int = BITS,
) -> np.ndarray:
    """Weights of all buckets and, last, the bias, learnt from the rows of ``docs``."""
    known = docs.select(
        column(docs, id_col).cast("long").alias("id"), column(docs, text_col).cast("binary").alias("text")
    )
    marks = clean_labels(labels, label_id_col, label_col)
    marks = marks.join(known.select("id").distinct(), "id", "left_semi")
    drawn = settle(marks.orderBy(F.xxhash64("id"), "id").limit(sample))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(of_batch(batch, 2, bits))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([b.tobytes() for b, _ in found], pa.binary()),
                    pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary()),
                ],
                names=["id", "label", "buckets", "x"],
            )

    # At most SAMPLE ids.
    rows = known.join(F.broadcast(drawn), "id").select("id", "label", "text")
    rows = rows.mapInArrow(featured, "id long, label int, buckets binary, x binary")

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "buckets"])
        order = mixed(frame["id"].to_numpy().astype(np.uint64)).argsort(kind="stable")
        frame = frame.iloc[order]
        ones = frame["label"].mean()
        weight = {1: 1.0, 0: 1.0}
        if 0 < ones < 1:
            weight[int(ones < 0.5)] = float((max(ones, 1 - ones) / min(ones, 1 - ones)) ** 0.5)
        rows = [
            (np.frombuffer(b, np.int32), np.frombuffer(x, np.float32), y)
            for b, x, y in zip(frame["buckets"], frame["x"], frame["label"], strict=True)
        ]
        leader = Leader(bits)
        for _ in range(EPOCHS):
            for buckets, values, label in rows:
                leader.learn(buckets, values, label, weight[int(label)])
        return pd.DataFrame({"weights": [leader.weights().tobytes()]})

    # One group of at most SAMPLE documents.
    learnt = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(train, "weights binary").collect()
    return np.frombuffer(learnt[0]["weights"]) if learnt else np.zeros(2**bits + 1)


def score(
    docs: DataFrame,
    weights: np.ndarray,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    extra: list[str] | None = None,
) -> DataFrame:
    """Columns ``extra`` of each row (all but the text by default), ``score``, ``predicted``."""
    bits = int(np.log2(len(weights) - 1))
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            at = batch.num_columns - 1
            sums = [float(w[b] @ x + w[-1]) for b, x in of_batch(batch, at, bits)]
            scores = 1 / (1 + np.exp(-np.clip(np.array(sums), -35, 35)))
            columns = [batch.column(i) for i in range(at)]
            columns += [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:at], "score", "predicted"])

    extra = [c for c in docs.columns if c != text_col] if extra is None else extra
    texted = docs.select(
        *[column(docs, name).alias(f"c{i}") for i, name in enumerate(extra)],
        column(docs, text_col).cast("binary").alias("text"),
    )
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texted.schema[:-1])
    out = texted.mapInArrow(scored, f"{types}, score double, predicted int")
    return named(out, docs, extra)
