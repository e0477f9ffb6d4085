"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are labelled documents, at most ``EXAMPLES`` of each label, drawn by a hash of the
id; near copies among them count once, so that a passage copied often proves nothing. The
vocabulary is the words that go with a label beyond chance (log-likelihood ratio over
examples, whatever share of them holds the word) and several times as often as with the other;
document frequencies come from all documents. Vectors are ``(1 + ln tf) * idf`` of length one.

The examples lie in an inverted index: postings per word, cut into blocks of neighbouring
examples, with the largest weight of each block. A document visits blocks in order of their
bound until the bound is below its k-th best cosine, so the k nearest are exact. They vote
weighted by squared cosine and by how thinly their label was drawn; votes become
probabilities by a monotone fit to the votes that the examples get from one another.

The index is bounded by the sample and goes to all tasks. Documents are read twice, for the
frequencies and for the scores, and never shuffled.

Defined cases: null and empty texts, and texts without a vocabulary word, get the rate of
such examples; without labelled rows all scores are 0, with one label only that label's
smoothed rate; repeated labels of a document are averaged, ties count as toxic; a null id
is no example and is not held out; repeated rows are scored each; no documents give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import minhash
from tallyhouse.llm.common import column, named
from tallyhouse.session import settle

EXAMPLES = 8000  # of each label
VOCABULARY = 4096
LEAST_RATIO = 15.0  # log-likelihood ratio of a word and the label; chance gives one word in 9000 as much
LEAST_LIFT = 4.0  # times that a word is more frequent with one label than with the other
SAME_BANDS = 8  # of 32: so many have two sets with a common share of about 0.7
NEAREST = 25
DOUBT = 3  # votes at the prior rate that join the neighbours', so that few prove less
BLOCK = 32
VISITED = 8  # blocks that are looked at first
THRESHOLD = 0.3
EVIDENCE = 3
_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Index:
    """Examples' unit vectors as block-max postings."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], size: int, ids, labels, weights):
        # Neighbours share their heaviest word, which makes the bounds of blocks tight.
        lead = np.array([t[w.argmax()] if len(t) else size for t, w in vectors], dtype=np.int64)
        order = np.lexsort((np.arange(len(vectors)), lead))
        order = order[lead[order] < size]
        self.ids, self.labels, self.weights = (np.asarray(x)[order] for x in (ids, labels, weights))
        self.prior = float((self.weights * self.labels).sum() / self.weights.sum()) if len(order) else 0.0
        self.blocks = max(1, -(-len(order) // BLOCK))
        terms = np.concatenate([vectors[i][0] for i in order]) if len(order) else np.zeros(0, int)
        values = np.concatenate([vectors[i][1] for i in order]) if len(order) else np.zeros(0)
        owners = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        by_term = np.lexsort((owners, terms))
        self.owners, self.values = owners[by_term], values[by_term]
        cell = terms[by_term] * self.blocks + self.owners // BLOCK
        self.starts = np.searchsorted(cell, np.arange(size * self.blocks + 1))
        self.tops = np.zeros(size * self.blocks)
        np.maximum.at(self.tops, cell, self.values)
        self.tops = self.tops.reshape(size, self.blocks)

    def _cosines(self, terms: np.ndarray, values: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Cosines of all examples in the blocks, a row per block."""
        cells = terms[:, None] * self.blocks + blocks
        begin, size = self.starts[cells].ravel(), (self.starts[cells + 1] - self.starts[cells]).ravel()
        # The postings of all cells, one after another.
        at = np.arange(size.sum()) + np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        row = np.tile(np.arange(len(blocks)), len(terms))
        place = np.repeat(row, size) * BLOCK + self.owners[at] % BLOCK
        weight = np.repeat(np.repeat(values, len(blocks)), size) * self.values[at]
        return np.bincount(place, weight, len(blocks) * BLOCK).reshape(-1, BLOCK)

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int, but: int | None = None):
        """Places and cosines of the ``k`` nearest examples, without those that share no word
        and those with the id ``but``; ties go to the smaller place."""
        bounds = values @ self.tops[terms]
        visit = np.argsort(-bounds, kind="stable")
        visit = visit[bounds[visit] > 0]
        places, cosines = np.zeros(0, dtype=np.int64), np.zeros(0)
        step = VISITED
        while len(visit):
            if len(cosines) >= k:
                visit = visit[bounds[visit] >= cosines[-1] - 1e-12]
            now, visit = visit[:step], visit[step:]
            if not len(now):
                break
            got = self._cosines(terms, values, now)
            row, column_ = np.nonzero(got > 0)
            found = now[row] * BLOCK + column_
            got = got[row, column_]
            if but is not None:
                others = self.ids[found] != but
                found, got = found[others], got[others]
            places, cosines = np.concatenate([places, found]), np.concatenate([cosines, got])
            best = np.lexsort((places, -cosines))[:k]
            places, cosines = places[best], cosines[best]
            step *= 4
        return places, cosines

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        weight = cosines**2 * self.weights[places]
        doubt = DOUBT * self.weights.mean()
        return float(((weight * self.labels[places]).sum() + doubt * self.prior) / (weight.sum() + doubt))


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of ``y`` on ``x``, as points to interpolate between."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, weight * y, first x, last x
    for a, b, c in zip(x[order], y[order], w[order], strict=True):
        pools.append([c, c * b, a, a])
        while len(pools) > 1 and (
            pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0] or pools[-2][3] == pools[-1][2]
        ):
            weight, total, _, last = pools.pop()
            pools[-1][0] += weight
            pools[-1][1] += total
            pools[-1][3] = last
    at = np.array([x for p in pools for x in (p[2], p[3])])
    # A little doubt keeps scores off 0 and 1.
    rates = np.array([(p[1] + 0.01) / (p[0] + 0.02 if p[0] else 1) for p in pools])
    return at, np.repeat(np.clip(rates, 0, 1), 2)


def draw(labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, float]]:
    """At most ``most`` labelled ids of each label by hash, and how many of each one stands for.

    ``labels``: ``id label`` with one row per id. Ids alone are drawn, so this is one sort of
    narrow rows per label with a limit.
    """
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [
        labels.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(most)
        for label in (0, 1)
    ]
    return parts[0].union(parts[1]), {k: max(1.0, n / most) for k, n in counts.items()}


def clean_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``id label`` with one 0 or 1 per id; rows with a null are left out."""
    value = column(labels, label_col)
    rows = labels.select(column(labels, id_col).cast("long").alias("id"), value.cast("double").alias("label"))
    mean = rows.where("id is not null and label is not null").groupBy("id").agg(F.avg("label").alias("label"))
    return mean.select("id", F.when(F.col("label") >= 0.5, 1).otherwise(0).alias("label"))


def _without_copies(examples: DataFrame) -> DataFrame:
    """One example of each group of near copies, by shared MinHash bands."""
    signed = examples.select("id", F.col("text").cast("binary")).mapInArrow(minhash._signed, minhash._SIGNED)
    keys = settle(signed.select("id", F.explode("keys").alias("key")))
    first = keys.groupBy("key").agg(F.min("id").alias("first"))
    later = keys.join(first, "key").where("first < id").groupBy("id").count()
    return examples.join(later.where(F.col("count") >= SAME_BANDS), "id", "left_anti")


def choose_words(examples: DataFrame) -> list[str]:
    """Words that go with a label beyond chance, strongest first. ``examples``: ``label text``."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [list(set(words(text))) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "word": [w for some in sets for w in some],
                    "label": np.repeat(frame["label"].to_numpy(), [len(s) for s in sets]),
                }
            )

    sizes = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return []
    found = examples.select("label", "text").mapInPandas(split, "word string, label int")
    counts = found.groupBy("word").agg(
        F.sum(1 - F.col("label")).cast("double").alias("x"), F.sum("label").cast("double").alias("y")
    )

    def part(k: Column, n: int) -> Column:
        rate = (F.col("x") + F.col("y")) / (n0 + n1)
        inside = F.when(k > 0, k * F.log(k / (n * rate))).otherwise(0.0)
        out = n - k
        return inside + F.when(out > 0, out * F.log(out / (n * (1 - rate)))).otherwise(0.0)

    ratio = 2 * (part(F.col("x"), n0) + part(F.col("y"), n1))
    enough = F.col("x") + F.col("y") >= 2
    # Half a document more on either side keeps the lift of words that one label lacks finite.
    lift = ((F.col("y") + 0.5) / (n1 + 1)) / ((F.col("x") + 0.5) / (n0 + 1))
    apart = (lift >= LEAST_LIFT) | (lift <= 1 / LEAST_LIFT)
    strong = counts.where(enough & apart).withColumn("ratio", ratio)
    strong = strong.where(F.col("ratio") >= LEAST_RATIO)
    # At most VOCABULARY words come to the driver.
    return [r["word"] for r in strong.orderBy(F.desc("ratio"), "word").limit(VOCABULARY).collect()]


def score(
    docs: DataFrame,
    training: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "toxic",
    examples: int = EXAMPLES,
    threshold: float = THRESHOLD,
    extra: list[str] | None = None,
) -> DataFrame:
    """Per row of ``docs``: columns ``extra`` (the id by default), ``score``, ``predicted``
    and ``evidence``, the nearest examples.

    ``training`` are the documents that may be learnt from.
    """
    spark = docs.sparkSession
    marked = clean_labels(labels, label_id_col, label_col)
    known = training.select(column(training, id_col).cast("long").alias("id"), column(training, text_col).alias("text"))
    marked = settle(marked.join(known.select("id").distinct(), "id", "left_semi"))
    drawn, stands_for = draw(marked, examples)
    # At most two times EXAMPLES ids.
    drawn = F.broadcast(settle(drawn))
    texts = known.join(drawn, "id").select("id", "label", F.coalesce("text", F.lit("")).alias("text"))
    texts = settle(_without_copies(settle(texts)))
    vocabulary = choose_words(texts)
    of_word = spark.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})

    def found(text: str) -> tuple[np.ndarray, np.ndarray]:
        number = of_word.value
        got = Counter([number[w] for w in words(text) if w in number])
        terms = np.array(sorted(got), dtype=np.int64)
        return terms, np.array([got[t] for t in terms], dtype=np.int64)

    def held_by(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Documents per vocabulary word of one task, and at -1 all of them."""
        counts = np.zeros(len(of_word.value) + 1, dtype=np.int64)
        for frame in frames:
            for text in frame["text"]:
                counts[found(text)[0]] += 1
            counts[-1] += len(frame)
        terms = np.flatnonzero(counts)
        yield pd.DataFrame({"t": np.where(terms == len(counts) - 1, -1, terms), "n": counts[terms]})

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [found(text) for text in frame.pop("text")]
            yield frame.assign(terms=[t for t, _ in got], counts=[c for _, c in got])

    extra = [id_col] if extra is None else extra
    kept = [column(docs, name).alias(f"c{i}") for i, name in enumerate(extra)]
    texted = docs.select(*kept, F.coalesce(column(docs, text_col), F.lit("")).alias("text"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texted.schema[:-1])
    # At most one row per vocabulary word, and one for all documents.
    counts = texted.select("text").mapInPandas(held_by, "t int, n long").groupBy("t").agg(F.sum("n").alias("n"))
    frequency = {r["t"]: r["n"] for r in counts.collect()}
    total = frequency.get(-1, 0)
    idf = np.array([np.log((1 + total) / (1 + frequency.get(t, 0))) + 1 for t in range(len(vocabulary))])

    def vector(terms, counts) -> tuple[np.ndarray, np.ndarray]:
        terms = np.asarray(terms, dtype=np.int64)
        values = (1 + np.log(np.asarray(counts, dtype=float))) * idf[terms]
        return terms, values / (np.linalg.norm(values) or 1)

    # The bounded sample: vocabulary words of at most two times EXAMPLES documents.
    held = texts.mapInPandas(counted, "id long, label int, terms array<int>, counts array<int>").collect()
    held.sort(key=lambda r: r["id"])
    vectors = [vector(r["terms"], r["counts"]) for r in held]
    marks = np.array([r["label"] for r in held], dtype=float)
    weights = np.array([stands_for[r["label"]] for r in held])
    index = Index(vectors, len(vocabulary), [r["id"] for r in held], marks, weights)

    def rate(at: np.ndarray) -> float:
        prior = (weights * marks).sum() / weights.sum() if len(held) else 0.0
        return float(((weights * marks)[at].sum() + prior) / (weights[at].sum() + 1))

    known_words = spark.sparkContext.broadcast(index)

    def voted_by_others(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What the other examples say about each example that has vocabulary words."""
        index = known_words.value
        for frame in frames:
            votes = []
            for i, text, label in zip(frame["id"], frame["text"], frame["label"], strict=True):
                terms, counts = found(text)
                if len(terms):
                    places, cosines = index.nearest(*vector(terms, counts), NEAREST, i)
                    if len(places):
                        votes.append((index.vote(places, cosines), label))
            yield pd.DataFrame(votes, columns=["vote", "label"])

    votes = texts.mapInPandas(voted_by_others, "vote double, label int").collect()
    curve = None
    if votes:
        x, y = (np.array([r[c] for r in votes], dtype=float) for c in ("vote", "label"))
        curve = monotone(x, y, np.where(y == 1, stands_for.get(1, 1), stands_for.get(0, 1)))
    none = rate(np.array([not len(terms) for terms, _ in vectors])) if len(held) else 0.0
    model = spark.sparkContext.broadcast((index, curve, none))

    def judged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, curve, none = model.value
        for frame in frames:
            scores, evidence = [], []
            for text in frame["text"]:
                terms, counts = found(text)
                places, cosines = np.zeros(0, dtype=int), np.zeros(0)
                if len(terms) and curve is not None:
                    places, cosines = index.nearest(*vector(terms, counts), NEAREST)
                if len(places):
                    scores.append(float(np.interp(index.vote(places, cosines), *curve)))
                else:
                    scores.append(none)
                evidence.append(
                    [
                        {"id": int(index.ids[p]), "cosine": float(c), "label": int(index.labels[p])}
                        for p, c in zip(places[:EVIDENCE], cosines[:EVIDENCE], strict=True)
                    ]
                )
            yield frame.drop(columns="text").assign(score=scores, predicted=[int(s >= threshold) for s in scores], evidence=evidence)

    shape = "array<struct<id: long, cosine: double, label: int>>"
    out = texted.mapInPandas(judged, f"{types}, score double, predicted int, evidence {shape}")
    return named(out, docs, extra)
