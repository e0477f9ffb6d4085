import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import quality
from tests.llm.conftest import ROWS


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])


def test_features_depend_on_the_text_alone(monkeypatch):
    texts = [b"The the %%% AB12 ab!!", b"", None, b" \t ", b"one", b"xx xx xx", b"a" * 5000, b"one"]
    together = list(quality.of_batch(batch(texts), 0))
    alone = [next(quality.of_batch(batch([t]), 0)) for t in texts]
    sliced = list(quality.of_batch(batch([b"before", *texts, b"after"]).slice(1, len(texts)), 0))
    monkeypatch.setattr(quality, "SLICE", 3)
    tiny = list(quality.of_batch(batch(texts), 0))
    for other in (alone, sliced, tiny):
        for (a, x), (b, y) in zip(together, other, strict=True):
            assert a.tolist() == b.tolist() and x == pytest.approx(y)
    assert [len(a) for a, _ in together[1:4]] == [0, 0, 0]


def test_counts_are_those_of_all_n_grams():
    # Five words: 5 words, 4 pairs, 5 shapes, 4 pairs and 3 triples of shapes.
    ((buckets, values),) = quality.of_batch(batch([b"aa bb cc dd ee"]), 0)
    raw = np.exp(values / values.min() - 1)
    assert round(raw.sum()) == 5 + 4 + 5 + 4 + 3
    assert np.linalg.norm(values) == pytest.approx(1)


def plain_ftrl(rows, dims, epochs):
    """The published update, one coordinate at a time."""
    z, n = [0.0] * (dims + 1), [0.0] * (dims + 1)

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * quality.L1) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(epochs):
        for buckets, values, label in rows:
            pairs = [*zip(buckets.tolist(), values.tolist(), strict=True), (dims, 1.0)]
            w = {i: weight(i) for i, _ in pairs}
            p = 1 / (1 + np.exp(-sum(w[i] * x for i, x in pairs)))
            for i, x in pairs:
                g = (p - label) * x
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / quality.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return [weight(i) for i in range(dims + 1)]


def test_updates_equal_the_published_ones():
    draw = np.random.default_rng(1)
    rows = []
    for _ in range(60):
        buckets = np.sort(draw.choice(16, draw.integers(0, 6), replace=False))
        rows.append((buckets, draw.uniform(0, 1, len(buckets)), int(draw.integers(0, 2))))
    leader = quality.Leader(4)
    for _ in range(2):
        for b, x, y in rows:
            leader.learn(b, x, y, 1.0)
    assert leader.weights() == pytest.approx(plain_ftrl(rows, 16, 2))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod("doc_id", F.lit(3)) == 1
    weights = quality.fit(docs.where(~held), labels)
    got = quality.score(docs, weights).join(labels, "doc_id").where(held)
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] >= 0.97


def test_scores_are_sparse_dot_products(odd):
    weights = np.random.default_rng(2).standard_normal(2**10 + 1)
    got = {(r["doc_id"], r["text"]): r["score"] for r in quality.score(odd, weights, extra=["doc_id", "text"]).collect()}
    for doc_id, text, *_ in ROWS:
        ((buckets, values),) = quality.of_batch(batch([(text or "").encode()]), 0, 10)
        want = 1 / (1 + np.exp(-(weights[buckets] @ values + weights[-1])))
        assert got[doc_id, text] == pytest.approx(want)


def test_odd_rows_and_labels(spark, odd, nothing):
    marks = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 0), (4, None), (None, 1), (6, 1), (99, 1), (8, 1), (8, 0)], "doc_id long, quality int"
    )
    weights = quality.fit(odd, marks)
    scored = quality.score(odd, weights, extra=odd.columns)
    assert scored.columns == [*odd.columns, "score_", "predicted_"]
    rows = scored.collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score_"] <= 1 for r in rows)
    untaught = quality.score(odd, quality.fit(odd, marks.limit(0)), extra=["doc_id"]).collect()
    assert {(r["score"], r["predicted"]) for r in untaught} == {(0.5, 1)}
    assert quality.score(nothing, weights).count() == 0
