import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import toxicity
from tests.llm.conftest import ROWS

BAD = [f"bad{i}" for i in range(8)]


def corpus(n=600, seed=1):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 6 == 0)
        words = [f"w{int(draw.paretovariate(0.6)) % 3000}" for _ in range(draw.randint(20, 120))]
        if toxic:
            words += draw.choices(BAD, k=draw.randint(2, 6))
        draw.shuffle(words)
        docs.append((i, " ".join(words), toxic))
        if i % 2 == 0:
            labels.append((i, toxic))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, truth int").repartition(3),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_unlabelled_documents_are_told_apart(spark):
    docs, labels = corpus()
    frame, marks = frames(spark, docs, labels)
    rows = toxicity.score(frame, frame, marks, extra=["doc_id", "truth"]).collect()
    assert len(rows) == len(docs)
    new = [r for r in rows if r["doc_id"] % 2]
    right = np.mean([r["predicted"] == r["truth"] for r in new])
    assert right >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(e["label"] == 1 for r in new if r["score"] > 0.9 for e in r["evidence"][:1])


def test_nothing_is_learnt_from_other_rows(spark):
    docs, labels = corpus(400)
    frame, marks = frames(spark, docs, labels)
    told = toxicity.score(frame, frame.where("doc_id < 200"), marks).collect()
    wrong = marks.withColumn("toxic", F.when(F.col("doc_id") < 200, F.col("toxic")).otherwise(1 - F.col("toxic")))
    again = toxicity.score(frame, frame.where("doc_id < 200"), wrong).collect()
    assert sorted(map(str, told)) == sorted(map(str, again))


def test_index_finds_the_exact_nearest():
    draw = np.random.default_rng(2)
    size, vectors = 60, []
    for i in range(500):
        terms = np.sort(draw.choice(size, 0 if i % 50 == 0 else draw.integers(1, 9), replace=False))
        values = draw.uniform(0.1, 1, len(terms))
        vectors.append((terms, values / (np.linalg.norm(values) or 1)))
    labels = draw.integers(0, 2, 500)
    index = toxicity.Index(vectors, size, np.arange(500), labels, np.ones(500))
    dense = np.zeros((500, size))
    for i, (terms, values) in enumerate(vectors):
        dense[i, terms] = values
    for i in range(1, 500, 7):
        if not len(vectors[i][0]):
            continue
        places, cosines = index.nearest(*vectors[i], 10)
        want = np.sort(dense @ dense[i])[::-1][:10]
        assert cosines == pytest.approx(want[want > 0])
        assert (dense[index.ids[places]] @ dense[i]) == pytest.approx(cosines)
        without, _ = index.nearest(*vectors[i], 10, i)
        assert i not in index.ids[without] and len(without) <= 10


def test_monotone_fit():
    x, y = np.array([3.0, 1, 2, 2, 4]), np.array([1.0, 0, 1, 0, 0])
    at, rate = toxicity.monotone(x, y, np.ones(5))
    assert (np.diff(rate) >= 0).all() and (np.diff(at) >= 0).all()
    assert np.interp(0, at, rate) < np.interp(5, at, rate)


def test_odd_rows_and_labels(spark, odd, nothing):
    marks = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (6, 0), (99, 1), (8, 1), (8, 1)],
        "doc_id long, toxic int",
    )
    scored = toxicity.score(odd, odd, marks, extra=odd.columns)
    assert scored.columns == [*odd.columns, "score_", "predicted_", "evidence"]
    rows = scored.collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score_"] <= 1 for r in rows)
    none = toxicity.score(odd, odd, marks.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
    assert toxicity.score(nothing, nothing, marks).count() == 0
    clean = toxicity.clean_labels(marks, "doc_id", "toxic").collect()
    assert sorted(map(tuple, clean)) == [(1, 1), (2, 0), (6, 0), (8, 1), (99, 1)]


def test_copies_teach_once(spark):
    docs, labels = corpus(300)
    text = docs[0][1] + " " + " ".join(f"harmless{i}" for i in range(40))
    docs += [(1000 + i, text, 1) for i in range(100)] + [(2000, " ".join(f"harmless{i}" for i in range(40)), 0)]
    labels += [(1000 + i, 1) for i in range(100)]
    frame, marks = frames(spark, docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.score(frame, frame, marks).collect()}
    assert rows[2000]["predicted"] == 0 and rows[1050]["predicted"] == 1


def test_rare_kinds_of_toxic_documents_are_found(spark):
    """A word in five of 545 toxic examples, less than a hundredth, and in no clean one."""
    docs, labels = [], []
    for i in range(3245):
        toxic = int(i < 545)
        word = ("rare" if i < 5 else BAD[i % 8]) if toxic else "fine"
        docs.append((i, f"{word} " + " ".join(f"u{i}x{j}" for j in range(6)), toxic))
        labels.append((i, toxic))
    docs += [(9000 + i, "rare " + " ".join(f"v{i}x{j}" for j in range(6)), 1) for i in range(3)]
    frame, marks = frames(spark, docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.score(frame, frame, marks).collect()}
    for i in range(9000, 9003):
        assert rows[i]["predicted"] == 1 and {e["id"] for e in rows[i]["evidence"]} <= set(range(5))
        assert rows[i]["evidence"]
