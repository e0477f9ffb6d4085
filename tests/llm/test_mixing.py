import math
import re

import pytest

from tallyhouse.llm import mixing
from tests.llm.conftest import CLASHING


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected_targets(sizes, weights=(1, 2, 3), most=3):
    """Reshare what is over the stop, source by source, until none is over."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stopped = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        open_ = sum(weight[s] for s in sizes if s not in stopped)
        target = {s: most * sizes[s] if s in stopped else weight[s] * rest / open_ for s in sizes}
        over = {s for s in sizes if s not in stopped and target[s] > most * sizes[s]}
        if not over:
            return target
        stopped |= over


def check(rows, source_of):
    sizes = {}
    for r in rows:
        sizes[source_of(r)] = sizes.get(source_of(r), 0) + r["size"]
    targets = expected_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        s = source_of(r)
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(targets[s])
        rate = targets[s] / sizes[s] if sizes[s] else 0
        assert r["copies"] in (math.floor(rate), math.ceil(rate)) and r["copies"] <= 3
        assert r["taken"] == r["copies"] * r["size"]
        taken[s] += r["taken"]
    return sizes, targets, taken


def test_odd_rows(odd):
    docs = odd.drop("size", "target", "copies")
    rows = mixing.mix(docs).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["size"] == words(r["text"])
    check(rows, lambda r: r["source"])


def test_clashing_names_and_reruns(odd):
    first = mixing.mix(odd)
    assert first.columns == [*odd.columns, "size_", "source_size", "target_", "copies_", "taken"]
    assert set(CLASHING) <= set(first.columns)
    columns = ["doc_id", "size_", "copies_"]
    again = mixing.mix(odd.repartition(7)).select(*columns)
    assert sorted(map(str, first.select(*columns).collect())) == sorted(map(str, again.collect()))


def test_taken_words_come_near_the_target(spark):
    docs = spark.createDataFrame(
        [(i, "w " * (1 + i * i % 300), "hot" if i % 3 else f"s{i % 12}") for i in range(4000)],
        "doc_id long, text string, source string",
    )
    rows = mixing.mix(docs).collect()
    sizes, targets, taken = check(rows, lambda r: r["source"])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.01 * targets[s] + 300


def test_sample_repeats_rows(odd):
    mixed = mixing.mix(odd).selectExpr("doc_id", "copies_ as n").collect()
    sampled = mixing.sample(odd)
    assert sampled.columns == odd.columns
    counts = {}
    for r in sampled.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    wanted = {}
    for r in mixed:
        wanted[r["doc_id"]] = wanted.get(r["doc_id"], 0) + r["n"]
    assert counts == {k: n for k, n in wanted.items() if n}


def test_empty(nothing):
    assert mixing.mix(nothing).count() == 0


def test_no_words(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert [(r["target"], r["copies"]) for r in mixing.mix(docs).collect()] == [(0.0, 0), (0.0, 0)]
