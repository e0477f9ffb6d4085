import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import buckets, minhash
from tallyhouse.llm import components as components_module
from tallyhouse.llm.components import components, lowest
from tests.llm.conftest import ROWS


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Rows that share an id are one document, linked by any of its texts."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None], 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    return [(d, len(s), root(d), root(d) == d) for d, s in sets if d is not None]


def compare(df, rows):
    got = [tuple(r) for r in minhash.near_duplicates(df).where("doc_id is not null").collect()]
    assert sorted(got) == sorted(brute(rows))


def test_odd_rows(odd):
    compare(odd, [r[:2] for r in ROWS])
    report = minhash.near_duplicates(odd).collect()
    assert len(report) == len(ROWS)
    assert [(r["component_id"], r["kept"]) for r in report if r["doc_id"] is None] == [(None, True)]
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns
    stay = [d for d, _, _, keep in brute([r[:2] for r in ROWS]) if keep]
    assert {1, 7, 11} & set(stay) == set()
    # Document 8 is there twice, one of its rows stays.
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(stay))


def test_a_table_loaded_twice_leaves_the_same_rows_as_once(spark, odd, crowded_rows):
    for docs in (odd, spark.createDataFrame(crowded_rows, "doc_id long, text string").repartition(4)):
        once, twice = (
            Counter(tuple(r) for r in minhash.keep_one(some).select("doc_id", "text").collect())
            for some in (docs, docs.union(docs))
        )
        wordless = {row for row in once if not (row[1] or "").split()}
        assert twice == Counter({row: 2 * n if row in wordless else n for row, n in once.items()})


def near_copies(draw, words, n, edits):
    for _ in range(n):
        copy = list(words)
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(len(copy))] = f"e{draw.randint(0, 10**6)}"
        yield " ".join(copy)


@pytest.fixture
def crowded_rows():
    """Groups of near copies about the threshold, exact copies, a passage that many share."""
    draw = random.Random(4)

    def fresh(n):
        return [f"w{draw.randint(0, 5000)}" for _ in range(n)]

    texts = []
    for size, edits in ((120, 4), (40, 6), (25, 9), (10, 3)):
        texts += near_copies(draw, fresh(100), size, edits)
    texts += [" ".join(fresh(30))] * 60
    passage = fresh(40)
    texts += [" ".join(fresh(25) + passage + fresh(25)) for _ in range(150)]
    texts += [" ".join(fresh(draw.randint(1, 60))) for _ in range(150)]
    draw.shuffle(texts)
    return [(1000 - i, t.upper() if i % 5 == 0 else t) for i, t in enumerate(texts)]


def test_groups(spark, crowded_rows):
    df = spark.createDataFrame(crowded_rows, "doc_id long, text string").repartition(4)
    compare(df, crowded_rows)


def test_small_blocks_find_the_same(spark, crowded_rows, monkeypatch):
    monkeypatch.setattr(buckets, "BLOCK", 8)
    monkeypatch.setattr(buckets, "NEAREST", 1)
    df = spark.createDataFrame(crowded_rows, "doc_id long, text string").repartition(4)
    compare(df, crowded_rows)


def test_empty(nothing):
    assert minhash.near_duplicates(nothing).count() == 0


def test_words_do_not_cross_texts():
    texts = [b"Ab c", b"", b"d", b"ab", b" C\x0bd "]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts, pa.binary())], names=["id", "text"])
    ((_, hashes, counts, _),) = minhash.texts(batch)
    assert counts.tolist() == [2, 0, 1, 1, 2]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[4] and hashes[2] == hashes[5]
    assert len(set(hashes.tolist())) == 3


def test_slices_change_nothing(monkeypatch):
    texts = [f"a{i} b{i % 3} c d e f{i % 2}".encode() * (i % 4) for i in range(50)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(51)), pa.array(texts, pa.binary())], names=["id", "text"])
    whole = pa.Table.from_batches(list(minhash._signed(iter([batch])))).to_pydict()
    monkeypatch.setattr(minhash, "SLICE", 40)
    assert pa.Table.from_batches(list(minhash._signed(iter([batch.slice(0, 20), batch.slice(20)])))).to_pydict() == whole


def test_signature_estimates_the_share():
    draw = np.random.default_rng(0)
    common, a, b = (minhash.mixed(draw.integers(0, 2**63, n).astype(np.uint64)) for n in (3000, 500, 500))
    same = minhash.signature(np.concatenate([common, a])) == minhash.signature(np.concatenate([common, b]))
    assert abs(same.mean() - 0.75) < 0.13


def test_components(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (9, 2), (2, 9)]
    links += [(draw.randint(200, 400), draw.randint(200, 400)) for _ in range(120)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in parent)


def test_rows_without_id_and_texts_under_one_id(spark):
    draw = random.Random(8)
    a, b, c, d = (" ".join(f"w{draw.randint(0, 5000)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (2, b), (2, a + " tail"), (None, a), (None, a + " end"), (3, None), (None, ""), (None, "")]
    rows += [(None, c), (None, c), (None, c + " tail"), (None, d), (None, None), (7, b + " tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in minhash.keep_one(df).collect()]
    of_c = [r for r in kept if r[1] and r[1].startswith(c)]
    assert len(of_c) == 1
    rest = [r for r in kept if r not in of_c]
    want = [(1, a), (2, b), (3, None), (None, ""), (None, ""), (None, d), (None, None)]
    assert sorted(rest, key=str) == sorted(want, key=str)


def test_lowest_nodes_of_links():
    draw = np.random.default_rng(1)
    for n in (1, 30, 200):
        a, b = draw.integers(0, 150, (2, n))
        root = {int(x): int(x) for x in (*a, *b)}
        for _ in root:
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                root[x] = root[y] = min(root[x], root[y])
        nodes, least = lowest(a, b)
        assert dict(zip(nodes.tolist(), least.tolist(), strict=True)) == root


def test_components_over_many_small_tasks(spark, monkeypatch):
    draw = random.Random(6)
    links = [(i, i + 1) for i in range(300, 700)] + [(draw.randint(0, 90), draw.randint(0, 90)) for _ in range(50)]
    links += [(999, i) for i in range(1000, 1100)] + [(1200, i) for i in range(1100, 1200)]
    a, b = (np.array(x) for x in zip(*links, strict=True))
    linked = a != b
    want = dict(zip(*(x.tolist() for x in lowest(a[linked], b[linked])), strict=True))
    monkeypatch.setattr(components_module, "PER_TASK", 16)
    got = components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(want.items())
