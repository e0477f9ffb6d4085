import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from tallyhouse.llm import lexical
from tests.llm.conftest import ROWS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "The quick brown fox"),
    (2, "shared line of text, line of TEXT"),
    (2, "and no id"),
    (3, ""),
    (4, None),
    (None, "straße 日本語 w1 x2"),
    (5, "nothing-of-this-kind zzz"),
    (6, "one"),
]


def split(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute(docs, items, k):
    counts = [(doc_id, Counter(split(text))) for doc_id, text in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    holding = Counter(t for _, c in counts for t in c)
    sets = {}
    for item_id, text in items:
        sets.setdefault(item_id, set()).update(split(text))
    out = []
    for item_id, wanted in sets.items():
        scored = []
        for doc_id, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                floor(1000 * log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in wanted
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        best = sorted(scored)[:k]
        out += [(item_id, i + 1, doc_id, -score) for i, (score, _, _, doc_id) in enumerate(best)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("k,width,tables", [(50, 4096, 2), (2, 4096, 2), (3, 8, 1), (1, 1, 2)])
def test_equals_brute_force(odd, items, k, width, tables):
    got = lexical.search(odd, items, k, width=width, tables=tables)
    assert rows_of(got) == brute([(r[0], r[1]) for r in ROWS], ITEMS, k)


@pytest.mark.parametrize("docs_at_once,item_bytes", [(7, 10**9), (512, 40)])
def test_given_tables_in_blocks(spark, monkeypatch, docs_at_once, item_bytes):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").limit(6)
    asked = [tuple(r) for r in items.collect()]
    monkeypatch.setattr(lexical, "BLOCK_DOCS", docs_at_once)
    monkeypatch.setattr(lexical, "PART", 100)
    if item_bytes < 1000:
        monkeypatch.setattr(lexical, "ITEM_BYTES", 400)
    got = lexical.search(docs.repartition(3), spark.createDataFrame(asked, items.schema), 10)
    assert rows_of(got) == brute([tuple(r) for r in docs.collect()], asked, 10)


def test_bounds_hold_and_prune():
    texts = [f"word{i % 40} other{i % 7} {'often ' * (i % 5)} end{i}".encode() for i in range(400)]
    block = lexical.Block(list(range(400)), texts, 400, 1600, 4096, 2)
    wanted = [(b"word3", 900), (b"other3", 400), (b"often", 100)]
    hashed = np.array([lexical.crc32(t) for t, _ in wanted], dtype=np.uint32)
    spots = lexical.coordinates(hashed, 4096, 2)
    weights = np.array([w for _, w in wanted], dtype=float)
    bounds = block.bounds(spots, weights)
    scores = [block.score(i, wanted) for i in range(400)]
    assert all(b >= s for b, s in zip(bounds, scores, strict=True))
    rescored = []
    real = block.score
    block.score = lambda i, terms: rescored.append(i) or real(i, terms)
    best = lexical.Best(5)
    block.rank(wanted, spots, weights, best)
    assert sorted(-o for _, o in best.heap) == sorted(sorted(range(400), key=lambda i: (-scores[i], i))[:5])
    assert len(rescored) < 100


def test_terms_go_over_no_part_end(monkeypatch):
    text = "abc def" * 50 + " Ünï_x 9Z"
    whole = [t for some in lexical.terms(text.encode()) for t in some]
    monkeypatch.setattr(lexical, "PART", 3)
    assert [t for some in lexical.terms(text.encode()) for t in some] == whole
    assert whole == [t.encode() for t in split(text)]


def test_empty(odd, nothing, items):
    assert lexical.search(nothing, items).count() == 0
    got = lexical.search(odd, items.limit(0))
    assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]
    # No document holds a term that counts.
    assert lexical.search(odd.where("doc_id = 3"), items).count() == 0
