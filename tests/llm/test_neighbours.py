import numpy as np
import pytest

from tallyhouse.llm import neighbours
from tests.llm.test_lattice import ODD, SCHEMA, usable


def brute(rows, k, every=20):
    named = [(d, v) for d, v, _ in rows if d is not None and usable(v) and len(v) == len(rows[0][1])]
    ids = np.array([d for d, _ in named])
    x = np.array([v for _, v in named], dtype=np.float32).astype(float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = x @ x[i]
        best = {}
        for d, s in zip(ids.tolist(), score.tolist(), strict=True):
            if d != ids[i]:
                best[d] = max(s, best.get(d, -np.inf))
        out[int(ids[i])] = sorted(best.items(), key=lambda t: (-t[1], t[0]))[:k]
    return out


def found(df, **options):
    rows = neighbours.search(df, df["vec_id"] % 20 == 0, **options).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def close(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [d for d, _ in got[q]] == [d for d, _ in want[q]], q
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], rel=1e-12)


def clustered(seed, n, norm=True):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, 32))
    x = centres[draw.integers(0, 12, n)] + draw.standard_normal((n, 32)) * 0.5
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if norm else x * draw.uniform(0.1, 5, (n, 1))
    return [(i, [float(np.float32(v)) for v in row], 0) for i, row in enumerate(x)]


@pytest.mark.parametrize("norm", [True, False])
def test_all_lists_are_nearly_exact(spark, norm):
    rows = clustered(1, 1200, norm)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got, want = found(df, share=1.0), brute(rows, 20)
    hits = sum(len({d for d, _ in got[q]} & {d for d, _ in want[q]}) for q in want)
    assert hits >= 0.98 * 20 * len(want)


def test_recall_of_the_default_share(spark):
    rows = clustered(2, 1500)
    got, want = found(spark.createDataFrame(rows, SCHEMA)), brute(rows, 20)
    hits = sum(len({d for d, _ in got[q]} & {d for d, _ in want[q]}) for q in want)
    assert hits >= 0.93 * 20 * len(want)


def test_copies_and_ties(spark):
    # Two vectors, each with hundreds of copies: ties go to the smallest ids, never to the query.
    rows = [(i, [1.0, 0.0, 0.5] if i % 3 else [0.0, 2.0, 0.25], 0) for i in range(400)]
    close(found(spark.createDataFrame(rows, SCHEMA), share=1.0), brute(rows, 20))


def test_odd_rows_and_few_candidates(spark):
    rows = clustered(3, 9)
    odd = [(d, [1.0] * 32 if v and len(v) == 24 and usable(v) else v, 0) for d, v, _ in ODD]
    rows += [*odd, (40, rows[0][1], 0), (40, rows[1][1], 0), (60, None, 0)]
    want = brute(rows, 20)
    got = found(spark.createDataFrame(rows, SCHEMA), share=1.0)
    assert got.keys() == want.keys() and 60 not in got
    for q in want:
        if q != 40:  # two vectors share that id
            assert got[q] == [(d, pytest.approx(s, rel=1e-12)) for d, s in want[q]]


def test_empty(spark):
    for rows in ([], ODD[:6]):
        df = spark.createDataFrame(rows, SCHEMA)
        out = neighbours.search(df, df["vec_id"] % 20 == 0)
        assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


def test_scan_keeps_all_that_beat_the_bound():
    draw = np.random.default_rng(5)
    q, p = draw.standard_normal((20, 48)), draw.standard_normal((300, 48))
    exact = ((q[:, None] - p) ** 2).sum(axis=2)
    bound = np.sort(exact, axis=1)[:, 10]
    a, b, gap = neighbours.scan(q, p, bound)
    assert gap == pytest.approx(exact[a, b])
    kept = np.zeros(exact.shape, dtype=bool)
    kept[a, b] = True
    assert kept[exact <= bound[:, None]].mean() >= 0.98
    assert kept.mean() < 0.2


@pytest.mark.parametrize("times", [1e4, 1e9])
def test_one_long_vector_drowns_no_other(spark, times):
    rows = clustered(4, 1500)
    rows[3] = (3, [times * v for v in rows[3][1]], 0)
    got, want = found(spark.createDataFrame(rows, SCHEMA)), brute(rows, 20)
    hits = sum(len({d for d, _ in got[q]} & {d for d, _ in want[q]}) for q in want)
    assert hits >= 0.93 * 20 * len(want)


def test_few_candidates_are_all_found_with_the_default_share(spark):
    rows = clustered(5, 20)
    close(found(spark.createDataFrame(rows, SCHEMA)), brute(rows, 20))
