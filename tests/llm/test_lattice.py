import numpy as np
import pytest

from tallyhouse.llm import buckets, lattice

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, n=400, dim=24):
    draw = np.random.default_rng(seed)
    rows = [draw.standard_normal(dim) for _ in range(n)]
    for i in range(0, min(n, 120), 3):  # copies about the threshold
        rows.append(rows[i] + draw.standard_normal(dim) * draw.uniform(0, 0.6))
    centre = draw.standard_normal(dim)
    rows += [centre + draw.standard_normal(dim) * 0.3 for _ in range(90)]
    rows += [rows[5] * 3.0] * 40 + [rows[6]] * 30
    return [(3 * i - 50, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(rows)]


ODD = [
    (5001, None, 1),
    (5002, [], 1),
    (5003, [0.0] * 24, 1),
    (5004, [float("nan")] + [1.0] * 23, 1),
    (5005, [float("inf")] * 24, None),
    (5006, [None] + [1.0] * 23, 1),
    (None, [1.0] * 24, 1),
    (5007, [1.0] * 24, 1),
    (5007, [1.0] * 24, 1),
    (5008, [1e-30] * 24, 1),
    (5009, [1.0] * 12, 1),
]


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows):
    """Per id: links, component. Rows that share an id and vector are one."""
    named = {d: v for d, v, _ in rows if d is not None}
    ids = sorted(d for d in named if usable(named[d]))
    links = {d: set() for d in named}
    for dim in {len(named[d]) for d in ids}:
        some = [d for d in ids if len(named[d]) == dim]
        x = np.array([named[d] for d in some], dtype=np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= 0.9
        np.fill_diagonal(near, False)
        for i, j in zip(*np.nonzero(near), strict=True):
            links[some[i]].add(some[j])
    out = {}
    for d in named:
        seen, todo = {d}, [d]
        while todo:
            for e in links[todo.pop()] - seen:
                seen.add(e)
                todo.append(e)
        out[d] = (len(links[d]), min(seen))
    return out


def compare(df, rows):
    want = brute(rows)
    got = [r for r in lattice.near_duplicates(df).collect()]
    assert len(got) == len(rows)
    for r in got:
        if r["vec_id"] is not None:
            links, component = want[r["vec_id"]]
            assert (r["n_links"], r["component_id"]) == (links, component), r
            assert r["kept"] == (component == r["vec_id"])


def test_links_and_counts(spark):
    rows = vectors()
    compare(spark.createDataFrame(rows, SCHEMA).repartition(3), rows)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(buckets, "BLOCK", 16)
    rows = vectors(1, 150)
    compare(spark.createDataFrame(rows, SCHEMA).repartition(3), rows)


def test_odd_rows(spark):
    rows = vectors(2, 40) + [r for r in ODD if r[0] is not None]
    compare(spark.createDataFrame(rows, SCHEMA), rows)
    odd = {str(r["vec_id"]): r for r in lattice.near_duplicates(spark.createDataFrame(ODD, SCHEMA)).collect()}
    # The row without id is a copy of 5007; 5008 points the same way.
    assert odd["None"]["component_id"] == 5007 and odd["5008"]["component_id"] == 5007


def test_empty(spark):
    assert lattice.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing_usable = spark.createDataFrame(ODD[:6], SCHEMA)
    assert {r["n_links"] for r in lattice.near_duplicates(nothing_usable).collect()} == {0}


def test_e8_decodes_to_the_nearest_point():
    x = np.random.default_rng(3).standard_normal((2000, 8)) * 3
    point = lattice.e8(x)
    gap = ((x - point) ** 2).sum(axis=1)
    roots = lattice._roots()
    assert len(roots) == 240
    for r in roots:
        assert (((x - point - r) ** 2).sum(axis=1) >= gap - 1e-9).all()
    twice = 2 * point
    assert (twice == np.rint(twice)).all() and (twice % 2 == twice[:, :1] % 2).all()
    assert (point.sum(axis=1) % 2 == 0).all()


@pytest.mark.parametrize("dim", [16, 64, 200])
def test_pairs_at_the_threshold_meet(dim):
    draw = np.random.default_rng(dim)
    a = lattice.unit_rows(draw.standard_normal((1500, dim)))
    z = draw.standard_normal((1500, dim))
    z = lattice.unit_rows(z - (z * a).sum(axis=1, keepdims=True) * a)
    b = 0.9 * a + np.sqrt(1 - 0.81) * z
    keys = [
        lattice.cells(x, 0.9, lattice.TABLES, lattice.BLOCKS, lattice.PROBES, lattice.SEED) for x in (a, b)
    ]
    meet = [len(np.intersect1d(x, y)) > 0 for x, y in zip(*keys, strict=True)]
    assert np.mean(meet) >= 0.997
