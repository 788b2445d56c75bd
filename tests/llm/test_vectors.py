"""Whitening and hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from shelfline.llm import hard_negatives, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, y string, row string, leaf string, n string"


@pytest.fixture(scope="module")
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, c, "a", "b", "c", "d", "e") for i, v, c in rows], SCHEMA)

    return build


def odd_vectors(n=230, width=6, seed=3):
    r = random.Random(seed)
    rows = [(i, [float(np.float32(r.gauss(0, 1) * (k + 1))) for k in range(width)], r.randrange(4)) for i in range(n)]
    rows += [(1000 + i, rows[7][1], i % 4) for i in range(80)]  # one vector that a third of the rows have
    rows += [(2000, None, 1), (2001, [1.0] * (width - 1) + [None], 1), (2002, [float("nan")] * width, 2), (2003, [1.0] * (width + 1), 2),
             (2004, [float("inf")] * width, 1), (2005, [], 1), (2006, rows[3][1], None), (None, rows[4][1], 2), (5, rows[5][1], 1)]
    return rows


def usable(rows, width=6):
    return [(i, v, c) for i, v, c in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]


def test_whitening_of_odd_rows(vectors):
    rows = odd_vectors()
    got = whitening.whiten(vectors(rows)).collect()
    kept = usable(rows)
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for _, v, _ in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    values, components = np.linalg.eigh(np.cov(fit.T, bias=True))
    assert len(got) == len(kept) * 6 and {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    centred = x - sums / n
    for k in range(6):
        want = centred @ components[:, 5 - k] / np.sqrt(values[5 - k])
        own = {r.vec_id: r for r in got if r.component == k + 1}
        have = np.array([own[i].whitened for i, _, _ in kept])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-9
        assert own[0].explained == pytest.approx(values[5 - k] / values.sum(), rel=1e-9)
    for i, row in zip([i for i, _, _ in kept], x):
        assert by[i][0].deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_keeps_small_components(vectors):
    """One dimension a millionth as wide as another: half of its digits would be lost in the covariance."""
    r = random.Random(1)
    rows = [(i, [r.uniform(-1e6, 1e6), r.uniform(-1, 1), 3.0], 0) for i in range(400)]
    model = {row.component: row for row in whitening.whiten(vectors(rows)).filter("vec_id = 0").collect()}
    assert set(model) == {1, 2}  # the third dimension has no variance
    assert model[1].identity_error < 1e-9


def test_no_variance_no_components(vectors):
    assert whitening.whiten(vectors([])).collect() == []
    assert whitening.whiten(vectors([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect() == []
    assert whitening.whiten(vectors([(1, None, 0)])).collect() == []


def test_triangular_solve_and_exact_deviation():
    rows, upper = np.random.default_rng(1).normal(size=(9, 5)), np.triu(np.random.default_rng(2).normal(size=(5, 5))) + 4 * np.eye(5)
    assert np.allclose(whitening.solved(rows, upper) @ upper, rows)
    model = whitening.Whitening(1 << 40, [3, 5], np.eye(2), np.ones(2), 2.0, 1)
    x = np.array([[1, 2], [1 << 30, 7]])
    exact = [sum((int(v) * model.n - s) ** 2 for v, s in zip(row, model.sums)) for row in x]
    assert model.deviations(x) == [v if v < 1 << 63 else None for v in exact]


def brute_negatives(rows, every=100, positives=5, negatives=5, low=80):
    rows = [(k, i, c, [math.floor(256 * float(e)) for e in v]) for k, (i, v, c) in enumerate(rows) if i is not None and c is not None]
    out = []
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    for k, i, c, v in rows:
        if i % every:
            continue
        scored = [(-dot(v, w), j, m, d) for m, j, d, w in rows if m != k]
        for s, j, _, _ in sorted(x for x in scored if x[3] == c)[:positives]:
            inside = sorted(x for x in scored if x[3] != c and low * -s <= 100 * -x[0] <= 100 * -s)[:negatives]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("leaf_rows, block", [(2048, 4096), (16, 4096), (16, 20)])
def test_hard_negatives(vectors, monkeypatch, leaf_rows, block):
    """One leaf; a tree of several levels; leaves of several blocks."""
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "grow", lambda sample, rows, f=hard_negatives.grow: f(sample, rows, leaf_rows, 4))
    rows = odd_vectors()
    got = hard_negatives.mine(vectors(rows), every=10).collect()
    assert sorted(map(tuple, got)) == brute_negatives(usable(rows), every=10)


def test_hard_negatives_of_empty_tables(vectors):
    assert hard_negatives.mine(vectors([])).collect() == []
    assert hard_negatives.mine(vectors([(1, [1.0], 1), (2, [2.0], 2)])).collect() == []  # no anchors
    assert hard_negatives.mine(vectors([(100, [1.0], 1), (2, [2.0], 2)])).collect() == []  # no positives


def test_the_tree_eliminates_only_what_it_may():
    r = np.random.default_rng(7)
    centres = r.integers(-2000, 2000, (12, 3))
    rows = (centres[r.integers(0, 12, 4000)] + r.integers(-40, 40, (4000, 3))).astype(np.float64)
    tree = hard_negatives.grow(rows[:1000], len(rows), 64, 4)
    leaf, steps = hard_negatives.routes(tree, rows)
    sizes = [len(node.points) for node in tree.nodes]
    tree.near, tree.far = [np.full((m, m), np.inf) for m in sizes], [np.full((m, m), -np.inf) for m in sizes]
    tree.short, tree.long = [np.full(m, np.inf) for m in sizes], [np.full(m, -np.inf) for m in sizes]
    squares = (rows**2).sum(1)
    for at, some, apart, branch in steps:
        for j in np.unique(branch):
            own = branch == j
            tree.near[at][:, j], tree.far[at][:, j] = apart[own].min(0), apart[own].max(0)
            tree.short[at][j], tree.long[at][j] = squares[some[own]].min(), squares[some[own]].max()
    anchors = rows[::40]
    scores = anchors @ rows.T
    high = np.sort(scores, 1)[:, -3]
    low = 0.98 * high
    who, where = hard_negatives.survivors(tree, anchors, np.minimum(low, high), np.maximum(low, high))
    seen = set(zip(who.tolist(), where.tolist()))
    line, place = np.nonzero((scores >= np.minimum(low, high)[:, None]) & (scores <= np.maximum(low, high)[:, None]))
    assert {(a, leaf[b]) for a, b in zip(line.tolist(), place.tolist())} <= seen
    assert len(seen) < 0.5 * len(anchors) * tree.leaves


def test_registered_queries(spark, vectors, tmp_path):
    rows = [(i, v, c) for i, v, c in odd_vectors() if i is None or i < 1000]
    vectors(rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    whole = usable(rows)
    assert queries.QUERIES["op11_cholesky_whitening"](spark, str(tmp_path)).count() == 6 * len(whole)
    relabelled = [(i, v, (c + 1) % 10 if i is not None and i % 7 == 0 and c is not None else c) for i, v, c in whole]
    got = queries.QUERIES["op12_tree_hard_negatives"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == brute_negatives(relabelled)
