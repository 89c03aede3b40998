"""Exact top-k against brute force, on ties, copies, repeated and null ids, and vectors that take no part."""

import random

import numpy as np
import pytest

from addrloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, class int, score double"


def plain(rows, k=10, every=100):
    """rows: (id, vector), told apart by their place; ties go to the smaller id, null last."""
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(kept):
        if q is None or q % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w, strict=True)), c is None, c or 0, c) for b, (c, w) in enumerate(kept) if b != a and len(w) == len(v)]
        out += [(q, r, c, -s) for r, (s, _, _, c) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in topk.top_k(df, **options).collect()), key=str)


def f32(*x):
    return [None if y is None else float(np.float32(y)) for y in x]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)  # many blocks, of which most queries pass some by
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, f32(*(c + r.gauss(0, 0.05) for c in centres[i % 5]))) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [(100, rows[7][1]), (200, rows[8][1]), (7, rows[9][1]), (None, rows[7][1]), (None, rows[8][1])]
    rows += [(400, None), (401, f32(1, None, 2, 3, 4, 5)), (402, f32(1, float("nan"), 2, 3, 4, 5)), (500, f32(float("inf"), 1, 1, 1, 1, 1)), (600, f32(*[0] * 6)), (700, []), (701, []), (800, f32(1, 2)), (801, f32(3, -4)), (802, f32(0, 0))]
    r.shuffle(rows)
    assert found(spark, rows, every=20) == plain(rows, every=20)


def test_large_components_are_exact(spark):
    rows = [(0, f32(3e5, -7e4, 1 / 3)), (1, f32(5e5, 2e5, 9)), (2, f32(-5e5, 1e-3, 8)), (3, f32(5e5, 2e5, 9.001)), (100, f32(2.5e5, 2.5e5, 2.5e5))]
    assert found(spark, rows, k=3) == plain(rows, k=3)
    with pytest.raises(Exception, match="int64|Overflow|too (large|big)|out of"):
        found(spark, [(0, f32(1e30, 1)), (1, f32(1e30, 1))])


def test_nothing_to_search(spark):
    assert found(spark, []) == [] and found(spark, [(100, f32(1, 2))]) == [] and found(spark, [(1, f32(1, 2)), (2, f32(1, 2))]) == []


def test_bounds_hold():
    r = np.random.default_rng(1)
    v = np.floor(r.normal(size=(400, 8)) * r.choice([1, 50, 4000], (400, 1)))
    v[5], v[6] = 0, v[7] * 3
    pivots = topk.choose_pivots(list(v[:60]), 12)
    n = topk.lengths(v)
    a = topk.angles(v, n, pivots)
    for j in range(0, 400, 7):
        assert (topk.bounds(n[j], a[j], n, a) >= v @ v[j]).all()
