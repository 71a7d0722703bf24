"""Top inner products against all pairs."""

import random

import numpy as np
import pytest

from tablefolio.llm import balltree

VECTORS = "vec_id long, embedding array<float>, id string, v string, dim string"


def brute(rows, asked, k):
    whole = [(i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in {i: v for i, v in whole if i in asked}.items():
        scores = sorted(((-int(q @ v), j) for j, v in whole if j != i and len(v) == len(q)))[:k]
        out |= {(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)}
    return out


def found(spark, rows, k=5, every=7):
    df = spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], VECTORS)
    got = balltree.top_k(df, df.where(f"vec_id % {every} = 0"), k).collect()
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in got]


def test_as_all_pairs(spark, monkeypatch):
    for name, size in (("SHARD", 40), ("BLOCK", 5), ("GROUP", 2), ("LEAF", 4)):
        monkeypatch.setattr(balltree, name, size)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [float(rng.randint(-1, 1)) for _ in range(6)]) for i in range(100)]  # many ties
    rows += [(300 + i, rows[0][1]) for i in range(20)]
    rows += [(400, None), (401, []), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (406, [float("nan")] * 6), (407, [float("inf")] + [0.0] * 5),
             (413, [1.0, 2.0]), (414, [0.5, 2.0]), (None, [1.0] * 6), (420, []), (441, [100.0] * 6)]
    got = found(spark, rows)
    asked = {i for i, _ in rows if i is not None and i % 7 == 0}
    assert len(got) == len(set(got)) and set(got) == brute(rows, asked, 5)


def test_fewer_than_k_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (7, [0.0, 1.0])]
    assert sorted(found(spark, rows)) == [(0, 1, 7, 0), (7, 1, 0, 0)]
    assert found(spark, [(1, [1.0])]) == [] and found(spark, []) == []


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0])]
    assert sorted(found(spark, rows)) == [(0, 1, 2, 256 * 768), (0, 2, 1, 256 * 512), (0, 3, 1, 256 * 512)]


def test_too_large_components(spark):
    for x in (1e30, -1e30, 1e7):
        with pytest.raises(Exception, match="too large"):
            found(spark, [(0, [x]), (1, [1.0])])


def test_bounds_hold():
    rng = np.random.default_rng(0)
    points = rng.integers(-300, 300, (500, 8))
    tree = balltree.Ball(np.arange(500), points, leaf=10)
    queries = rng.integers(-300, 300, (20, 8)).astype(float)
    top = tree.bounds(queries)
    for node, (a, b) in enumerate(tree.spans):
        assert (top[:, node] >= (queries @ tree.vectors[a:b].T).max(axis=1)).all()
    assert sorted(tree.ids.tolist()) == list(range(500))
