from __future__ import annotations

import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from metalake.llm import ann
from metalake.llm.ann import grow, nearest_neighbours
from metalake.llm.queries import op8_ann

SCHEMA = "vec_id long, embedding array<float>, label int, leaf long, score double"


def exact(rows, k):
    """(query_id, [(vec_id, score)]) by brute force in double precision."""
    ok = [(i, np.array(e, np.float64)) for i, e in rows
          if e is not None and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    out = {}
    for q, v in ok:
        if q is not None and q % 20 == 0 and q not in out:
            found = [(i, float((np.float64(1) * e * v).sum())) for i, e in ok if i != q]
            out[q] = sorted(found, key=lambda x: (-x[1], x[0] is None, x[0]))[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], 0, 1, 0.5)
                                  for i, e in rows], SCHEMA)


def ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r)
    assert all([r.rank for r in v] == list(range(1, len(v) + 1)) for v in out.values())
    return out


def test_query_recall_and_scores(spark):
    import duckdb
    rows = duckdb.connect().execute(f"SELECT vec_id, embedding FROM read_parquet('{SF01}/embeddings.parquet')").fetchall()
    want, got = exact(rows, 20), ranked(op8_ann(spark, SF01))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hit = sum(len({i for i, _ in want[q]} & {r.vec_id for r in got[q]}) for q in want)
    assert hit / (20 * len(want)) >= 0.9
    vec = dict(rows)
    for q, v in got.items():
        assert all(r.score == pytest.approx(float(np.dot(np.float64(vec[q]), np.float64(vec[r.vec_id]))), abs=1e-12) for r in v)
        assert all((a.score, -a.vec_id) > (b.score, -b.vec_id) for a, b in zip(v, v[1:]))


def test_recall_on_many_leaves(spark):
    rng = np.random.default_rng(1)
    rows = [(i, e) for i, e in enumerate(rng.normal(size=(3000, 8)).round(3).tolist())]
    got = ranked(nearest_neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=10, per_leaf=64, block=37))
    want = exact([(i, np.float32(e)) for i, e in rows], 10)
    hit = sum(len({i for i, _ in want[q]} & {r.vec_id for r in got[q]}) for q in want)
    assert set(got) == set(want) and hit / (10 * len(want)) >= 0.9


def test_awkward_vectors(spark):
    rows = [(0, [1, 0, 0]), (1, [1, 0, 0]), (2, [1, 0, 0]), (3, None), (4, [0, 0, 0]), (5, [None, 1, 0]),
            (6, [float("nan"), 1, 0]), (7, [float("inf"), 0, 0]), (8, [2, 0, 0]), (20, [0, 1, 0]), (20, [0, 1, 0]),
            (40, [0, 0, 0]), (9, [1, 2]), (None, [1, 0, 0]), (60, None)]
    got = ranked(nearest_neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=4))
    assert [(r.vec_id, r.score) for r in got[0]] == [(8, 2.0), (1, 1.0), (2, 1.0), (None, 1.0)]
    assert set(got) == {0, 20} and {r.vec_id for r in got[20]} <= {0, 1, 2, 8, None}
    assert nearest_neighbours(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest_neighbours(table(spark, [(0, [1, 2])]), F.col("vec_id") % 20 == 0).count() == 0


def test_equal_vectors_in_many_blocks(spark):
    rows = [(i, [1, 1]) for i in range(300)] + [(i, [-1, 0.5]) for i in range(300, 330)]
    got = ranked(nearest_neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=5, block=16))
    assert [r.vec_id for r in got[0]] == [1, 2, 3, 4, 5] and [r.vec_id for r in got[20]] == [0, 1, 2, 3, 4]


def test_queries_in_tiny_leaves_get_k_rows(spark, monkeypatch):
    """However few visits calibration asks for; one query starts in a group of three."""
    monkeypatch.setattr(ann, "calibrate", lambda *a: (1, 1.0))
    rng = np.random.default_rng(5)
    axes = np.repeat(np.arange(41), [60] * 40 + [3])
    rows = [(20 * 150 if i == 2400 else i, (rng.normal(0, 1e-4, 41) + np.eye(41)[a]).tolist()) for i, a in enumerate(axes)]
    got = ranked(nearest_neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=10, per_leaf=60))
    assert len(got) == 121 and all(len(v) == 10 for v in got.values())


def test_tree_walk_reaches_every_leaf_once():
    x = np.random.default_rng(0).normal(size=(2000, 6))
    tree = grow(x, 50)
    assert tree.leaves > 20
    assert sorted(tree.best_bins(x[0])) == list(range(tree.leaves))
    assert set(tree.assign(x)) <= set(range(tree.leaves))
    promise = [max((x[0] @ tree.centroids[v]) for v in np.flatnonzero(tree.leaf == leaf)) for leaf in tree.best_bins(x[0])]
    assert promise[0] >= np.median(promise)


def test_leaf_bounds_hold():
    """No vector of a leaf scores above the bound by which the leaf is left out."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 6)) + 8 * np.eye(6)[rng.integers(0, 6, 3000)]
    tree = grow(x[:500], 20)
    leaf, centres = tree.assign(x), tree.leaf_centroids()
    off = np.linalg.norm(x - centres[leaf], axis=1)
    radius = np.array([off[leaf == i].max(initial=0) for i in range(tree.leaves)])
    most = x[:40] @ centres.T + np.linalg.norm(x[:40], axis=1)[:, None] * radius
    assert all((x[:40] @ x[leaf == i].T).max(axis=1, initial=-np.inf).max() <= most[:, i].max() + 1e-9 for i in range(tree.leaves))
    best = np.sort(x[:40] @ x.T, axis=1)[:, -10]
    assert ((most < best[:, None]).mean() > 0.5)  # and leaves out most leaves of clustered vectors


def test_clustered_vectors_through_rounds(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 8)) * 5
    rows = [(i, (centres[i % 30] + rng.normal(size=8) * 0.2).round(3).tolist()) for i in range(1500)]
    got = ranked(nearest_neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=5, per_leaf=20, first=1, widen=2))
    want = exact([(i, np.float32(e)) for i, e in rows], 5)
    hit = sum(len({i for i, _ in want[q]} & {r.vec_id for r in got[q]}) for q in want)
    assert set(got) == set(want) and hit / (5 * len(want)) >= 0.9
