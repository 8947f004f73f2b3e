from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from metalake.llm import hard_negatives as module
from metalake.llm.hard_negatives import SharedList, angular_bounds, hard_negatives
from metalake.llm.queries import op11_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, cluster long, nth long, score double, b long, `row.x` int"


def brute(rows, positives=5, negatives=5, low=80, high=100):
    ok = [(i, label, [math.floor(256 * x) for x in e]) for i, e, label in rows
          if e is not None and label is not None and all(x is not None and math.isfinite(x) for x in e)]
    lengths = [len(v) for _, _, v in ok]
    common = min(sorted(set(lengths)), key=lambda n: -lengths.count(n), default=0)
    ok = [r for r in ok if len(r[2]) == common]
    last = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, la, va in ok:
        if a is None or a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in ok if i != a]
        for ps, p, _ in sorted((s for s in scored if s[2] == la), key=last)[:positives]:
            fit = [s for s in scored if s[2] != la and low * ps <= 100 * s[0] <= high * ps]
            out += [(a, p, rank, n, ps, ns) for rank, (ns, n, _) in enumerate(sorted(fit, key=last)[:negatives], 1)]
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], label, 1, 2, 0.5, 3, 4)
                                  for i, e, label in rows], SCHEMA)


def mined(spark, rows, **options):
    got = hard_negatives(table(spark, rows), F.col("vec_id") % 100 == 0, F.col("label"), **options)
    return sorted(map(tuple, got.collect()), key=repr)


def test_query_by_brute_force(spark):
    import duckdb
    rows = duckdb.connect().execute(f"SELECT vec_id, embedding, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END "
                                    f"FROM read_parquet('{SF01}/embeddings.parquet')").fetchall()
    got = op11_hard_negatives(spark, SF01)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                "positive_score": "bigint", "negative_score": "bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_many_groups_and_blocks(spark):
    """Clustered vectors with ties and a hot vector, in small groups and blocks."""
    rnd = random.Random(4)
    axes = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(7)]
    rows = [(i * 10, [round(x + rnd.gauss(0, 0.3), 1) for x in rnd.choice(axes)], rnd.randrange(3)) for i in range(700)]
    rows += [(10_001 + i, [0.5, 0.5, 0, 0, 0, 0], i % 2) for i in range(300)]
    assert mined(spark, rows, per_cluster=4, group=16, block=97) == brute(rows)


def test_awkward_rows(spark):
    rows = [(0, [1, 0, 0], 1), (1, [0.9, 0, 0], 1), (2, [0.8, 0, 0], 2), (3, None, 1), (4, [None, 1, 0], 1),
            (5, [float("nan"), 1, 0], 2), (6, [float("inf"), 0, 0], 1), (7, [1, 0, 0], None), (8, [0.9, 0.1], 2),
            (None, [0.8, 0, 0], 2), (None, [0.85, 0, 0], 1), (9, [0.8, 0, 0], 2), (9, [0.8, 0, 0], 2), (0, [0.5, 0, 0], 2),
            (100, [0, 0, 0], 1), (200, [-1, 0, 0], 2), (300, [0, 1e-9, 0], 3), (11, [-0.9, 0, 0], 1), (400, None, 2),
            (12, [0.7999999, 0, 0], 2)]
    got = mined(spark, rows)
    assert got == brute(rows) and any(r[3] is None for r in got) and any(r[1] is None for r in got)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == [(0, 1, 1, 2, 0, 0)]


def test_scores_beyond_doubles_are_exact(spark):
    big = 2.0 ** 22
    rows = [(0, [big, big, 1], 1), (1, [big, big, 0.5], 1), (2, [big, big, 0.25], 2), (3, [big, big, 0.5], 2), (4, [big, big, 1], 2)]
    got = mined(spark, rows)
    assert got == brute(rows) and {r[4] for r in got} == {2 ** 61 + 128 * 256}


def test_bounds_hold_and_end_the_walk():
    rng = np.random.default_rng(3)
    members = rng.normal(0, 5, (40, 12)) + 60 * np.eye(12)[0]
    items = np.concatenate([rng.normal(0, 30, (4000, 12)), rng.normal(0, 3, (50, 12)) + 100 * np.eye(12)[0], np.zeros((3, 12))])
    bounds = angular_bounds(members, items)
    assert (members @ items.T <= np.linalg.norm(members, axis=1)[:, None] * bounds + 1e-6).all()
    shared = SharedList(np.floor(members), np.floor(items), 100)
    least = [-np.inf] * 40
    best = [np.zeros(0)] * 40
    for i, _, scores in shared.walk(least, 32):
        best[i] = np.sort(np.concatenate((best[i], scores)))[-5:]
        least[i] = float(best[i][0]) if len(best[i]) == 5 else -np.inf
    assert shared.walked < 0.2 * 40 * len(items)
    assert all((np.sort(np.floor(m) @ np.floor(items).T)[-5:] == b).all() for m, b in zip(members, best))


@pytest.mark.parametrize("members, items", [(np.zeros((2, 3)), np.eye(3)), (np.array([[1.0, 0, 0], [-1, 0, 0]]), np.eye(3))])
def test_bounds_without_a_centre(members, items):
    assert (members @ items.T <= np.linalg.norm(members, axis=1)[:, None] * angular_bounds(members, items)).all()


def test_only_the_sample_is_collected(spark, monkeypatch):
    monkeypatch.setattr(module, "_SAMPLED", 6 * 8)
    rnd = random.Random(7)
    rows = [(i * 50, [rnd.gauss(0, 1) for _ in range(6)], i % 2) for i in range(200)]
    assert mined(spark, rows, per_cluster=4) == brute(rows)
