from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, docs, empty

from metalake.llm.exact_dedup import BinaryFuse8, drop_exact_duplicates, exact_dedup


def norm(t):
    return (t or "").encode().lower()


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in sorted(ids, key=lambda x: (x is not None, x or 0)):
            stays = i == keep and not kept
            kept |= stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(t).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_awkward_rows(spark, digest_bytes):
    got = exact_dedup(docs(spark), digest_bytes=digest_bytes, keys_per_shard=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute(AWKWARD)


def test_short_digests_are_told_apart_by_bytes(spark):
    rows = [(i, f"text {i % 700}") for i in range(2000)]
    got = exact_dedup(docs(spark, rows), digest_bytes=1, keys_per_shard=50).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_empty_table(spark):
    assert exact_dedup(empty(spark)).count() == 0
    assert drop_exact_duplicates(empty(spark)).count() == 0


def test_drop_keeps_one_row_of_each_text_and_all_columns(spark):
    d = docs(spark)
    got = drop_exact_duplicates(d)
    assert got.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        {(i, norm(t)): (i, t) for i, t in AWKWARD
         if i == max((j for j, u in AWKWARD if norm(u) == norm(t) and j is not None), default=None)}.values(), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 10, 1000, 50_000])
def test_binary_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
    f = BinaryFuse8.from_bytes(BinaryFuse8.build(keys[:n]).to_bytes())
    assert f.contains(keys[:n]).all()
    if n >= 1000:
        assert f.contains(keys[n:]).mean() < 0.02
        assert len(f.to_bytes()) < 1.3 * n + 1000
