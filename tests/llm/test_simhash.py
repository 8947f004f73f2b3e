from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from conftest import SF001
from helpers import AWKWARD, docs, empty, texts

from metalake.llm import simhash
from metalake.llm.queries import op7_simhash_near_dedup
from metalake.llm.simhash import drop_near_duplicates, fingerprint, links, simhash_groups, spanning_links


def brute_fp(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [words[i:i + 3] for i in range(len(words) - 2)] or [words]
    hs = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def test_query_by_brute_force(spark):
    got = op7_simhash_near_dedup(spark, SF001).collect()
    assert sorted(map(tuple, got), key=repr) == brute(texts(SF001))


def test_awkward_rows(spark):
    assert sorted(map(tuple, simhash_groups(docs(spark)).collect()), key=repr) == brute(AWKWARD)


def test_long_texts_in_steps(monkeypatch):
    text = " ".join(f"word{i * i % 1009}" for i in range(5000)) + "  "
    monkeypatch.setattr(simhash, "_STEP", 37)
    assert fingerprint(text.encode()) & (1 << 64) - 1 == brute_fp(text)
    assert fingerprint(b"one two" + b" " * 500) & (1 << 64) - 1 == brute_fp("one two")


def test_empty_table(spark):
    assert simhash_groups(empty(spark)).count() == 0
    assert drop_near_duplicates(empty(spark)).count() == 0


def test_drop_keeps_one_row_of_each_group(spark):
    d = docs(spark)
    got = drop_near_duplicates(d)
    assert got.columns == d.columns
    fps = sorted({brute_fp(t) for _, t in AWKWARD})
    pairs = [(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 3]
    assert got.count() == len(components(pairs, fps))


def components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        root[find(a)] = find(b)
    return sorted(sorted(n for n in nodes if find(n) == r) for r in {find(n) for n in nodes})


@pytest.mark.parametrize("seed", [1, 2])
def test_links_connect_what_all_pairs_connect(spark, seed):
    rnd = random.Random(seed)
    fps = set()
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(25):
            f = base
            for _ in range(rnd.randrange(5)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f - (1 << 64) if f >> 63 else f)
    fps = sorted(fps)
    want = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    got = [tuple(r) for r in links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()]
    assert set(got) <= set(want) | {(b, a) for a, b in want}
    assert components(got, fps) == components(want, fps)


@pytest.mark.parametrize("crowded", [1, 30])
def test_crowded_postings_are_taken_apart(spark, monkeypatch, crowded):
    """Fingerprints that share four bytes, in few and in many further bits."""
    rnd = random.Random(crowded)
    fps = set()
    for _ in range(15):
        base = 0x1122334400000000 | rnd.getrandbits(32)
        for _ in range(20):
            f = base
            for _ in range(rnd.randrange(4)):
                f ^= 1 << rnd.randrange(32)
            fps.add(f)
    fps |= {0x1122334455000000 | i for i in range(100)}
    fps = sorted(fps)
    want = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 3]
    whole, sizes = simhash.postings, []

    def small(nodes, **_):
        got = whole(nodes, crowded)
        sizes.append(max(r["count"] for r in got.groupBy("label", "key").count().collect()))
        return got
    monkeypatch.setattr(simhash, "postings", small)
    got = [tuple(r) for r in links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()]
    assert components(got, fps) == components(want, fps) and sizes[0] < len(fps) / 2


def test_every_close_pair_agrees_under_a_finer_mask():
    rnd = random.Random(3)
    for level in (0, 1):
        above = [m for ms in simhash.masks(level - 1) for m in ms] if level else [
            sum(0xFF << (8 * p) for p in q) for q in simhash.PLANES]
        finer = simhash.masks(level)
        assert len(above) == len(finer)
        for m, ms in zip(above, finer):
            free = [b for b in range(64) if not m >> b & 1]
            for _ in range(200):
                differ = sum(1 << b for b in rnd.sample(free, rnd.randrange(4)))
                assert any(differ & f == 0 for f in ms)
    assert all((~f & (1 << 64) - 1).bit_count() == 12 for ms in simhash.masks(1) for f in ms)


def test_dense_posting_gives_a_forest_not_its_pairs():
    fps = np.array([1 << i for i in range(62)], np.int64)
    assert len(spanning_links(fps, 3)) == 61
