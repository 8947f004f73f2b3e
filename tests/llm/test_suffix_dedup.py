from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SF001
from helpers import AWKWARD, docs, empty, texts

from metalake.llm import suffix_dedup
from metalake.llm.queries import op3_suffix_dedup
from metalake.llm.suffix_dedup import multikey_quicksort, remove_repeats, words_of


def brute(rows, width):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(hash(t[i:i + width]) for t in data for i in range(len(t) - width + 1))
    out = []
    for (i, _), t in zip(rows, data):
        gone = np.zeros(len(t) + 1, int)
        for k in range(len(t) - width + 1):
            if seen[hash(t[k:k + width])] > 1:
                gone[k] += 1
                gone[k + width] -= 1
        cover = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~cover])
        spans = int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum())
        out.append((i, len(t), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def planted(seed, n=60, passage=90):
    """Random texts with shared passages, copies, repeats inside a text and edits."""
    rnd = random.Random(seed)

    def words(k):
        return " ".join(rnd.choice(["ab", "cd", "é", "fgh", "i", "jk"]) + str(rnd.randrange(30)) for _ in range(k))
    shared = [words(passage // 4) for _ in range(4)]
    rows = []
    for i in range(n):
        t = words(rnd.randrange(60))
        for _ in range(rnd.randrange(3)):
            s = rnd.choice(shared)
            cut = rnd.randrange(len(s) // 2)
            t += " " + s[cut:] + " " + words(rnd.randrange(10))
        if rows and rnd.random() < 0.3:
            t = rnd.choice(rows)[1]
            if rnd.random() < 0.6 and t:
                k = rnd.randrange(len(t))
                t = t[:k] + "#" + t[k + 1:]
        if rnd.random() < 0.1:
            t = t + t
        rows.append((i, t))
    return rows + [(n, "x" * 500), (n + 1, "x" * 130), (n + 2, "xy" * 200), (n + 2, "xy" * 200)]


@pytest.mark.parametrize("seed,piece_rows", [(1, 8192), (2, 3)])
def test_planted_repeats_by_brute_force(spark, monkeypatch, seed, piece_rows):
    rows = planted(seed)
    got = remove_repeats(docs(spark, rows), width=40, gram=20, piece_rows=piece_rows).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 40)


def test_query_by_brute_force(spark):
    got = op3_suffix_dedup(spark, SF001).collect()
    want = brute(texts(SF001), 400)
    assert sorted(map(tuple, got), key=repr) == want
    assert sum(r[2] for r in want) > 0


def test_awkward_rows(spark):
    assert sorted(map(tuple, remove_repeats(docs(spark)).collect()), key=repr) == brute(AWKWARD, 400)
    assert remove_repeats(empty(spark)).count() == 0


def test_stretches_of_long_texts_in_segments(monkeypatch):
    text = bytes(random.Random(3).choices(b"abc ", k=3000))
    one = {(p, k) for a in suffix_dedup.Anchors(40, 20).of(text) for lo, hi, _, k in zip(*a) for p in range(lo, hi + 1)}
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 97)
    two = {(p, k) for a in suffix_dedup.Anchors(40, 20).of(text) for lo, hi, _, k in zip(*a) for p in range(lo, hi + 1)}
    assert one == two and {p for p, _ in one} == set(range(len(text) - 39))


def test_multikey_quicksort_finds_equal_suffixes():
    rnd = random.Random(5)
    data = bytes(rnd.choices(b"ab", k=400)) * 2 + bytes(rnd.choices(b"ab\0\xff", k=300))
    starts = np.arange(len(data) - 20)
    order, group = multikey_quicksort(words_of(data), starts, 20)
    kinds = Counter(data[s:s + 20] for s in starts)
    assert sorted(order.tolist()) == [s for s in starts if kinds[data[s:s + 20]] > 1]
    cut = [data[s:s + 20] for s in starts[order]]
    assert cut == sorted(cut)
    assert all((a == b) == (x == y) for a, b, x, y in zip(cut, cut[1:], group, group[1:]))
