from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from conftest import SF01
from helpers import AWKWARD, docs, empty, texts

from metalake.llm import language, toxicity
from metalake.llm.queries import op2_language_id, op4_toxicity


def rest(doc_id, m):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % m


# --- language -----------------------------------------------------------------

def brute_bits(train_text: str, text: bytes, order: int, allowed: set[bytes]) -> float:
    """PPM with exclusion, one symbol at a time, straight from the counts."""
    data = b"\n" * order + train_text.lower().encode() + b"\n" * order
    total = 0.0
    line = b"\n" * order + text
    for i in range(order, len(line)):
        state = line[i - order:i]
        while state not in allowed:
            state = state[1:]

        def p(ctx, s):
            seen = {}
            for j in range(len(data) - len(ctx)):
                if data[j:j + len(ctx)] == ctx:
                    seen[data[j + len(ctx)]] = seen.get(data[j + len(ctx)], 0) + 1
            t, q = sum(seen.values()), len(seen)
            if s in seen:
                return seen[s] / (t + q)
            low = (lambda x: p(ctx[1:], x)) if ctx else (lambda x: 1 / 256)
            if not t:
                return low(s)
            return q / (t + q) * low(s) / (1 - sum(low(x) for x in seen))
        total -= math.log2(p(state, line[i]))
    return total


def test_code_lengths_by_brute_force():
    train = {"aa": ["abracadabra abra"], "bb": ["barbara bar aba"]}
    model = language.train(train, order=2, max_contexts=1000)
    allowed = {b""}
    for t in train.values():
        d = b"\n\n" + t[0].encode() + b"\n\n"
        allowed |= {d[i:i + m] for m in (1, 2) for i in range(len(d) - m + 1)}
    for text in (b"abra", b"bar zebra\xff", b"a", b"cadabarbara" * 3):
        got = language.code_lengths(model, [text])[0]
        for i, lg in enumerate(model.langs):
            assert got[i] == pytest.approx(brute_bits(train[lg][0], text, 2, allowed), rel=1e-5)


def test_every_state_is_a_proper_code():
    model = language.train({"x": ["hello world hello"], "y": ["bonjour le monde"]}, order=3)
    bits = model.bits.reshape(-1, model.pad + 1, 2)
    seen = len(np.unique(model.classes)) - 1
    p = np.exp2(-bits[:, :seen].astype(float)).sum(1) + (256 - seen) * np.exp2(-bits[:, seen].astype(float))
    assert np.allclose(p, 1, atol=1e-4)


def test_chunks_add_up(monkeypatch):
    model = language.train({"x": ["hello world hello there"], "y": ["bonjour le monde entier"]}, order=3)
    text = b"hello monde entier there " * 40
    whole = language.code_lengths(model, [text, b"", text[:7]])
    monkeypatch.setattr(language, "_CHUNK", 5)
    monkeypatch.setattr(language, "_BLOCK", 3)
    assert np.allclose(language.code_lengths(model, [text, b"", text[:7]]), whole)
    assert (whole[1] == 0).all()


def test_language_query_on_held_out_rows(spark):
    got = {r.doc_id: r for r in op2_language_id(spark, SF01).collect()}
    import duckdb
    want = dict(duckdb.connect().execute(
        f"SELECT doc_id, lang FROM read_parquet('{SF01}/documents.parquet')").fetchall())
    assert set(got) == set(want)
    assert all(r.held_out == (rest(i, 3) == 1) and 0 <= r.score <= 1 for i, r in got.items())
    held = [r.lang_pred == want[i] for i, r in got.items() if r.held_out]
    assert sum(held) / len(held) > 0.97


def test_language_awkward_rows(spark):
    d = docs(spark, langs=["en" if t and "the" in t else None for _, t in AWKWARD])
    got = language.identify(d).collect()
    assert sorted([r.doc_id or -1 for r in got]) == sorted([i or -1 for i, _ in AWKWARD])
    assert {r.lang_pred for r in got} <= {"en", "und"}
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (3, 4, 6))
    unlearned = language.identify(docs(spark, langs=[None] * len(AWKWARD))).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)}
    assert language.identify(empty(spark)).count() == 0


# --- toxicity -----------------------------------------------------------------

def test_features_of_long_texts_do_not_depend_on_the_stretch(monkeypatch):
    text = " ".join(f"w{i * i % 313}" for i in range(2000))
    want = set(toxicity.Features(20).of(text).tolist())
    monkeypatch.setattr(toxicity, "_STEP", 17)
    assert set(toxicity.Features(20, room=64).of(text).tolist()) == want


def test_ftrl_by_scalar_updates():
    rng = np.random.default_rng(3)
    ex = [(int(rng.integers(2)), np.unique(rng.integers(0, 16, 5)).astype(np.int32)) for _ in range(50)]
    got = toxicity.ftrl(ex, 4, 0.5, 1.0, 0.3, 1.0, 2, 5)
    z, n, z0, n0, b = [0.0] * 16, [0.0] * 16, 0.0, 0.0, 0.0
    order = np.random.default_rng(5)

    def weight(i):
        if abs(z[i]) <= 0.3:
            return 0.0
        return -(z[i] - math.copysign(0.3, z[i])) / ((1 + math.sqrt(n[i])) / 0.5 + 1)
    for _ in range(2):
        for k in order.permutation(50):
            y, idx = ex[k]
            w = {int(i): weight(i) for i in idx}
            g = 1 / (1 + math.exp(-sum(w.values()) - b)) - y
            for i in w:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5 * w[i]
                n[i] += g * g
            z0 += g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / 0.5 * b
            n0 += g * g
            b = -z0 / ((1 + math.sqrt(n0)) / 0.5)
    assert np.allclose(got.dense(), [weight(i) for i in range(16)], atol=1e-6)
    assert got.intercept == pytest.approx(b)


def test_toxicity_query_on_held_out_rows(spark):
    got = {r.doc_id: r for r in op4_toxicity(spark, SF01).collect()}
    import duckdb
    want = dict(duckdb.connect().execute(
        f"SELECT doc_id, toxic FROM read_parquet('{SF01}/labels.parquet')").fetchall())
    assert set(got) == {i for i, _ in texts(SF01)}
    assert all(r.held_out == (rest(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
               for i, r in got.items())
    held = [(got[i].score, y) for i, y in want.items() if got[i].held_out]
    ups = [(a, b) for a, y in held if y for b, x in held if not x]
    assert sum(a > b for a, b in ups) / len(ups) > 0.9


def test_toxicity_awkward_rows(spark):
    d = docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (1, None), (2, 0)],
                                   "doc_id long, toxic int")
    got = toxicity.score_toxicity(d, labels).collect()
    assert sorted([r.doc_id or -1 for r in got]) == sorted([i or -1 for i, _ in AWKWARD])
    assert toxicity.drop_toxic(d, labels).columns == d.columns
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(d, none).collect()} == {0.0}
    assert toxicity.score_toxicity(empty(spark), labels).count() == 0
    assert toxicity.drop_toxic(empty(spark), none).count() == 0
