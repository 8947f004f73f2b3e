from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF001, SF01
from helpers import AWKWARD, docs, empty, texts
from pyspark.sql import functions as F

from metalake.llm import boosting, pii
from metalake.llm.queries import op5_pii

# The contract's patterns, written out.
CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in hit.split(".")),
            "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()


def base(text):
    return [(k, m.start(), m.end()) for k, p in CONTRACT.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def row(doc_id, text):
    spans = base(text)
    sha = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    return (doc_id, *[sum(s[0] == k for s in spans) for k in CONTRACT], sha)


def check(got, rows):
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((row(i, t) for i, t in rows), key=repr)
    by_text = {}
    for i, t in rows:
        by_text.setdefault(i, []).append(t or "")
    for r in got:
        listed = [tuple([k, int(a), int(b)]) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        order = list(CONTRACT)
        assert listed == sorted(listed, key=lambda s: (order.index(s[0]), s[1]))
        assert any(set(base(t)) <= set(listed) and all(0 <= a < b <= len(t) for _, a, b in listed)
                   for t in by_text[r.doc_id])


TRICKY = [
    "a@b.c-d%x@y.z.w, .@x.y a.b@c..d a@b @b.c x@y.z@u.v",
    "1.2.3.4.5.6.7 01.002.0003.255 256.1.1.1 1.1.1.00000000000000000000255 999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 4111  1111 0000000000000000 1 2 3",
    "+1 (414) 555-7134 +12 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 +49 (0) 30 1234567) ++4930123456",
    "é😀 a@b.cd 😀😀 +1 (414) 555-7134é4111111111111111 10.0.0.1",
    "4" * 5000 + " " + "a" * 5000 + "@" + "b.c" * 2000,
    "+" + "1 " * 4000 + "1.2" * 3000 + "- -" * 300,
    "1" + " 1" * 6000,
]


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet(f"{SF01}/documents.parquet"))


def test_query_by_brute_force(spark):
    got = op5_pii(spark, SF001).collect()
    check(got, texts(SF001))
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got) > 0


def test_tricky_and_random_texts(spark, model):
    rnd = random.Random(8)
    noise = ["".join(rnd.choice("ab1.2@+-( )5_%é") for _ in range(rnd.randrange(60))) for _ in range(400)]
    rows = list(enumerate(TRICKY + noise))
    check(pii.personal_data(docs(spark, rows), model).collect(), rows)


def test_awkward_rows(spark, model):
    check(pii.personal_data(docs(spark), model).collect(), AWKWARD)
    check(pii.personal_data(docs(spark)).collect(), AWKWARD)
    assert pii.personal_data(empty(spark)).count() == 0
    assert pii.redact(empty(spark)).count() == 0


def test_no_python_on_the_main_path(spark, model):
    plan = pii.personal_data(docs(spark), model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_added_spans_look_like_confirmed_ones(spark, model):
    """Wider forms are added; a clean text gets nothing."""
    rows = [(0, "write to jon(at)example.com today"), (1, "the year 1999 and 12 to 14 of 2001, 3.5 and 1.2.3"),
            (2, "word 4111.1111.1111.1111 word"), (3, "plain words only")]
    got = {r.doc_id: r.spans for r in pii.personal_data(docs(spark, rows), model).collect()}
    assert got[0].startswith("email:9:") and got[1] == "" and got[3] == ""


def test_redaction_takes_out_every_span(spark, model):
    rows = list(enumerate(TRICKY[:5])) + [(9, None), (10, ""), (11, "clean"), (12, "+1 (414) 555-7134")]
    d = docs(spark, rows)
    got = pii.redact(d, model)
    assert got.columns == d.columns
    out = {r.doc_id: r.text for r in got.collect()}
    assert out[9] is None and out[10] == "" and out[11] == "clean" and out[12] == "[PHONE]"
    for i, t in rows[:5]:
        cover = np.zeros(len(t) + 1, bool)
        for _, a, b in base(t):
            cover[a:b] = True
        left = iter(out[i])  # what was not covered is still there, in order
        assert all(c in left for c, hid in zip(t, cover) if not hid and c not in "[]ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        assert not any(t[a:b] in out[i] for _, a, b in base(t))


def made(plain, wide, other=()):
    """Documents of one find each: plain forms, wider ones, other ones."""
    return [(i, f"words before {t} and after") for i, t in enumerate([*plain, *wide, *other])]


@pytest.mark.parametrize(("n_plain", "n_wide"), [(1000, 50), (1000, 600), (0, 600), (50, 600)])
def test_a_frequent_wide_form_is_added(spark, n_plain, n_wide):
    """How common a form is does not decide; neither do plain ones beside it."""
    cases = {
        "email": (made([f"write to p{i}@example.com" for i in range(n_plain)],
                       [f"write to p{i}(at)example.com" for i in range(n_wide)])),
        "phone": (made([f"phone +49 30 {5550000 + i}" for i in range(n_plain)],
                       [f"phone 030 {5550000 + i}" for i in range(n_wide)],
                       [f"numbers {i % 80 + 10} {i % 70 + 20} {i % 60 + 30} 41 52" for i in range(400)])),
    }
    for kind, rows in cases.items():
        d = docs(spark, rows)
        got = {r.doc_id: r.spans for r in pii.personal_data(d, pii.fit(d)).collect()}
        assert sum(got[i].startswith(kind + ":") for i in range(n_plain + n_wide)) == n_plain + n_wide
        assert not any(got[i] for i in range(n_plain + n_wide, len(rows)))


def test_bracketed_addresses_need_no_cue_and_numbers_do(spark):
    rows = made([f"p{i}@example.com" for i in range(300)], [f"p{i}[at]example.com" for i in range(300)],
                [f"{i % 80 + 10} {i % 70 + 20} {i % 60 + 30} 41 52" for i in range(600)])
    d = docs(spark, rows)
    got = {r.doc_id: r.spans for r in pii.personal_data(d, pii.fit(d)).collect()}
    assert all(got[i].startswith("email:") for i in range(600)) and not any(got[i] for i in range(600, 1200))


def test_boosted_trees_learn_a_grid():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (300, 3))
    y = (x[:, 0] == 1) ^ (x[:, 1] == 2)
    bias, trees = boosting.fit(x, y * 5.0, ~y * 5.0, rounds=30)
    p = boosting.predict(bias, trees, x)
    assert ((p > 0.5) == y).all()
    assert boosting.threshold(p, y * 1.0, ~y * 1.0, 1.0) == pytest.approx(p[y].min())
    assert boosting.threshold(np.array([0.2, 0.9]), np.array([1.0, 0.0]), np.array([0.0, 9.0]), 0.9) > 1


def test_twenty_thousand_matches_in_one_text(spark):
    """The work follows the number of matches: spans of a long log in seconds, all places right."""
    import time
    n = 20_000
    text = " ".join(f"10.{i % 250}.{i // 250 % 250}.7" for i in range(n))
    took = time.time()
    got = pii.personal_data(docs(spark, [(1, text), (2, "a@b.org")]), model=pii.Model()).where("doc_id = 1").first()
    took = time.time() - took
    assert tuple(got)[:6] == row(1, text) and got["n_ip"] == n and took < 40


def test_sample_is_written_before_candidates_are_made(spark, monkeypatch):
    from metalake.llm import pii
    seen = []
    monkeypatch.setattr(pii, "candidates", lambda spans, *c, made=pii.candidates: seen.append(
        spans._jdf.queryExecution().analyzed().toString()) or made(spans, *c))
    pii.fit(docs(spark), sample_docs=5)
    assert len(seen) == 1 and "xxhash64" not in seen[0]


def test_model_counts_the_candidates_of_every_document(spark, monkeypatch):
    """More documents than the bound of the former sample: every candidate counts."""
    n, seen = 21_000, []
    monkeypatch.setattr(pii, "shares", lambda x, covered, free, made=pii.shares: seen.append(
        (covered.sum(), free.sum())) or made(x, covered, free))
    d = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("write to p"), "id", F.lit("@example.com")).alias("text"))
    pii.fit(d)
    assert seen == [(n, 0)]
