from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF001
from helpers import AWKWARD, docs, empty, texts

from metalake.llm.queries import op13_spelling_variants
from metalake.llm.spelling import neighbours, spelling_variants

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def words_of(rows):
    n = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    form, out = {}, []
    for w, n in words.items():
        found = [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, []) if near(w, v)]
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
        out.append([w, form[w], w, n, len(found), words[best] if form[w] else None])
    for r in out:
        while form[r[2]]:
            r[2] = form[r[2]]
    return sorted(map(tuple, out))


def got(df):
    return sorted(map(tuple, df.collect()))


def test_query_by_brute_force(spark):
    result = op13_spelling_variants(spark, SF001)
    assert result.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"),
                             ("form_n", "bigint")]
    want = brute(words_of(texts(SF001)))
    assert got(result) == want and any(r[4] for r in want)


def test_awkward_rows(spark):
    rows = AWKWARD + [(20, "Ångström ångström Ångströn ångström ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿ ÿÿÿÿÿÿ× aaaaaaaa AAAAAAAA aaaaaaa aaaaaaa"),
                      (21, "x" * 5000), (22, "x" * 5000 + " " + "x" * 4999 + " " + "x" * 4999), (None, "sevenes sevenes sixsix sixsix")]
    want = brute(words_of(rows))
    assert got(spelling_variants(docs(spark, rows))) == want
    assert any(len(r[0]) > 4000 and r[4] for r in want)


def test_forms_are_followed_to_the_root(spark):
    rows = [(i, " ".join(["spelling"] * 2000 + ["speling"] * 150 + ["spelingg"] * 9 + ["spellling"] * 3 + ["different"] * 5))
            for i in (1, 2)]
    want = brute(words_of(rows))
    assert got(spelling_variants(docs(spark, rows))) == want
    chain = {r[0]: r for r in want}
    assert chain["spelingg"][1:3] == ("speling", "spelling") and chain["different"][1:3] == (None, "different")


def test_empty_table(spark):
    assert spelling_variants(empty(spark)).count() == 0
    assert got(spelling_variants(docs(spark, [(1, None), (2, "")]))) == []


@pytest.mark.parametrize("literal", [64, 3])
def test_neighbours_once_each(spark, literal):
    """Over two letters runs of equal ones abound; also with hashed prefixes."""
    rnd = random.Random(9)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 9))) for _ in range(300)})
    pairs = [tuple(r) for r in neighbours(spark.createDataFrame([(w, len(w)) for w in words], "word string, n long"), literal).collect()]
    assert sorted(pairs) == sorted((a, b, len(b)) for a in words for b in words if near(a, b))
