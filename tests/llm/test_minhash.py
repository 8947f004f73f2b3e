from __future__ import annotations

import random
import re

import numpy as np
from conftest import SF001
from helpers import AWKWARD, docs, empty, texts
from pyspark.sql import functions as F

from metalake.llm import minhash
from metalake.llm.common import sieved
from metalake.llm.minhash import (forest, hash_family, least_agreeing, minhash_groups, overlaps, shingles, signature,
                                   signatures)
from metalake.llm.queries import op12_minhash_near_dedup


def brute(rows, size=2, share=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]
    return sorted(((d, n, c, None if d is None or c is None else d == c) for d, n, c in out), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_by_brute_force(spark):
    result = op12_minhash_near_dedup(spark, SF001)
    assert dict(result.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}
    assert got(result) == brute(texts(SF001))


def test_awkward_rows(spark):
    assert got(minhash_groups(docs(spark), 2)) == brute(AWKWARD)
    assert got(minhash_groups(docs(spark))) == brute(AWKWARD, 5)


def test_empty_table(spark):
    assert minhash_groups(empty(spark), 2).count() == 0
    assert got(minhash_groups(docs(spark, [(1, None), (2, ""), (3, "  ")]), 2)) == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def variants(seed, n, edits):
    """Texts from one template with a few words replaced."""
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rnd.randrange(edits)):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(400)}"
        out.append((1000 + i, " ".join(words)))
    return out


def test_group_around_the_threshold(spark, monkeypatch):
    """Similarities on both sides of the threshold, in several blocks a bucket."""
    rows = variants(1, 240, 26)
    random.Random(2).shuffle(rows)
    links = minhash.block_links
    sizes = []

    def small_blocks(*a, **kw):
        found = links(*a, **kw | {"block": 16})
        sizes.append(found.count())
        return found
    monkeypatch.setattr(minhash, "block_links", small_blocks)
    want = brute(rows)
    assert got(minhash_groups(docs(spark, rows), 2)) == want
    assert len({c for _, _, c, _ in want}) > 3 and sizes and sizes[0] < 240


def test_chain_of_links(spark):
    """Every text links with the next only."""
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i:6 * i + 100])) for i in range(40)]
    assert {c for _, _, c, _ in brute(rows)} == {0}
    assert got(minhash_groups(docs(spark, rows), 2)) == brute(rows)


def test_signatures_estimate_similarity():
    a, b = hash_family(512, 3)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, 1000, np.uint64)
    y = np.concatenate((x[:800], rng.integers(0, 1 << 32, 200, np.uint64)))
    share = (signature(x, a, b) == signature(y, a, b, step=7)).mean()
    assert abs(share - 800 / 1200) < 0.1
    assert least_agreeing(128, 80) < 128 * 0.8


def test_overlaps_in_steps():
    rnd = random.Random(5)
    left, right = ([shingles([b"%d" % rnd.randrange(40) for _ in range(60)], 2) for _ in range(n)] for n in (9, 5))
    assert overlaps(left, right, step=17).tolist() == [[len(x & y) for y in right] for x in left]


def test_forest_joins_what_the_links_join():
    assert forest([(1, 2), (2, 3), (3, 1), (4, 5), (5, 4), (3, 5)]) == [(1, 2), (2, 3), (4, 5), (3, 5)]


def test_words_of_strangers_are_not_shuffled(spark):
    """Only rows that met another one, and few others, pass the sieve before the exact join."""
    rows = spark.range(20_000).select(F.col("id").alias("row"), F.lit("words").alias("words"))
    wanted = spark.range(0, 20_000, 40).select(F.col("id").alias("row"))
    passed = {r.row for r in sieved(rows, wanted, "row").collect()}
    assert set(range(0, 20_000, 40)) <= passed and len(passed) < 520
    assert sieved(rows, wanted, "row").columns == ["row", "words"]
    assert sieved(rows, wanted.where("row < 0"), "row").count() == 0
    assert sieved(rows, wanted, "row", bits=1).count() == 20_000


def test_signatures_are_kept_small(spark):
    got = signatures(docs(spark, [(1, "a b c d"), (2, "a b c d"), (3, "e f g")]), 2, 32, 128, 1).collect()
    assert [len(r.bands) + len(r.signature) for r in got] == [32 * 6 + 128] * 3
    assert got[0].bands == got[1].bands and got[0].signature == got[1].signature
    bands = [{r.bands[i:i + 6] for i in range(0, 192, 6)} for r in got]
    assert not bands[0] & bands[2]


def test_settled_buckets_are_not_joined_again(spark, monkeypatch):
    """Copies but for a word: the first links settle their buckets, and components are sought once."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base, f"e{i}"])) for i in range(12)]
    calls, components = [], minhash.connected_components
    monkeypatch.setattr(minhash, "connected_components", lambda found: calls.append(1) or components(found))
    assert got(minhash_groups(docs(spark, rows), 2)) == brute(rows)
    assert len(calls) == 1


def test_rows_are_sieved_before_they_are_shuffled(spark):
    """Where the wanted rows are too many to be broadcast, the exact join comes after the sieve."""
    rows = spark.range(2000).select(F.col("id").alias("row"), F.lit("words").alias("words"))
    met = spark.createDataFrame([(i,) for i in range(0, 2000, 40)], "row long")
    before = {c: spark.conf.get(c, None) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for c in before:
            spark.conf.set(c, "-1")
        kept = minhash.near_rows(rows, met)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
        assert sorted(r.row for r in kept.collect()) == list(range(0, 2000, 40)) and kept.columns == ["row", "words"]
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
