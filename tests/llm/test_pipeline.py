from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from conftest import SF001
from helpers import texts
from test_packing import check
from test_pii import base
from test_simhash import brute_fp, components

from metalake.llm.toxicity import score_toxicity


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "pii", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_by_brute_force(spark, tmp_path):
    """Each stage is held against a plain version over what its predecessor kept."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, steps[-1], SF001)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        steps.append(spark.read.parquet(f"{tmp_path}/{name}"))
    rows = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in steps]
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    toxic = {r.doc_id for r in score_toxicity(docs, labels).collect() if r.predicted}
    assert rows[1] == {i: t for i, t in rows[0].items() if i not in toxic}
    largest = {}
    for i, t in rows[1].items():
        key = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        largest[key] = max(i, largest.get(key, i))
    assert set(rows[2]) == set(largest.values())
    fps = {i: brute_fp(t) for i, t in rows[2].items()}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    assert set(rows[3]) == {min(c) for c in components(pairs, list(fps))}
    assert all(rows[3][i] == rows[0][i] for i in rows[3])
    assert set(rows[4]) == set(rows[3])
    for i, t in rows[4].items():
        old = rows[3][i]
        assert (t == old) or base(old) and not any(old[a:b] in t for _, a, b in base(old))
        assert t == old or re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", t)
    pieces = corpus_pipeline.run(spark, SF001).collect()
    check(pieces, list(rows[4].items()), 0.99)
    assert Counter(p.doc_id for p in pieces).keys() == rows[4].keys() < {i for i, _ in texts(SF001)}
