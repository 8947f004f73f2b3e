"""H3-H6: golden run signatures, checkpoint ledger, page chains, totals."""

from __future__ import annotations

import base64
import json
import os

import pytest
from pyspark.sql import functions as F

from metalake.operators.ledger import (chain_order, chain_order_problems, decoded_cursor, expected_vs_harvested,
                                       page_chain_problems, read_checkpoints, run_ledger, signature_hash, signature_hash_col)

# Golden samples: the filter objects of three real runs and the 12-hex hash
# their checkpoint files are named after.
GOLDEN = [
    ({"query": 'types.resourceType:"None"', "from-registered-date": "1800-01-01",
      "until-registered-date": "2025-11-07"}, "33910056c42f", None),
    ({"resource-type-id": "preprint", "from-registered-date": "1800-01-01",
      "until-registered-date": "2025-11-07"}, "62d83c9f1411",
     "MTY0NTQxMTc4NDAwMCwxMC40ODU1MC9hcnhpdi4yMTA5LjA4MDQz"),
    ({"query": 'types.resourceType:"preprint"', "from-registered-date": "1800-01-01",
      "until-registered-date": "2025-11-07"}, "f4ac0c8f096a", None),
]


@pytest.mark.parametrize("sig,h,_", GOLDEN)
def test_signature_hash_python(sig, h, _):
    noisy = {**sig, "page[size]": 1000, "page[cursor]": "1", "disable-facets": "true", "client-id": None}
    assert signature_hash(noisy) == h


def test_signature_hash_column(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in GOLDEN], "m map<string,string>")
    assert [r[0] for r in df.select(signature_hash_col("m")).collect()] == [h for _, h, _ in GOLDEN]


def test_run_ledger_on_golden_files(spark, tmp_dir):
    d = os.path.join(tmp_dir, "1800-01-01_2025-11-07", "checkpoints_preprints")
    os.makedirs(d)
    for sig, h, cur in GOLDEN:
        with open(os.path.join(d, f"checkpoint_{h}.json"), "w") as fh:
            json.dump({"signature": sig, "next_cursor": cur, "saved_at": "2025-11-07T20:57:06+00:00"},
                      fh, indent=2)
    led = {r["hash_in_name"]: r.asDict() for r in run_ledger(read_checkpoints(spark, d)).collect()}
    assert set(led) == {h for _, h, _ in GOLDEN}
    assert all(r["hash_ok"] for r in led.values())
    open_run = led["62d83c9f1411"]
    assert not open_run["finished"] and led["f4ac0c8f096a"]["finished"]
    assert open_run["cursor_decoded"] == "1645411784000,10.48550/arxiv.2109.08043"
    assert open_run["date_field"] == "registered"
    assert (open_run["date_from"], open_run["date_until"]) == ("1800-01-01", "2025-11-07")
    assert (open_run["folder_start"], open_run["folder_end"]) == ("1800-01-01", "2025-11-07")


def test_page_chain(spark):
    pages = spark.createDataFrame([
        ("p", 1, 2), ("p", 2, 4), ("p", 4, None),   # gap: 2 -> 4 fine, but 4 exists; no gap
        ("q", 1, 3), ("q", 2, None), ("q", 3, 2),   # 1 -> 3 ok, 3 -> 2 not advancing, two ends? no
        ("r", 1, 5), ("r", 2, None), ("r", 3, None),  # gap (5 missing), two open ends
    ], "g string, cursor int, next_cursor int")
    got = sorted((r["g"], r["problem"]) for r in page_chain_problems(pages, "g").collect())
    assert got == [("q", "not_advancing"), ("r", "gap"), ("r", "open_end")]


def test_expected_vs_harvested(spark):
    exp = spark.createDataFrame([("a", 3), ("b", 1)], "k string, expected long")
    got = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    out = {r["k"]: (r["expected"], r["harvested"], r["missing"], r["complete"])
           for r in expected_vs_harvested(exp, got, "k").collect()}
    assert out == {"a": (3, 2, 1, False), "b": (1, 1, 0, True), "c": (0, 1, -1, False)}


def test_cursor_decode_invalid_is_null(spark):
    df = spark.createDataFrame([("!!not base64!!",), ("/////w==",), ("MTAsYQ==",), (None,)], "c string")
    assert [r[0] for r in df.select(decoded_cursor(F.col("c"))).collect()] == [None, None, "10,a", None]


def test_base64_cursors_are_ordered_by_their_number(spark):
    def cur(n, doi):
        return base64.b64encode(f"{n},{doi}".encode()).decode()
    pages = spark.createDataFrame([
        ("a", "1", cur(9, "10.1/z")), ("a", cur(9, "10.1/z"), cur(10, "10.1/a")), ("a", cur(10, "10.1/a"), None),
        ("b", cur(10, "10.1/a"), cur(9, "10.1/z")), ("b", cur(9, "10.1/z"), None),
        ("c", cur(5, "10.1/a"), cur(5, "10.1/b")), ("c", cur(5, "10.1/b"), cur(7, "10.1/x")),
    ], "g string, cursor string, next_cursor string")
    got = sorted((r["g"], r["problem"]) for r in page_chain_problems(pages, "g").collect())
    assert got == [("b", "not_advancing"), ("c", "gap")]


def chain(spark, links, kind="long"):
    return spark.createDataFrame(links, f"run string, cursor {kind}, next_cursor {kind}")


def placed(df):
    return {(r["run"], r["cursor"]): (r["position"], r["on_cycle"]) for r in df.collect()}


def test_whole_chain_order(spark):
    links = ([("long", i, i + 1) for i in range(99)] + [("long", 99, None)]
             + [("ring", 1, 2), ("ring", 2, 3), ("ring", 3, 1)] + [("self", 5, 5)]
             + [("branch", 1, 3), ("branch", 2, 3), ("branch", 3, 4), ("branch", 4, None)]
             + [("broken", 1, 2), ("broken", 2, 70), ("broken", 7, 8), ("broken", 8, None)]
             + [("rho", 1, 2), ("rho", 2, 3), ("rho", 3, 2)] + [("twice", 1, 2), ("twice", 1, 2), ("twice", 2, None)]
             + [(None, 1, 2), (None, 2, None)] + [("first", None, 4), ("first", 4, None)])
    got = placed(chain_order(chain(spark, links), "run"))
    assert [got["long", i] for i in range(100)] == [(i, False) for i in range(100)]
    assert [got["ring", i] for i in (1, 2, 3)] == [(0, True), (1, True), (2, True)] and got["self", 5] == (0, True)
    assert [got["branch", i][0] for i in (1, 2, 3, 4)] == [0, None, 1, 2]
    assert [got["broken", i][0] for i in (1, 2, 7, 8)] == [0, 1, None, None]
    assert [got["rho", i] for i in (1, 2, 3)] == [(0, False), (1, True), (2, True)]
    assert [got["twice", i][0] for i in (1, 2)] == [0, 1] and [got[None, i][0] for i in (1, 2)] == [0, 1]
    assert got["first", None] == (0, False) and got["first", 4] == (1, False)
    problems = {tuple(r) for r in chain_order_problems(chain(spark, links), "run").collect()}
    assert {(r, c, p) for r, c, _, p in problems if r == "branch"} == {("branch", 2, "unreachable"), ("branch", 1, "doubled_link")}
    assert {(r, c, p) for r, c, _, p in problems if r == "rho"} == {("rho", 2, "cycle"), ("rho", 3, "cycle"), ("rho", 1, "doubled_link")}
    assert not [p for p in problems if p[0] in ("long", "twice", None, "first")]
    assert chain_order(chain(spark, []), "run").count() == 0


def test_chain_of_text_cursors(spark):
    names = [base64.b64encode(f"{n},10.1/x".encode()).decode() for n in (9, 10, 200)]
    got = placed(chain_order(chain(spark, list(zip("rrr", names, names[1:] + [None])), "string"), "run"))
    assert [got["r", n][0] for n in names] == [0, 1, 2]
