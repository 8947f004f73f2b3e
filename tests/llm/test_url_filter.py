from __future__ import annotations

import math
import re
from collections import Counter

import oracle
import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from metalake.llm.queries import ORACLE, QUERIES, RULES
from metalake.llm.url_filter import host_reputation, judge_urls, parse_rules

SCHEMA = "page_id long, url string, html string, host string, good int, n int, mean double"
ROWS = [(1, "https://A.Example.ORG/es/1?x=/en/1", 1, 1), (2, "http://example.org/en/15#a", 0, 1), (3, "ftp://org/x", None, None),
        (4, "http://notexample.org/es/", 1, 1), (5, "http://m.x.com/fr/?q", 0, 1), (6, "http://com/de/", 0, 0),
        (7, None, 1, 1), (8, "no scheme", None, None), (9, "://", None, None), (10, "http://x.org", 1, 1),
        (11, "http://x.org?/es/", 1, 1), (12, "a://b://c.org/z", 1, 1), (13, "HTTP://ÉX.Org:80/é", 1, 1),
        (13, "HTTP://ÉX.Org:80/é", 1, 1), (None, "http://y.net/\nz", 0, 1)]
WANT = {1: ("a.example.org", "/es/1", "example.org/es/"), 2: ("example.org", "/en/15", "example.org/en/1"),
        3: ("org", "/x", "org/"), 4: ("notexample.org", "/es/", "org/"), 5: ("m.x.com", "/fr/", "com/fr/"),
        6: ("com", "/de/", "com/de/"), 7: ("", "", None), 8: ("", "", None), 9: ("", "", None), 10: ("x.org", "", None),
        11: ("x.org", "", None), 12: ("b:", "//c.org/z", None), 13: ("Éx.org:80", "/é", None), None: ("y.net", "/\nz", None)}


def table(spark, rows=ROWS):
    return spark.createDataFrame([(i, u, None, "clash", g, n, 1.0) for i, u, g, n in rows], SCHEMA)


def test_hosts_paths_and_rules(spark):
    got = judge_urls(table(spark), parse_rules(RULES), F.col("good"), F.col("n")).collect()
    assert Counter(r.page_id for r in got) == Counter(i for i, *_ in ROWS)
    for r in got:
        assert (r.host, r.path, r.rule) == WANT[r.page_id]
        if r.rule:
            assert r.verdict == dict((t, v) for v, t in RULES)[r.rule]
        else:
            assert r.verdict in ("allow", "block")
    assert judge_urls(table(spark, []), parse_rules(RULES), F.col("good"), F.col("n")).count() == 0


def brute(counts, z=1.645, most=10_000.0):
    """The hierarchy in plain Python: {host: lower bound}."""
    def names(h):
        return h.split(".")[-1], ".".join(h.split(".")[-2:]), h
    total = [sum(x) for x in zip(*counts.values())]
    prior = {(): (total[0] + 1) / (total[1] + 2)}
    for depth in range(3):
        groups = {}
        for h, (g, n) in counts.items():
            key = names(h)[:depth + 1]
            a = groups.setdefault(key, [0, 0])
            a[0] += g
            a[1] += n
        over = under = 0.0
        for key, (g, n) in groups.items():
            p = prior[key[:-1]] if depth else prior[()]
            over += n * (g / n - p) ** 2 - p * (1 - p) if n else 0
            under += (n - 1) * p * (1 - p) if n > 1 else 0
        rho = over / under if under else 0
        m = most if rho <= 1 / (most + 1) else max(1.0, 1 / rho - 1)
        mean, low = {}, {}
        for key, (g, n) in groups.items():
            p = prior[key[:-1]] if depth else prior[()]
            a, b = p * m + g, (1 - p) * m + n - g
            mean[key] = a / (a + b)
            low[key[-1]] = a / (a + b) - z * math.sqrt(a * b / (a + b + 1)) / (a + b)
        prior = mean
    return low


def test_reputation_by_brute_force(spark):
    counts = {f"{h}.{d}.{s}": ((i * 7) % 11 * (1 if d == "good" else 0) + i % 3, 12 + (i * 7) % 11 - 3)
              for i, (h, d, s) in enumerate((h, d, s) for h in "abcde" for d in ("good", "bad") for s in ("org", "net"))}
    counts = {h: (min(g, n), n) for h, (g, n) in counts.items()} | {"new.good.org": (0, 0), "x": (0, 0)}
    rows = spark.createDataFrame([(h, g, n) for h, (g, n) in counts.items()], "host string, good int, n int")
    got = {r.host: r.lower for r in host_reputation(rows).collect()}
    assert got == pytest.approx(brute(counts))
    assert got["a.bad.net"] < got["new.good.org"]


def test_bad_hosts_are_blocked_and_good_ones_stay(spark):
    rows = [(i, f"http://{'bad' if i % 2 else 'good'}.site{i % 2}.net/{i}", int(i % 2 == 0), 1) for i in range(200)]
    got = {(r.host, r.verdict) for r in judge_urls(table(spark, rows), [], F.col("good"), F.col("n")).collect()}
    assert got == {("bad.site1.net", "block"), ("good.site0.net", "allow")}


@pytest.mark.parametrize("name,sf", [("op10_url_filter", SF01), ("op9_exact_dedup", SF001)])
def test_queries_match_their_sql(spark, name, sf):
    con = oracle.duck(sf)
    df = QUERIES[name](spark, sf)
    assert oracle.type_mismatches(df, con, ORACLE[name]) == {}
    report = oracle.compare(df, con, ORACLE[name])
    assert report["ok"] and re.search("page|doc", " ".join(df.columns)), report
