"""Scalar column functions against the edge cases of the source pipeline."""

from __future__ import annotations

import html

import pytest
from pyspark.sql import functions as F

from metalake.functions import (canon, canon_or, doi_prefix, first_truthy, html_unescape,
                                infer_provider, norm_date, python_sorted_json, query_param, strip,
                                year_from_iso)


def _eval(spark, expr_fn, values, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr_fn(F.col(df.columns[0]))).collect()]


NORM_DATE_CASES = [
    ("2024-07-15T23:30:00-05:00", "2024-07-15"),
    ("2024", "2024"),
    ("2024-05", "2024-05"),
    ("2024-13-45T00:00:00Z", "2024-13-45"),
    ("20240715T101010Z", "2024-07-15"),
    ("20240715", "2024-07-15"),
    ("2024-W03-1", "2024-01-15"),
    ("2024W031", "2024-01-15"),
    ("2024-W03", "2024-01-15"),
    ("2020-W53-5", "2021-01-01"),
    ("2021-W53-1", "2021-W53-1"),
    ("07/15/2024 10:00", "07/15/2024"),
    ("2024-07-15 10:00", "2024-07-15"),
    ("00010101T24:00:00", "00010101T2"),
    ("20240101x1030", "2024-01-01"),
    ("20240101T10:3000", "20240101T1"),
    ("00000101", "00000101"),
    ("2024-W031", "2024-W031"),
    ("0348W541", "0348W541"),
    ("", None),
    (None, None),
]


def test_norm_date(spark):
    got = _eval(spark, norm_date, [c[0] for c in NORM_DATE_CASES])
    assert got == [c[1] for c in NORM_DATE_CASES]


def test_norm_date_more_forms(spark):
    cases = {"2019-02-28T00:00:00Z": "2019-02-28", "2019-02-29T00:00:00Z": "2019-02-29", "20190229": "20190229",
             "20200229T000000": "2020-02-29", "2019-W01-1": "2018-12-31", "2019-W52-7": "2019-12-29",
             "1999-12-31T23:59:59.999999+14:00": "1999-12-31", "abc": "abc", "2019-1-1": "2019-1-1"}
    assert _eval(spark, norm_date, list(cases)) == list(cases.values())


def test_prefix_rules(spark):
    df = spark.createDataFrame([("", "10.1/a/b"), (None, "abc"), ("10.9", "10.1/a"), (None, None)],
                               "p string, d string")
    assert [r[0] for r in df.select(doi_prefix("p", "d")).collect()] == ["10.1", None, "10.9", None]


def test_provider_rules(spark):
    df = spark.createDataFrame([
        (None, None, "cern.zenodo"),   # inferred from client
        (None, None, "cern"),          # no dot -> NULL
        (None, "", "cern"),            # "" stays ""
        (None, "prov", "cern.zenodo"),  # attribute wins
        ("rel", "prov", "x.y"),        # relationship wins
        (None, "", "a.b"),             # "" falls through to the client
    ], "r string, a string, c string")
    got = [r[0] for r in df.select(infer_provider("r", "a", "c")).collect()]
    assert got == ["cern", None, "", "prov", "rel", "a"]


def test_first_truthy(spark):
    df = spark.createDataFrame([("", None), (None, ""), ("a", "b"), ("", "b")], "a string, b string")
    assert [r[0] for r in df.select(first_truthy("a", "b")).collect()] == [None, "", "a", "b"]


def test_strip_matches_python(spark):
    vals = ["  a ", "\t\nb\r", " c　", "\x1cd\x1f", "e", "", None]
    assert _eval(spark, strip, vals) == [v.strip() if v is not None else None for v in vals]


def test_year_from_iso(spark):
    assert _eval(spark, year_from_iso, ["2024-07-15", "n.d.", "202", "1999", None, "２０２４-01"]) == \
        ["2024", None, None, "1999", None, "２０２４"]


def test_query_param(spark):
    urls = [
        "https://api.example.org/dois?page%5Bcursor%5D=XY%3D%3D&page%5Bsize%5D=1000",
        "https://h/x?page[cursor]=abc&page[cursor]=def",
        "https://h/x?page[cursor]=&other=1",
        "https://h/x#page[cursor]=no",
        "https://h/x?a=1+2&page[cursor]=c%2Bd+e",
        None,
    ]
    got = _eval(spark, lambda c: query_param(c, "page[cursor]"), urls)
    assert got == ["XY==", "abc", None, None, "c+d e", None]


def test_canon_sorted_and_null_rules(spark):
    df = spark.createDataFrame([('{"x": {"b": 1, "a": {"z": 2, "y": 3}}, "n": null, "e": [], "s": ""}',)],
                               "raw string").select(F.parse_json("raw").alias("v"))
    r = df.select(canon("v", "$.x").alias("x"), canon("v", "$.n").alias("n"),
                  canon("v", "$.e").alias("e"), canon("v", "$.missing").alias("m"),
                  canon_or("v", "$.e", "{}").alias("e2"), canon_or("v", "$.s", "[]").alias("s2"),
                  canon_or("v", "$.x", "{}").alias("x2")).collect()[0]
    assert r["x"] == '{"a":{"y":3,"z":2},"b":1}'
    assert r["n"] is None and r["m"] is None
    assert r["e"] == "[]"
    assert r["e2"] == "{}" and r["s2"] == "[]" and r["x2"] == r["x"]


def test_html_unescape_matches_python(spark):
    vals = ["A &amp; B", "&lt;i&gt;x&lt;/i&gt;", "caf&eacute; &#233; &#x27;", "&amp", "no entities",
            "&bogus;", None]
    assert _eval(spark, html_unescape, vals) == [html.unescape(v) if v else v for v in vals]


@pytest.mark.parametrize("sig,expected", [
    ({"from-registered-date": "1800-01-01", "resource-type-id": "preprint",
      "until-registered-date": "2025-11-07"},
     '{"from-registered-date": "1800-01-01", "resource-type-id": "preprint", '
     '"until-registered-date": "2025-11-07"}'),
    ({"query": 'a "b"', "x\\y": "1"}, '{"query": "a \\"b\\"", "x\\\\y": "1"}'),
])
def test_python_sorted_json(spark, sig, expected):
    import json
    df = spark.createDataFrame([(sig,)], "m map<string,string>")
    assert df.select(python_sorted_json("m")).collect()[0][0] == expected
    assert json.dumps(sig, sort_keys=True, ensure_ascii=False) == expected
