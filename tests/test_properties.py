"""Property tests: column functions and D1 against plain-Python references
on generated inputs (each example is evaluated as one Spark job)."""

from __future__ import annotations

import json
from urllib.parse import quote, quote_plus

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metalake.functions import canon, norm_date, query_param, strip
from metalake.operators.dedup import dedup_richest

# Each example is one Spark job, so no shrinking: a failure prints the whole
# generated batch.
SETTINGS = settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate],
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def _col(spark, values, fn, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {type_}")
    return [r[1] for r in df.select("i", fn(F.col("s"))).orderBy("i").collect()]


# ---------------------------------------------------------------- norm_date
# Each text is written from a known date (or is known to be none), so the
# expected value comes from how it was made.

days = st.dates()
clock = st.sampled_from(["", "T10:20:30Z", " 23:59", "T00:00:00.123456+02:00", "T05:06-0530"])
date_case = st.one_of(
    st.builds(lambda d, t: (d.isoformat() + t, d.isoformat()), days, clock),
    st.builds(lambda d, t: (d.isoformat().replace("-", "") + t, d.isoformat()), days,
              st.sampled_from(["", "T102030Z", "T10", "T1020+0530"])),
    # the calendar day of an ISO week date is the day it was taken from
    st.builds(lambda d, sep: ("{0:04d}{3}W{1:02d}{3}{2}".format(*d.isocalendar(), sep), d.isoformat()),
              days.filter(lambda d: 1 < d.year < 9999), st.sampled_from(["-", ""])),
    # incomplete or impossible dates stay text, cut after ten characters
    st.builds(lambda d: (d.isoformat()[:7], d.isoformat()[:7]), days),
    st.builds(lambda d: (d.isoformat()[:4], d.isoformat()[:4]), days),
    st.builds(lambda y, t: (f"{y:04d}-13-40{t}", f"{y:04d}-13-40"), st.integers(1, 9999), clock),
    st.builds(lambda y: (f"{y:04d}W541", f"{y:04d}W541"), st.integers(1, 9999)),
    st.text(alphabet="/.:abc xyz", min_size=1, max_size=14).map(lambda t: (t, t[:10])),
    st.sampled_from([("", None), (None, None)]),
)


@SETTINGS
@given(st.lists(date_case, min_size=20, max_size=60))
def test_norm_date_property(spark, cases):
    assert _col(spark, [t for t, _ in cases], norm_date) == [want for _, want in cases]


# --------------------------------------------------------------------- canon

json_scalar = st.one_of(st.none(), st.booleans(), st.integers(-10**12, 10**12),
                        st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=8))
json_value = st.recursive(json_scalar, lambda inner: st.one_of(
    st.lists(inner, max_size=4), st.dictionaries(st.text(max_size=5), inner, max_size=4)), max_leaves=12)


@SETTINGS
@given(st.lists(json_value, min_size=10, max_size=40))
def test_canon_property(spark, values):
    texts = [json.dumps(v) for v in values]
    got = _col(spark, texts, lambda c: canon(F.try_parse_json(c), "$"))
    want = [None if v is None else json.dumps(v, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
            for v in values]
    assert got == want


# --------------------------------------------------------------- query_param
# A link is written from a list of pairs; the expected value is the first
# pair of the asked name that has a value.

names = st.sampled_from(["page[cursor]", "page[size]", "a", "x y", "é&="])
values = st.sampled_from(["", "1", "XY==", "a b+c", "ü/?#&", "%41"])
pair_list = st.lists(st.tuples(names, values, st.booleans()), max_size=6)


def _link(pairs, tail):
    written = [quote(k, safe="") + ("=" + (quote_plus(v) if plus else quote(v, safe="")) if v or plus else "")
               for k, v, plus in pairs]
    return "https://h/p?" + "&".join(written) + tail


@SETTINGS
@given(st.lists(st.tuples(pair_list, st.sampled_from(["", "#top", "#?page%5Bcursor%5D=no"])), min_size=20, max_size=60))
def test_query_param_property(spark, links):
    got = _col(spark, [_link(*x) for x in links], lambda c: query_param(c, "page[cursor]"))
    assert got == [next((v for k, v, _ in pairs if k == "page[cursor]" and v), None) for pairs, _ in links]


# --------------------------------------------------------------------- strip

ws_text = st.text(alphabet=st.sampled_from(list(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　abc.")), max_size=10)


@SETTINGS
@given(st.lists(ws_text, min_size=20, max_size=60))
def test_strip_property(spark, values):
    assert _col(spark, values, strip) == [v.strip() for v in values]


# ---------------------------------------------------------- dedup_richest

row = st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([None, "p"]),
                st.sampled_from([None, "[]"]), st.sampled_from([None, "2020", "2020-01-02", "2021-05-05"]),
                st.sampled_from([None, "2019", "2022"]), st.text(alphabet="xyz", min_size=1, max_size=4))


def _brute(rows):
    best = {}
    for r in rows:
        k, prov, alt, reg, upd, raw = r
        score = (prov is not None) + (alt is not None)
        key = (-score, reg is None, reg or "", upd is None, upd or "", raw)
        if k not in best or key < best[k][0]:
            best[k] = (key, r)
    return sorted((v[1] for v in best.values()), key=repr)


@SETTINGS
@given(st.lists(row, min_size=1, max_size=30))
def test_dedup_richest_property(spark, rows):
    df = spark.createDataFrame(rows, "doi string, provider_id string, alternate_ids_json string, "
                                     "registered string, updated string, raw_attributes_json string")
    got = sorted((tuple(r) for r in dedup_richest(df, order=("registered", "updated")).collect()), key=repr)
    assert got == _brute(rows)


# --------------------------------------------------------- merge_with_sheet

keys = st.sampled_from(["", "1", "2", "3"])


@SETTINGS
@given(st.lists(st.tuples(keys, st.sampled_from(["a", "b"])), max_size=8),
       st.lists(st.tuples(keys, st.sampled_from(["x", "y", "z"])), max_size=8),
       st.sampled_from(["left", "right", "inner", "outer"]))
def test_sheet_merge_matches_pandas(spark, cat_rows, sheet_rows, how):
    import pandas as pd

    from metalake.operators.joins import merge_with_sheet

    cat = pd.DataFrame(cat_rows, columns=["id", "name"])
    sheet = pd.DataFrame(sheet_rows, columns=["source_id", "name"])
    want_df = cat.merge(sheet.drop_duplicates(subset=["source_id"], keep="first"), how=how,
                        left_on="id", right_on="source_id")
    want = sorted((tuple(None if pd.isna(v) else v for v in r)
                   for r in want_df[["id", "name_x", "source_id", "name_y"]].itertuples(index=False)), key=repr)
    cdf = spark.createDataFrame(cat_rows, "id string, name string")
    sdf = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(sheet_rows)],
                                "source_id string, name string, _line long")
    got = sorted((tuple(r) for r in merge_with_sheet(cdf, sdf, "id", "source_id", ["name"], how)
                  .select("id", "name_x", "source_id", "name_y").collect()), key=repr)
    assert got == want


# --------------------------------------------------------------- html_unescape

html_piece = st.sampled_from(["a", " ", "&", ";", "#", "x", "&amp;", "&amp", "&lt;", "&gt;", "&quot;",
                              "&apos;", "&#39;", "&#x27;", "&#233;", "&#128;", "&eacute;", "&copy",
                              "&notit;", "&bogus;", "&#xZZ;", "AT&T"])


@SETTINGS
@given(st.lists(st.lists(html_piece, max_size=8).map("".join), min_size=20, max_size=60))
def test_html_unescape_property(spark, values):
    import html

    from metalake.functions import html_unescape
    assert _col(spark, values, html_unescape) == [html.unescape(v) for v in values]
