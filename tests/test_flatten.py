"""Wide-row and client flattening (C1, C3, C8) on hand-made items."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from metalake import adapters, session
from metalake.operators.flatten import flatten_clients, flatten_items
from metalake.schema import CLIENT_COLUMNS, WIDE_COLUMNS
from metalake.sources.items import items_from_text, quarantine

ITEMS = [
    {"id": "a", "attributes": {
        "doi": "10.1/a", "prefix": "", "publisher": {"name": "P", "lang": "en"},
        "titles": [{"title": "A &amp; B", "lang": "en"}], "types": {"resourceTypeGeneral": "Preprint"},
        "created": "2024-07-15T23:30:00-05:00", "registered": "2024", "updated": "20240715T101010Z",
        "publicationYear": "2019", "creators": [], "contributors": None, "published": "2019",
        "alternateIdentifiers": [{"b": 1, "a": 2}]},
     "relationships": {"client": {"data": {"id": "cern.zenodo"}}}},
    {"id": "b", "attributes": {"doi": "abc", "titles": ["bare"], "publicationYear": "n.d.",
                               "clientId": "solo", "providerId": ""}},
    {"id": "c", "attributes": {"doi": "10.2/c", "titles": [{"t": 1}], "types": {}},
     "relationships": {"client": {"data": None}}},
    {"id": "d"},
    {"id": "e", "attributes": {"doi": "10.3/e", "titles": [], "created": ""}},
]


def _wide(spark, items):
    df = spark.createDataFrame([(json.dumps(i),) for i in items], "raw string")
    return {r["doi"]: r.asDict() for r in flatten_items(items_from_text(df)).collect()}


def test_columns_and_guard(spark):
    df = spark.createDataFrame([(json.dumps(i),) for i in ITEMS], "raw string")
    wide = flatten_items(items_from_text(df))
    assert wide.columns == WIDE_COLUMNS
    assert wide.count() == 4  # item without attributes dropped


def test_wide_rules(spark):
    w = _wide(spark, ITEMS)
    a, b, c, e = w["10.1/a"], w["abc"], w["10.2/c"], w["10.3/e"]
    assert a["prefix"] == "10.1" and b["prefix"] is None
    assert a["publisher"] == '{"lang":"en","name":"P"}'
    assert a["title"] == "A & B" and b["title"] == "bare" and c["title"] is None and e["title"] is None
    assert a["titles_json"] == '[{"lang":"en","title":"A &amp; B"}]' and e["titles_json"] == "[]"
    assert a["types_json"] == '{"resourceTypeGeneral":"Preprint"}'
    assert b["types_json"] == "{}" and c["types_json"] == "{}"
    assert (a["created"], a["registered"], a["updated"]) == ("2024-07-15", "2024", "2024-07-15")
    assert e["created"] is None
    assert a["published_year"] == 2019 and b["published_year"] is None
    assert a["creators_json"] == "[]" and b["creators_json"] is None
    assert a["contributors_json"] is None  # JSON null -> NULL
    assert a["alternate_ids_json"] == '[{"a":2,"b":1}]'
    assert a["client_id"] == "cern.zenodo" and a["provider_id"] == "cern"
    assert b["client_id"] == "solo" and b["provider_id"] == ""
    assert c["client_id"] is None and c["provider_id"] is None
    assert b["raw_relationships_json"] == "{}"
    assert json.loads(a["raw_attributes_json"])["doi"] == "10.1/a"


def test_duplicate_keys_keep_last_and_bad_json_quarantined(spark):
    df = spark.createDataFrame([('{"attributes": {"doi": "x", "doi": "10.9/y"}}',), ("{not json",)],
                               "raw string")
    got = rows(flatten_items(items_from_text(df)), "doi")
    assert got == [("10.9/y",)]
    assert quarantine(df).count() == 1


def test_pages_are_exploded(spark):
    page = {"data": [{"attributes": {"doi": "10.1/p1"}}, {"attributes": {"doi": "10.1/p2"}}],
            "meta": {"total": 2}, "links": {}}
    df = spark.createDataFrame([(json.dumps(page),)], "raw string")
    assert sorted(rows(flatten_items(items_from_text(df)), "doi")) == [("10.1/p1",), ("10.1/p2",)]


CLIENTS = [
    {"id": "x.a", "type": "clients", "attributes": {"name": "N", "displayName": None,
                                                    "domains": ["a.org", "b.org"], "isActive": True,
                                                    "year": 2015},
     "relationships": {"provider": {"data": {"id": "x", "type": "providers"}}}},
    {"id": "x.b", "attributes": {"name": "", "displayName": "D", "domains": [], "isActive": False}},
    {"id": "x.c", "attributes": {"domains": "*"}},
]


def test_flatten_clients(spark):
    df = spark.createDataFrame([(json.dumps(c),) for c in CLIENTS], "raw string")
    out = flatten_clients(items_from_text(df))
    assert out.columns == CLIENT_COLUMNS
    got = {r["id"]: r.asDict() for r in out.collect()}
    a, b, c = got["x.a"], got["x.b"], got["x.c"]
    assert a["displayName"] == "N" and b["displayName"] == "D" and c["displayName"] == ""
    assert a["domains"] == "a.org, b.org" and b["domains"] == "" and c["domains"] == "*"
    assert a["isActive"] == "True" and b["isActive"] == "False" and a["year"] == "2015"
    assert a["provider_id"] == "x" and a["provider_type"] == "providers" and b["provider_id"] == ""
    assert json.loads(a["raw_json"]) == CLIENTS[0]


def order_rows(spark, n):
    return spark.range(n).selectExpr(
        "id AS o_orderkey", "id % 97 AS o_custkey", "'F' AS o_orderstatus", "cast(id * 1.5 as double) AS o_totalprice",
        "timestamp'1995-01-01' + make_interval(0, 0, 0, cast(id % 900 as int)) AS o_orderdate", "'1-URGENT' AS o_orderpriority")


def test_records_of_one_row_group_are_dealt_to_all_tasks(spark, tmp_dir):
    """A file with one row group has as many splits as its bytes call for; only one of them has rows."""
    n, conf = 8000, {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1k"}
    order_rows(spark, n).coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        records = adapters.records_from_orders(spark, tmp_dir)
        sizes = [r["count"] for r in records.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert sum(sizes) == n and max(sizes) <= n // 4 + 1


def test_tasks_follow_the_rows(spark):
    assert session.tasks_for(spark, 10) == 4 and session.tasks_for(spark, 54_000_000) == 540
    assert session.spread_rows(spark.range(1000), 100).rdd.getNumPartitions() == 10


def test_members_are_rendered_once(spark):
    p = flatten_items(items_from_text(spark.createDataFrame([("{}",)], "raw string")))._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("to_json") <= 4  # members, relationships twice, attributes that are no plain object


@pytest.mark.parametrize("attributes", [
    {"z": 1, "a": None, "sizes": ["\x0b\x1f"], "types": {"b": "\\\x0e", "a": [1, {"y": True, "x": "é😀"}]}},
    {"quo\"te": 1, "back\\slash": {"a": 2}, "ctl\x01": "\x0c", "titles": 0}, {}, [], [1, {"b": 1, "a": 2}], "text", 7])
def test_whole_text_is_the_members_joined(spark, attributes):
    raw = json.dumps({"attributes": attributes})
    got = flatten_items(items_from_text(spark.createDataFrame([(raw,)], "raw string"))).first()
    assert got["raw_attributes_json"] == json.dumps(attributes, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    if isinstance(attributes, dict):
        want = attributes.get("sizes")
        assert got["sizes_json"] == (want and json.dumps(want, ensure_ascii=False, separators=(",", ":")))
        assert got["titles_json"] == "[]"


def test_pages_are_made_where_their_records_are(spark, tmp_dir):
    order_rows(spark, 2500).write.parquet(f"{tmp_dir}/orders.parquet")
    pages = adapters.pages_from_orders(spark, tmp_dir)
    p = pages._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange") == 1 and p.index("Exchange") > p.index("collect_list")
    got = {r.page_no: json.loads(r.value) for r in pages.collect()}
    assert [len(got[i]["data"]) for i in range(3)] == [1000, 1000, 500] and got[0]["meta"]["total"] == 2500
    assert got[2]["links"]["next"] is None and got[1]["links"]["next"] is not None
