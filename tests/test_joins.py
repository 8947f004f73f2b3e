"""E1-E5 and the catalogue plans."""

from __future__ import annotations

import pytest

from metalake.operators.joins import (attach_clients, label_server_name, merge_with_sheet, new_ids,
                                      )
from metalake.operators.labels import label_records
from metalake.plans.enrich import upsert_catalog
from metalake.schema import CLIENT_COLUMNS, SLIM_COLUMNS


@pytest.fixture()
def catalog(spark):
    data = [("c.a", "Alpha ", "Disp A"), ("c.b", "", "Disp B"), ("c.c", "  ", "Disp C"),
            ("c.d", "", "")]
    return spark.createDataFrame(data, "id string, name string, displayName string")


def test_server_name(spark, catalog):
    recs = spark.createDataFrame([("1", "c.a"), ("2", " c.b\t"), ("3", "c.c"), ("4", "c.x"),
                                  ("5", None), ("6", "c.d")], "doi string, client_id string")
    out = label_server_name(recs, catalog)
    assert out.count() == recs.count()
    got = {r["doi"]: r["server_name"] for r in out.collect()}
    assert got == {"1": "Alpha", "2": "Disp B", "3": "", "4": "", "5": "", "6": ""}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_keep_existing_server_name(spark, catalog):
    recs = spark.createDataFrame([("1", "c.a", "kept")], "doi string, client_id string, server_name string")
    assert label_server_name(recs, catalog, keep_existing=True).collect()[0]["server_name"] == "kept"
    assert label_server_name(recs, catalog).collect()[0]["server_name"] == "Alpha"


def test_label_records_slim(spark, catalog):
    recs = spark.createDataFrame([("1", "c.a", "2024-07-15", "n.d."), ("2", "c.b", "202", None)],
                                 "doi string, client_id string, created string, registered string")
    out = label_records(recs, catalog)
    assert out.columns == SLIM_COLUMNS
    got = {r["doi"]: (r["created_year"], r["registered_year"], r["url"]) for r in out.collect()}
    assert got == {"1": ("2024", None, None), "2": (None, None, None)}


def test_lookup_join_is_left_to_spark(spark, catalog):
    """No broadcast is forced: with Spark's own threshold at zero the lookup is shuffled."""
    recs = spark.createDataFrame([("1", "c.a")], "doi string, client_id string")
    assert "rightHint" not in label_server_name(recs, catalog)._jdf.queryExecution().logical().toString()


def test_new_ids_and_placeholder(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "client_id string")
    cat = spark.createDataFrame([("a",)], "id string")
    assert sorted(r[0] for r in new_ids(ids, cat).collect()) == ["b", "c"]
    clients = spark.createDataFrame([tuple(["b"] + ["x"] * 19)], ", ".join(f"`{c}` string" for c in CLIENT_COLUMNS))
    out = {r["id"]: r.asDict() for r in attach_clients(new_ids(ids, cat), clients).collect()}
    assert out["b"]["name"] == "x"
    assert all(out["c"][c] == "" for c in CLIENT_COLUMNS if c != "id")


def test_upsert_existing_wins(spark):
    schema = ", ".join(f"`{c}` string" for c in CLIENT_COLUMNS)
    old = spark.createDataFrame([tuple(["a", "old"] + [""] * 18)], schema)
    new = spark.createDataFrame([tuple(["a", "new"] + [""] * 18), tuple(["b", "new"] + [""] * 18)], schema)
    got = {r["id"]: r["type"] for r in upsert_catalog(old, new).collect()}
    assert got == {"a": "old", "b": "new"}


@pytest.mark.parametrize("how,n", [("left", 4), ("right", 4), ("inner", 3), ("outer", 5)])
def test_sheet_merge_counts(spark, how, n):
    cat = spark.createDataFrame([("1", "c1"), ("2", "c2"), ("", "c3"), ("", "c4")], "id string, name string")
    sheet = spark.createDataFrame([("1", "s1", "x", 0), ("3", "s3", "y", 1), ("", "s0", "z", 2),
                                   ("1", "dup", "w", 3)],
                                  "source_id string, name string, extra string, _line long")
    out = merge_with_sheet(cat, sheet, "id", "source_id", ["name"], how)
    assert out.count() == n
    assert out.columns == ["id", "name_x", "source_id", "name_y"]
    if how == "left":
        got = {(r["id"], r["name_x"]): r["name_y"] for r in out.collect()}
        assert got[("1", "c1")] == "s1" and got[("", "c3")] == "s0" and got[("2", "c2")] is None


def test_sheet_merge_errors(spark):
    cat = spark.createDataFrame([("1",)], "id string")
    sheet = spark.createDataFrame([("1", "a")], "source_id string, v string")
    with pytest.raises(ValueError):
        merge_with_sheet(cat, sheet, "nope", "source_id")
    with pytest.raises(ValueError):
        merge_with_sheet(cat, sheet, "id", "nope")
    with pytest.raises(ValueError):
        merge_with_sheet(cat, sheet, "id", "source_id", ["missing"])
    with pytest.raises(ValueError):
        merge_with_sheet(cat, sheet, "id", "source_id", how="cross")


def test_sheet_merge_same_key_name(spark):
    cat = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    sheet = spark.createDataFrame([("1", "x"), ("3", "y")], "id string, w string")
    out = merge_with_sheet(cat, sheet, "id", "id", how="outer")
    assert out.columns == ["id", "v", "w"]
    assert sorted(r["id"] for r in out.collect()) == ["1", "2", "3"]
