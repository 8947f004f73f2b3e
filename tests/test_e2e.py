"""End-to-end plans over landed files, plus selector and schema checks."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from metalake.operators.aggregates import distinct_client_ids
from metalake.operators.quality import column_check, quality_gates, yearly_growth
from metalake.operators.select import by_type, check_type_mode
from metalake.plans import PRESETS, enrich_and_label, harvest, harvest_to, merge_catalog_with_sheet
from metalake.schema import CLIENT_COLUMNS, SLIM_COLUMNS, WIDE_COLUMNS
from metalake.sinks import write_catalog
from metalake.sources import read_catalog


def _item(doi, rtg, rt, registered, client, alt=False):
    a = {"doi": doi, "types": {"resourceTypeGeneral": rtg, "resourceType": rt}, "registered": registered}
    if alt:
        a["alternateIdentifiers"] = []
    return {"id": doi, "attributes": a, "relationships": {"client": {"data": {"id": client}}}}


@pytest.fixture()
def landing(tmp_dir):
    items = [_item("10.1/a", "Preprint", "Article", "2020-01-01T00:00:00Z", "arxiv.content"),
             _item("10.1/a", "Preprint", "preprint", "2019-01-01T00:00:00Z", "arxiv.content", alt=True),
             _item("10.1/b", "Text", "Preprint", "2021-05-05T00:00:00Z", "cern.zenodo"),
             _item("10.1/c", "Text", "Report", "1700-01-01T00:00:00Z", "arxiv.content"),
             _item("10.1/d", "Dataset", "Data", "2022-01-01T00:00:00Z", "other.repo")]
    d = os.path.join(tmp_dir, "landing")
    os.makedirs(d)
    with open(os.path.join(d, "page.json"), "w") as fh:
        fh.write(json.dumps({"data": items, "meta": {"total": len(items)}, "links": {}}) + "\n")
    return d


def test_type_modes(spark, landing):
    pre = harvest(spark, landing, **PRESETS["preprint"])
    assert sorted(r[0] for r in pre.select("doi").collect()) == ["10.1/a"]
    assert pre.collect()[0]["alternate_ids_json"] == "[]"  # the richer row
    lab = harvest(spark, landing, **PRESETS["label_preprint"])
    assert sorted(r[0] for r in lab.select("doi").collect()) == ["10.1/a", "10.1/b"]
    both = harvest(spark, landing, type_mode="both", type_id="Preprint", label="preprint",
                   date_start="1800-01-01")
    assert both.count() == 2
    text = harvest(spark, landing, **PRESETS["arxiv_text"])
    assert [r[0] for r in text.select("doi").collect()] == []  # 10.1/c registered before 1800


def test_invalid_modes(spark, landing):
    with pytest.raises(ValueError):
        check_type_mode("fuzzy")
    with pytest.raises(ValueError):
        check_type_mode("label", "None")
    with pytest.raises(ValueError):
        by_type(spark.createDataFrame([], "resource_type string"), "nope")


def test_harvest_to_chunks_and_ndjson(spark, landing, tmp_dir):
    out = os.path.join(tmp_dir, "batches")
    nd = os.path.join(tmp_dir, "ndjson")
    harvest_to(spark, landing, out, chunk_rows=1, ndjson_path=nd, ndjson_gzip=True,
               type_mode="canonical", type_id="Text", date_start="1800-01-01")
    df = spark.read.parquet(out)
    assert df.columns == WIDE_COLUMNS and df.count() == 1
    assert spark.read.json(nd).count() == 1


def test_enrich_and_label(spark, landing, tmp_dir):
    wide = harvest(spark, landing, type_mode="canonical", type_id="Preprint", date_start="1800-01-01")
    rows = wide.unionByName(harvest(spark, landing, type_mode="canonical", type_id="Dataset",
                                    date_start="1800-01-01"))
    schema = ", ".join(f"`{c}` string" for c in CLIENT_COLUMNS)
    old = spark.createDataFrame([tuple(["arxiv.content", "clients", "arXiv"] + [""] * 17)], schema)
    cat_path = os.path.join(tmp_dir, "catalog.csv")
    write_catalog(old, cat_path)
    records = spark.createDataFrame([tuple(["other.repo", "clients", "", "Other Repo"] + [""] * 16)], schema)
    out = enrich_and_label(spark, rows, read_catalog(spark, cat_path), records,
                           out_catalog=os.path.join(tmp_dir, "catalog_v2.csv"),
                           out_labelled=os.path.join(tmp_dir, "labelled"))
    cat = {r["id"]: r["displayName"] for r in out["catalog"].collect()}
    assert set(cat) == {"arxiv.content", "other.repo"}
    lab = spark.read.parquet(os.path.join(tmp_dir, "labelled"))
    assert lab.columns == SLIM_COLUMNS
    assert {r["doi"]: r["server_name"] for r in lab.collect()} == {"10.1/a": "arXiv", "10.1/d": "Other Repo"}
    s = out["summary"].collect()[0]
    assert (s["scanned_rows"], s["unique_client_ids"], s["new_clients"]) == (2, 2, 1)


def test_sheet_plan(spark, tmp_dir):
    cat = os.path.join(tmp_dir, "cat.csv")
    sheet = os.path.join(tmp_dir, "sheet.csv")
    with open(cat, "w") as fh:
        fh.write("id,name\na.b,Alpha\nc.d,Gamma\n")
    with open(sheet, "w") as fh:
        fh.write('source_id,How do they define themselves,Server Main Page Link,name\n'
                 'a.b,"preprint server, mostly",https://a,AlphaSheet\na.b,dup,x,y\n')
    res = merge_catalog_with_sheet(spark, cat, sheet, select_cols=["Server Main Page Link", "name"],
                                   out_csv=os.path.join(tmp_dir, "out.csv"),
                                   out_parquet=os.path.join(tmp_dir, "out.parquet"))
    got = {r["id"]: (r["Server Main Page Link"], r["name_x"], r["name_y"]) for r in res["data"].collect()}
    assert got == {"a.b": ("https://a", "Alpha", "AlphaSheet"), "c.d": (None, "Gamma", None)}
    assert spark.read.parquet(res["out_parquet"]).count() == 2


def test_max_clients_limit(spark):
    df = spark.createDataFrame([(" b",), ("a",), ("",), (None,), ("c",), ("a",)], "client_id string")
    assert [r[0] for r in distinct_client_ids(df, max_clients=2).collect()] == ["a", "b"]


def test_column_check_and_gates(spark):
    df = spark.createDataFrame([("10.1/x", "2024-01-01", "junk")], "doi string, registered string, extra string")
    probs = sorted((r["problem"], r["column"]) for r in column_check(df).collect())
    assert ("unexpected", "extra") in probs and ("missing", "url") in probs
    wide = spark.createDataFrame([(None, "2024", None, None, None, None, None, None)],
                                 "doi string, registered string, creators_json string, subjects_json string, "
                                 "funding_refs_json string, related_ids_json string, created string, "
                                 "updated string")
    gates = {(r["check"], r["column"]): r["passed"] for r in quality_gates(wide).collect()}
    assert gates[("required", "doi")] is False and gates[("required", "registered")] is True
    assert gates[("dates", "registered")] is False and gates[("coverage", "creators_json")] is False


def test_yearly_growth_surge(spark):
    df = spark.createDataFrame([(y,) for y, n in ((2019, 2), (2020, 5), (2021, 6)) for _ in range(n)], "y int")
    got = [(r["year"], r["prev_n"], r["surge"]) for r in yearly_growth(df, F.col("y"), 2.0).collect()]
    assert got == [(2019, None, False), (2020, 2, True), (2021, 5, False)]


def test_scale_conf():
    from metalake.session import scale_conf
    big = scale_conf(30 * 10**12, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(-(-30 * 10**12 // (256 << 20)))
    small = scale_conf(10**6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) == 4 * 256 * (1 << 20)
