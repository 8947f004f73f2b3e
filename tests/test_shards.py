"""G1-G3, F4, G8 on shards written the way pandas writes them."""

from __future__ import annotations

import os

import pandas as pd
import pytest

from pyspark.sql import functions as F

from metalake.operators.shards import read_footers, shard_columns, shard_report, unify_shards
from metalake.sources.files import list_files, run_date_range, shard_files
from metalake.plans.merge import merge_shards


def _write_drifting_shards(root: str) -> str:
    d = os.path.join(root, "run_2020-01-01_2020-02-01", "batches")
    os.makedirs(d)

    def wide(n, start):
        return pd.DataFrame({"doi": [f"10.1/{i}" for i in range(start, start + n)],
                             "client_id": ["c.a"] * n,
                             "registered": ["2020-01-0%d" % (1 + i % 9) for i in range(n)],
                             "url_alternate_json": ["[]"] * n})

    s0 = wide(3, 0)
    s0["published_year"] = pd.Series([2019, 2020, 2021], dtype="int64")
    s0["language"] = None  # all-NULL pandas column
    s0.to_parquet(os.path.join(d, "chunk_00000.parquet"), index=False)
    s1 = wide(2, 10)
    s1["published_year"] = [2018.0, None]
    s1["score"] = [1, 2]
    s1["language"] = ["en", None]
    s1.to_parquet(os.path.join(d, "chunk_00001.parquet"), index=False)
    s2 = wide(2, 20).drop(columns=["url_alternate_json"])
    s2["published_year"] = pd.Series([2017, 2016], dtype="int64")
    s2.to_parquet(os.path.join(d, "chunk_00002.parquet"), index=False)
    wide(0, 0).assign(published_year=pd.Series([], dtype="int64")).to_parquet(
        os.path.join(d, "chunk_00003.parquet"), index=False)
    s5 = wide(1, 0)  # same DOI as a row of chunk 0 (a later duplicate)
    s5["published_year"] = pd.Series([2015], dtype="int64")
    s5.to_parquet(os.path.join(d, "chunk_00005.parquet"), index=False)
    with open(os.path.join(d, "chunk_00006.parquet"), "wb") as fh:
        fh.write(b"not a parquet file")
    return d


def test_unify_and_report(spark, tmp_dir):
    d = _write_drifting_shards(tmp_dir)
    shards = unify_shards(spark, shard_files(spark, [tmp_dir, d]), with_source=True)
    data = shards.data
    assert data.count() == 3 + 2 + 2 + 0 + 1
    types = dict((f.name, f.dataType.simpleString()) for f in shards.target.fields)
    assert types["published_year"] == "bigint" and types["score"] == "double"
    assert types["language"] == "string" and types["url_alternate_json"] == "string"
    years = sorted(r[0] for r in data.select("published_year").collect() if r[0] is not None)
    assert years == [2015, 2016, 2017, 2018, 2019, 2020, 2021]
    assert data.filter("url_alternate_json IS NULL").count() == 2

    rep = {r["file_name"]: r.asDict() for r in shard_report(shards, max_rows=2).collect()}
    assert rep["chunk_00003.parquet"]["empty"] and rep["chunk_00003.parquet"]["n_rows"] == 0
    assert rep["chunk_00000.parquet"]["over_limit"]
    assert rep["chunk_00005.parquet"]["gap_before"] and not rep["chunk_00001.parquet"]["gap_before"]
    bad = rep["chunk_00006.parquet"]
    assert not bad["readable"] and bad["error"] and bad["n_rows"] is None
    assert not any(r["repeated_name"] for r in rep.values())
    assert sum(r["schema_equal"] for r in rep.values()) == 1  # five layouts, none of them common


def test_misfits_are_counted_and_nested_values_kept(spark, tmp_dir):
    d = os.path.join(tmp_dir, "batches")
    os.makedirs(d)
    pd.DataFrame({"doi": ["a", "b"], "published_year": ["2020", "n.d."]}).to_parquet(f"{d}/chunk_00000.parquet")
    pd.DataFrame({"doi": ["c"], "published_year": [2021], "publisher": [{"en": "P"}]}).to_parquet(f"{d}/chunk_00001.parquet")
    shards = unify_shards(spark, shard_files(spark, d))
    got = sorted(tuple(r) for r in shards.data.select("doi", "published_year", "publisher").collect())
    assert got == [("a", 2020, None), ("b", None, None), ("c", 2021, '{"en":"P"}')]
    bad = [(os.path.basename(r["path"]), r["column"], r["n_rejected"]) for r in shards.rejects.collect()]
    assert bad == [("chunk_00000.parquet", "published_year", 1)]


def test_merge_plan_dedups(spark, tmp_dir):
    _write_drifting_shards(tmp_dir)
    out = merge_shards(spark, base_dir=tmp_dir, leaf_name="batches",
                       out_base=os.path.join(tmp_dir, "merged", "preprints_merged"))
    merged = spark.read.parquet(out["parquet"])
    assert merged.count() == 7 == out["rows_written"]  # 8 rows, one DOI twice
    assert os.path.basename(out["parquet"]).startswith("preprints_merged_")


def test_listing_skips_missing_parent(spark, tmp_dir):
    assert list_files(spark, [os.path.join(tmp_dir, "nope")]).count() == 0


A, B, C, D = "2020-01-01", "2021-01-01", "2022-01-01", "2022-02-01"


@pytest.mark.parametrize("path, want", [
    (f"/x/{A}_{B}", (A, B)), (f"/x/run_{A}_{B}.parquet", (A, B)), (f"/x/{A}{B}", (A, B)), (f"/x/{A}12345{B}", (A, B)),
    (f"/x/{A}123456{B}", (None, None)),
    (f"/x/from_{A}_until_{B}", (A, B)), (f"/x/from{A}-until-{B}", (A, B)), (f"/x/from-{A}until{B}", (A, B)),
    (f"/x/from_{A}_abcd_until_{B}", (None, None)), (f"/x/from_{A}abc_until_{B}", (A, B)),
    (f"/x/run_{A}_ab_until_{B}", (None, None)), (f"/x/from__{A}_until_{B}", (None, None)), (f"/x/from_{A}_until__{B}", (None, None)),
    (f"/x/{A}abcuntil{B} and {C}_{D}", (B, C)), (f"/x/from_{A}_until_{B} or else {C}_{D}", (C, D)),
    (f"/x/{A}_until_{B}", (None, None)), (f"/x/{A}", (None, None)), ("/x/no_dates", (None, None)), (None, (None, None)),
    (f"/{A}_{B}/{C}.parquet", (A, B)), (f"/{A}_{B}/from_{C}_until_{D}.parquet", (C, D)), (f"/from_{A}_until_{B}/a.parquet", (A, B)),
    (f"/from_{A}_until_{B}/{C}_{D}/a.parquet", (B, C)), (f"/x/{A}_{B}_{C}", (A, B)), (f"/x/{A}xxxxxx{B}_{C}", (B, C))])
def test_run_date_range(spark, path, want):
    got = spark.createDataFrame([(path,)], "p string").select(run_date_range("p").alias("r")).first()["r"]
    assert (got["start"], got["end"]) == want


def test_many_layouts_in_one_pass(spark, tmp_dir):
    """Every file has a layout of its own; the plan does not know how many there are."""
    d = os.path.join(tmp_dir, "batches")
    os.makedirs(d)
    kinds = [lambda i: i, lambda i: float(i), lambda i: str(i), lambda i: None]
    for i in range(500):
        pd.DataFrame({"doi": [f"10.1/{i}"], f"extra_{i % 60}": [kinds[i % 4](i)], "published_year": [kinds[i % 3](i)]}).to_parquet(
            f"{d}/chunk_{i:05d}.parquet")
    shards = unify_shards(spark, shard_files(spark, d))
    plan = shards.data._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan and "chunk_" not in plan and "FileScan" not in plan.replace(
        "FileScan parquet [path", "")
    got = {r["doi"]: r for r in shards.data.collect()}
    assert len(got) == 500 and all(got[f"10.1/{i}"]["published_year"] == i for i in range(500))
    assert got["10.1/6"]["extra_6"] == "6" and got["10.1/7"]["extra_7"] is None and len(shards.target) == 62
    assert shards.rejects.count() == 0
    few = unify_shards(spark, shard_files(spark, d), columns=["doi"]).data
    assert few.columns == ["doi"] and few.count() == 500


def test_row_groups_of_a_large_file_are_dealt_out(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq
    rows = pa.table({"doi": [f"10.1/{i}" for i in range(5000)], "n": list(range(5000)), "d": pa.array(["x", "y"] * 2500).dictionary_encode(),
                     "u": pa.array(range(5000), pa.uint64()), "t": pa.array([0] * 5000, pa.timestamp("ns"))})
    pq.write_table(rows, os.path.join(tmp_dir, "large.parquet"), row_group_size=250)
    shards = unify_shards(spark, shard_files(spark, tmp_dir), unit_bytes=20_000)
    data = shards.data
    assert data.rdd.getNumPartitions() >= 8 and data.count() == 5000
    assert data.agg({"n": "sum"}).first()[0] == sum(range(5000))
    assert [t for _, t in data.dtypes] == ["string", "bigint", "string", "double", "timestamp"]
    per_task = data.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 8 and max(r["count"] for r in per_task) < 1500


def test_report_and_columns_read_no_data_page(spark, tmp_dir):
    """The footers answer: the data pages of this file are overwritten with noise."""
    path = os.path.join(tmp_dir, "chunk_00000.parquet")
    pd.DataFrame({"doi": [f"10.1/{i:04d}" for i in range(1000)], "registered": [None, "2020-01-01"] * 500}).to_parquet(path)
    size = os.path.getsize(path)
    with open(path, "r+b") as fh:
        fh.seek(4)
        fh.write(b"\0" * 2000)
    assert os.path.getsize(path) == size
    files = read_footers(spark, shard_files(spark, tmp_dir))
    rep = shard_report(files, max_rows=999).first()
    assert (rep["n_rows"], rep["over_limit"], rep["empty"], rep["readable"]) == (1000, True, False, True)
    cols = {r["column"]: r for r in shard_columns(files, ["doi", "registered", "url"]).collect()}
    assert (cols["doi"]["low"], cols["doi"]["high"], cols["doi"]["n_null"], cols["doi"]["problem"]) == ("10.1/0000", "10.1/0999", 0, None)
    assert cols["registered"]["n_null"] == 500 and cols["url"]["problem"] == "missing"
    assert shard_columns(files, ["doi"]).where("problem = 'unexpected'").select("column").collect()[0][0] == "registered"
