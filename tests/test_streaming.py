"""H1/H2: resumable ingest and the best-row snapshot."""

from __future__ import annotations

import gzip
import json
import os
import re

import pytest

from metalake.operators.dedup import dedup_richest
from metalake.schema import WIDE_COLUMNS
from metalake.streaming import (compact_best_rows, ingest, ingest_records, maintain_best_rows, read_best_rows,
                                read_best_state, read_ingest_rejects, read_ingested)


def _page(dois, registered):
    return {"data": [{"id": d, "attributes": {"doi": d, "registered": r}} for d, r in zip(dois, registered)],
            "meta": {"total": len(dois)}, "links": {"next": None}}


def test_ingest_resumes_without_duplicates(spark, tmp_dir):
    land, out, ck = (os.path.join(tmp_dir, x) for x in ("landing", "out", "ck"))
    os.makedirs(land)
    with open(os.path.join(land, "page_0001.json"), "w") as fh:
        fh.write(json.dumps(_page(["10.1/a", "10.1/b"], ["2020-01-01", "2020-01-02"])) + "\n")
    with gzip.open(os.path.join(land, "page_0002.json.gz"), "wt") as fh:
        fh.write(json.dumps(_page(["10.1/c"], ["2020-01-03"])) + "\n")
    r1 = ingest_records(spark, land, out, ck, max_files_per_trigger=1)
    assert r1["input_docs"] == 2
    assert read_ingested(spark, out).count() == 3
    # restart with nothing new: no rows added
    ingest_records(spark, land, out, ck, max_files_per_trigger=1)
    assert read_ingested(spark, out).count() == 3
    # a new page arrives: only it is processed
    with open(os.path.join(land, "page_0003.json"), "w") as fh:
        fh.write(json.dumps(_page(["10.1/a"], ["2019-01-01"])) + "\n")
    r3 = ingest_records(spark, land, out, ck, partitions=4)
    assert r3["input_docs"] == 1
    assert read_ingested(spark, out).count() == 4


def test_totals_go_beyond_the_progress_history(spark, tmp_dir):
    """More batches than the query's own history keeps are still all counted."""
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    for i in range(6):
        with open(os.path.join(land, f"p{i}.json"), "w") as fh:
            fh.write(json.dumps(_page([f"10.1/{i}"], ["2020-01-01"])) + "\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        done = ingest_records(spark, land, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"),
                              max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert done["input_docs"] == 6 and done["batches"] >= 6


def test_rejects_of_a_stream(spark, tmp_dir):
    land, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "out")
    os.makedirs(land)
    with open(os.path.join(land, "p.json"), "w") as fh:
        fh.write(json.dumps(_page(["10.1/a"], ["2020-01-01"])) + "\n{broken\n\n")
        fh.write(json.dumps({"errors": [{"status": "404"}]}) + "\n" + json.dumps({"data": {"attributes": {"doi": "10.1/b"}}}) + "\n")
    ingest_records(spark, land, out, os.path.join(tmp_dir, "ck"))
    assert read_ingested(spark, out).columns == WIDE_COLUMNS
    assert sorted(r[0] for r in read_ingested(spark, out).select("doi").collect()) == ["10.1/a", "10.1/b"]
    bad = read_ingest_rejects(spark, out).collect()
    assert sorted((r["reason"], r["raw"][:7]) for r in bad) == [("error", '{"error'), ("malformed", "{broken")]
    assert all(r["source_file"].endswith("p.json") for r in bad)


def test_a_replayed_batch_changes_nothing(spark, tmp_dir, monkeypatch):
    """The write of a batch is done, but the job dies before the stream can commit it."""
    land, out, ck = (os.path.join(tmp_dir, x) for x in ("landing", "out", "ck"))
    os.makedirs(land)
    for i in range(3):
        with open(os.path.join(land, f"p{i}.json"), "w") as fh:
            fh.write(json.dumps(_page([f"10.1/{i}", f"10.2/{i}"], ["2020-01-01"] * 2)) + "\n{broken\n")
    whole, calls = ingest.write_landed, []

    def dying(batch, batch_id, *a):
        whole(batch, batch_id, *a)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
    monkeypatch.setattr(ingest, "write_landed", dying)
    with pytest.raises(Exception, match="lost driver"):
        ingest_records(spark, land, out, ck, max_files_per_trigger=1)
    assert read_ingested(spark, out).count() == 4
    ingest_records(spark, land, out, ck, max_files_per_trigger=1)
    assert calls == [0, 1, 1, 2]
    assert sorted(r["doi"] for r in read_ingested(spark, out).collect()) == sorted(f"10.{k}/{i}" for k in (1, 2) for i in range(3))
    assert read_ingest_rejects(spark, out).count() == 3


def test_landing_is_read_and_parsed_once(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "p.json"), "w") as fh:
        fh.write(json.dumps(_page(["10.1/a"], ["2020-01-01"])) + "\n{broken\n")
    rows = ingest.landed_rows(ingest.parsed_documents(spark.read.text(tmp_dir)))
    flat = ingest.flatten_items(rows, keep=["raw", "reason"], drop_without_attributes=False)
    tree = flat._jdf.queryExecution().executedPlan().toString()
    assert tree.count("FileScan text") == 1 and len(re.findall(r"parseJson\(", tree)) == 1


def test_totals_that_do_not_arrive_are_an_error(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(ingest, "EVENTS_S", 0.5)
    monkeypatch.setattr(ingest._Totals, "onQueryTerminated", lambda self, event: None)
    with open(os.path.join(tmp_dir, "p.json"), "w") as fh:
        fh.write(json.dumps(_page(["10.1/a"], ["2020-01-01"])) + "\n")
    with pytest.raises(TimeoutError):
        ingest_records(spark, tmp_dir, tmp_dir + "-out", tmp_dir + "-ck")


def test_static_overwrite_mode_loses_no_batch(spark, tmp_dir):
    land, log = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "log")
    os.makedirs(land)
    for i in range(3):
        with open(os.path.join(land, f"{i}.json"), "w") as fh:
            fh.write(json.dumps({"doi": f"k{i}", "provider_id": "p", "registered": "2020"}) + "\n")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        stream = (spark.readStream.schema("doi string, provider_id string, registered string")
                  .option("maxFilesPerTrigger", 1).json(land))
        done = maintain_best_rows(spark, stream, log, os.path.join(tmp_dir, "ck"), key="doi", rich=("provider_id",),
                                  order=("registered",))
        assert done["rows"] == 3 and read_best_rows(spark, log, "doi").count() == 3
        assert compact_best_rows(spark, log, "doi") == compact_best_rows(spark, log, "doi")
        assert read_best_rows(spark, log, "doi").count() == 3
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_state_store_best_rows_equal_batch_result(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    rows = [("k1", None, "2021"), ("k1", "p", "2022"), ("k2", "p", "2020"), ("k1", "p", "2019"),
            ("k2", None, "2018"), (None, None, "2017"), (None, "p", "2016"), ("k3", None, None),
            ("k3", None, "2014")]
    for i in range(0, len(rows), 2):
        with open(os.path.join(land, f"part_{i:03d}.json"), "w") as fh:
            for k, p, r in rows[i:i + 2]:
                fh.write(json.dumps({"doi": k, "provider_id": p, "registered": r}) + "\n")
    schema = "doi string, provider_id string, registered string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(land)
    log = os.path.join(tmp_dir, "log")
    res = maintain_best_rows(spark, stream, log, os.path.join(tmp_dir, "ck"), key="doi",
                                   rich=("provider_id",), order=("registered",))
    assert res["batches"] >= 4
    got = sorted(map(tuple, read_best_rows(spark, log, "doi")
                     .select("doi", "provider_id", "registered").collect()), key=repr)
    batch = dedup_richest(spark.createDataFrame(rows, schema), rich=("provider_id",),
                          order=("registered",), tie_break=None)
    want = sorted(map(tuple, batch.collect()), key=repr)
    assert got == want
    state = read_best_state(spark, os.path.join(tmp_dir, "ck"), "doi").select("doi", "provider_id", "registered")
    assert sorted(map(tuple, state.collect()), key=repr) == want
    # compaction keeps the answer; later batches are read on top of it
    assert compact_best_rows(spark, log, "doi") is not None
    with open(os.path.join(land, "part_999.json"), "w") as fh:
        fh.write(json.dumps({"doi": "k3", "provider_id": "p", "registered": "2030"}) + "\n")
    maintain_best_rows(spark, spark.readStream.schema(schema).json(land), log,
                             os.path.join(tmp_dir, "ck"), key="doi", rich=("provider_id",),
                             order=("registered",))
    after = {r["doi"]: (r["provider_id"], r["registered"]) for r in read_best_rows(spark, log, "doi").collect()}
    assert after["k3"] == ("p", "2030") and after["k1"] == ("p", "2019")
    assert len(after) == len(want)
    state = read_best_state(spark, os.path.join(tmp_dir, "ck"), "doi")
    assert {r["doi"]: (r["provider_id"], r["registered"]) for r in state.collect()} == after
