"""Physical-plan shape: pruning before the shuffle, broadcast lookups, scan
pruning and pushdown, and no Python outside the title decoder."""

from __future__ import annotations

import hashlib
import os
import re

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from metalake.operators.dedup import dedup_richest
from metalake.operators.joins import label_server_name
from metalake.operators.select import by_canonical_type
from metalake.plans.harvest import land, select_landed, select_records
from metalake.registry import QUERIES, wide_records
from metalake.session import apply_sql_conf


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_harvest_dedup_prunes_per_partition(spark):
    p = plan(dedup_richest(wide_records(spark, SF001)))
    assert "WindowGroupLimit" in p and "Exchange hashpartitioning(doi" in p


def test_only_title_uses_python(spark):
    wide = wide_records(spark, SF001)
    assert "ArrowEvalPython" in plan(wide.select("title"))
    no_title = wide.drop("title")
    assert "ArrowEvalPython" not in plan(no_title) and "BatchEvalPython" not in plan(no_title)


def test_label_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["q20_label_server_name"](spark, SF001))


def scan_rows(df) -> int:
    """Rows that the Parquet scan of a plan without shuffles hands on: those of the row groups it did not skip."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    scan = execution.executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def landed_records(spark, path):
    """Eight files of a month or so each, written like a harvest lands them."""
    wide = wide_records(spark, SF001)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land(wide, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return wide


@pytest.mark.parametrize("mode, pushed", [("canonical", ["EqualTo(_type_key,preprint)"]),
                                          ("label", ["EqualTo(_label_key,preprint)"]),
                                          ("both", ["Or(EqualTo(_type_key,preprint),EqualTo(_label_key,preprint))"])])
def test_selection_pushed_to_parquet_scan(spark, tmp_dir, mode, pushed):
    path = os.path.join(tmp_dir, "wide.parquet")
    wide = landed_records(spark, path)
    options = dict(type_mode=mode, type_id="Preprint", label="preprint", date_field="registered", date_start="1996-01-01",
                   date_end="1996-03-31", client_ids=["n1.c1", "n2.c2", "n3.c3"])
    sel = select_landed(spark, path, **options).select("doi")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        scan = [line for line in plan(sel).split("\n") if "FileScan parquet" in line][0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = scan.split("PushedFilters: ")[1]
    for want in ["GreaterThanOrEqual(registered,1996-01-01)", "LessThan(registered,1996-03-32)", "In(client_id", *pushed]:
        assert want in filters
    read_schema = scan.split("ReadSchema: ")[1]
    assert "title" not in read_schema and "raw_attributes_json" not in read_schema
    assert sorted(sel.collect()) == sorted(select_records(wide, **options).select("doi").collect())


def test_selection_skips_row_groups(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wide.parquet")
    wide = landed_records(spark, path)
    dates = select_landed(spark, path, date_field="registered", date_start="1996-01-01", date_end="1996-03-31").select("doi")
    assert 0 < dates.count() <= scan_rows(dates) < wide.count() / 2
    nowhere = by_canonical_type(spark.read.parquet(path), "zz-no-such-type").select("doi")
    assert scan_rows(nowhere) == 0


def test_completeness_renders_nothing(spark):
    p = plan(QUERIES["q29_completeness"](spark, SF001))
    assert "ArrowEvalPython" not in p and "to_json" not in p


def test_ranges_and_types_parse_once(spark):
    assert plan(QUERIES["q05_date_range"](spark, SF001)).count("FileScan parquet") == 1
    assert plan(QUERIES["q04_type_both"](spark, SF001)).count("FileScan parquet") == 1


def test_flagship_shuffles_no_json_text(spark):
    tree = QUERIES["q12b_dedup_records"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    below = tree[tree.index("Exchange hashpartitioning(doi"):].split("\n")[1]  # what the shuffle carries
    assert "raw_attributes_json" not in re.sub(r"sha2\(.*?\) AS \S+", "", below)


def test_hot_key_is_pruned_before_the_shuffle(spark):
    from pyspark.sql import functions as F
    n = 30_000
    df = (spark.range(n).repartition(8)
          .select(F.when(F.col("id") % 3 == 0, F.lit("10.1/hot"))
                  .otherwise(F.concat(F.lit("10.1/"), F.col("id").cast("string"))).alias("doi"),
                  F.when(F.col("id") == 2999, F.lit("p")).alias("provider_id"),
                  F.lit(None).cast("string").alias("alternate_ids_json"),
                  F.format_string("2020-%02d-01", (F.col("id") % 12 + 1).cast("int")).alias("registered"),
                  F.lit(None).cast("string").alias("updated"), F.lit(None).cast("string").alias("created"),
                  F.col("id").cast("string").alias("raw_attributes_json")))
    best = dedup_richest(df)
    p = plan(best)
    lines = p.split("\n")
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l)
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(doi" in l)
    assert exchange < partial  # the partial limit sits below (before) the shuffle
    hot = best.filter(F.col("doi") == "10.1/hot").collect()
    earliest = [str(i) for i in range(0, n, 12)]  # the first date; ties go by the hash of the text
    assert len(hot) == 1
    assert hot[0]["raw_attributes_json"] == min(earliest, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert best.count() == n - n // 3 + 1


def test_hot_client_is_split(spark):
    """Without a broadcast, the partition of a client that holds a third of the rows is split."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    rows = spark.range(60_000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot.client")).otherwise(F.concat(F.lit("c."), F.col("id") % 997)).alias("client_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("doi"))
    catalog = spark.createDataFrame([("hot.client", "Hot", "")] + [(f"c.{i}", f"C{i}", "") for i in range(0, 997, 2)],
                                    "id string, name string, displayName string")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = label_server_name(rows, catalog)
        assert sum(r["server_name"] == "Hot" for r in got.collect()) == 20_000
        assert "SortMergeJoin(skew=true)" in plan(got)
    finally:
        for k in conf:
            spark.conf.unset(k)
        apply_sql_conf(spark)


def test_landing_makes_rows_once_and_deals_one_date(spark, tmp_dir):
    """The rows come from their source once, and those without a date are not one task's."""
    made = spark.sparkContext.accumulator(0)

    def seen(i):
        made.add(1)
        return f"10.1/{i}"

    wide = spark.range(4000).select(F.udf(seen)("id").alias("doi"), F.col("id").cast("string").alias("url"),
                                    F.lit("Text").alias("resource_type_general"), F.lit("a").alias("resource_type"),
                                    F.expr("if(id < 40, '1996-01-01', NULL)").alias("registered"))
    path = land(wide, os.path.join(tmp_dir, "wide.parquet"), max_rows=500)
    assert made.value == 4000 and spark.read.parquet(path).count() == 4000
    parts = {f.split("-")[1] for f in os.listdir(path) if f.startswith("part-")}
    assert len(parts) == 8


def test_landed_selections_group_by_a_digest(spark):
    p = plan(QUERIES["q58_landed_selections"](spark, SF001))
    assert "hashpartitioning(doi" in p and not re.search(r"hashpartitioning\([^)]*raw_attributes_json", p)
