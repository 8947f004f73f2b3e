"""Merge plan: shard files of many runs -> one schema -> (dedup) -> one
timestamped Parquet dataset, with a per-file report."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.dedup import dedup_richest
from ..operators.shards import shard_report, unify_shards
from ..sinks import count_rows, write_merged
from ..sources.files import batch_files, shard_files


def merge_shards(spark: SparkSession, parents=None, out_base: str | None = None,
                 name_contains: str = "", base_dir: str | None = None,
                 leaf_name: str | None = None, dedup: bool = True,
                 max_rows: int | None = None) -> dict:
    """Unify every shard under ``parents`` (or under folders named
    ``leaf_name`` below ``base_dir``); de-duplicate by DOI unless
    ``dedup=False``; write ``<out_base>_<ts>.parquet`` when ``out_base``
    is given. Returns the data, the per-file report and the written path;
    the rows are counted while they are written."""
    if base_dir and leaf_name:
        listing = batch_files(spark, base_dir, leaf_name)
    else:
        listing = shard_files(spark, parents, name_contains=name_contains)
    shards = unify_shards(spark, listing)
    report = shard_report(shards, max_rows=max_rows)
    data = shards.data
    if dedup and "doi" in data.columns:
        data = dedup_richest(data)
    seen, counted = count_rows(data, "merged")
    path = write_merged(counted, out_base) if out_base else None
    return {"data": data, "report": report, "rejects": shards.rejects, "parquet": path,
            "rows_written": seen() if path else None, "inputs": shards.files.count(), "target": shards.target}
