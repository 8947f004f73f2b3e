"""Harvest plan: landed records -> selection -> wide rows -> richest row per
DOI -> chunked Parquet (and optional NDJSON).

One lazy plan: the scan, one hash shuffle on ``doi`` (after the per-map
``WindowGroupLimit`` pre-pruning), and the output commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_richest
from ..operators.flatten import flatten_items
from ..operators.select import (LABEL_KEY, TYPE_KEY, by_clients, by_date_range, by_type, check_type_mode,
                                with_type_keys)
from ..session import kept, spread, tasks_for
from ..sinks import write_chunks, write_ndjson
from ..sources.items import read_items

# Shipped selections: canonical preprints from all clients, canonical text
# for one repository client, and the free-text label "preprint"; all on the
# registration date from 1800-01-01 to today.
PRESETS = {
    "preprint": dict(type_mode="canonical", type_id="Preprint", date_field="registered",
                     date_start="1800-01-01"),
    "arxiv_text": dict(type_mode="canonical", type_id="Text", client_ids=["arxiv.content"],
                       date_field="registered", date_start="1800-01-01"),
    "label_preprint": dict(type_mode="label", type_id="Preprint", label="preprint",
                           date_field="registered", date_start="1800-01-01"),
}


def select_records(wide: DataFrame, type_mode: str = "canonical", type_id: str = "Preprint",
                   label: str | None = None, date_field: str = "registered",
                   date_start: str | None = None, date_end: str | None = None,
                   client_ids=None) -> DataFrame:
    """B1-B6 over wide rows (date and client predicates first, so they are
    pushed to a Parquet scan when the input is landed Parquet)."""
    check_type_mode(type_mode, label)
    sel = by_date_range(wide, date_field, date_start, date_end)
    sel = by_clients(sel, client_ids)
    return by_type(sel, type_mode, type_id, label)


def land(wide: DataFrame, path: str, date_field: str = "registered", max_rows: int = 100_000) -> str:
    """Wide rows as Parquet that selections can prune: folded type columns
    beside the rows, and files and row groups that each cover a short range of
    one date. The range shuffle is paid once, at landing.

    The rows are written first: the ranges are found by a look at all of them,
    which would make them twice. A partition holds about ``max_rows`` rows,
    those of one date (or without one) dealt to several if they are many."""
    spark = wide.sparkSession
    keyed = kept(with_type_keys(wide), "land")
    ranges = keyed.repartitionByRange(tasks_for(spark, keyed.count(), max_rows), date_field, TYPE_KEY, F.xxhash64("doi", "url"))
    return write_chunks(ranges.sortWithinPartitions(date_field, TYPE_KEY), path, max_rows)


def select_landed(spark: SparkSession, path: str, **selection) -> DataFrame:
    """B1-B6 over rows landed by ``land``; the selection reaches the scan."""
    return select_records(spark.read.parquet(path), **selection).drop(TYPE_KEY, LABEL_KEY)


def harvest(spark: SparkSession, landing, newest: bool = False, multiline: bool = False,
            **selection) -> DataFrame:
    """The harvested, de-duplicated wide table for a selection."""
    check_type_mode(selection.get("type_mode", "canonical"), selection.get("label"))
    # A few large gzip files arrive as one task each; spread the flatten
    # (a no-op when the landing already splits into many partitions).
    wide = flatten_items(spread(read_items(spark, landing, multiline=multiline)))
    return dedup_richest(select_records(wide, **selection), newest=newest)


def harvest_to(spark: SparkSession, landing, out_dir: str, chunk_rows: int = 100_000,
               ndjson_path: str | None = None, ndjson_gzip: bool = False, **selection) -> str:
    df = harvest(spark, landing, **selection)
    write_chunks(df, out_dir, chunk_rows)
    if ndjson_path:
        write_ndjson(df, ndjson_path, gzip=ndjson_gzip)
    return out_dir
