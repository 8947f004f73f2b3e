"""Catalogue x curated sheet plan (read both CSVs, key-deduplicate the sheet,
join, write CSV and/or Parquet)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.joins import merge_with_sheet
from ..sinks import count_rows, write_enriched
from ..sources.tables import read_sheet


def merge_catalog_with_sheet(spark: SparkSession, catalog_csv: str, sheet_csv: str,
                             on_left: str = "id", on_right: str = "source_id",
                             select_cols=None, how: str = "left", out_csv: str | None = None,
                             out_parquet: str | None = None) -> dict:
    catalog = read_sheet(spark, catalog_csv).drop("_file", "_line")
    sheet = read_sheet(spark, sheet_csv)
    merged = merge_with_sheet(catalog, sheet, on_left, on_right, select_cols, how)
    seen, counted = count_rows(merged, "sheet")
    written = write_enriched(counted, out_csv, out_parquet)
    return {"data": merged, **written, "rows": seen() if out_csv or out_parquet else merged.count(), "cols": len(merged.columns)}
