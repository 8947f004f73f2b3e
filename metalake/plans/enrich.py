"""Enrich + label plan: distinct client ids -> ids new to the catalogue ->
their client records (placeholder when absent) -> upserted catalogue ->
labelled 17-column table and providers summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import distinct_client_ids, providers_summary, run_summary, union_all
from ..operators.dedup import dedup_first
from ..operators.joins import attach_clients, new_ids
from ..operators.labels import label_records
from ..schema import CLIENT_COLUMNS
from ..sinks import write_catalog, write_labelled
from ..sources.files import latest_dataset
from ..sources.tables import read_catalog


def upsert_catalog(catalog: DataFrame, fetched: DataFrame) -> DataFrame:
    """F9 + D2: existing rows first, then new ones; one row per id, an
    existing row beats a new one."""
    both = union_all([catalog.select(*CLIENT_COLUMNS).withColumn("_src", F.lit(0)),
                      fetched.select(*CLIENT_COLUMNS).withColumn("_src", F.lit(1))])
    return dedup_first(both, "id", ["_src"]).drop("_src")


def enrich_catalog(rows: DataFrame, catalog: DataFrame, client_records: DataFrame,
                   max_clients: int | None = None) -> DataFrame:
    """The catalogue after adding every client id seen in ``rows``.

    ``client_records`` are flattened client records (C8) standing for the
    registry's client lookup; ids without a record get a placeholder."""
    ids = distinct_client_ids(rows, "client_id", max_clients)
    fresh = attach_clients(new_ids(ids, catalog), client_records)
    return upsert_catalog(catalog, fresh)


def enrich_and_label(spark: SparkSession, rows: DataFrame, catalog: DataFrame,
                     client_records: DataFrame, out_catalog: str | None = None,
                     out_labelled: str | None = None, fmt: str = "parquet",
                     max_clients: int | None = None) -> dict:
    """Catalogue, labelled rows and summaries. ``out_catalog`` may be the very
    catalogue that ``catalog`` was read from; the run summary compares with
    the catalogue as it was before."""
    summary = run_summary(rows, catalog)
    updated = enrich_catalog(rows, catalog, client_records, max_clients)
    if out_catalog:
        summary = spark.createDataFrame(summary.collect(), summary.schema)  # one row, before the swap
        write_catalog(updated, out_catalog)
        updated = read_catalog(spark, out_catalog)
    labelled = label_records(rows, updated, keep_existing=(fmt == "csv"))
    if out_labelled:
        write_labelled(labelled, out_labelled, fmt)
    return {"catalog": updated, "labelled": labelled,
            "providers": providers_summary(updated), "summary": summary}


def enrich_folder(spark: SparkSession, folder: str, prefix: str, catalog_path: str, client_records: DataFrame,
                  max_clients: int | None = None) -> dict:
    """The usual run over a folder of merged datasets: the newest one's client
    ids extend the catalogue in place, and the dataset labelled from it is
    written beside it as ``<name>_labeled.parquet``."""
    newest = latest_dataset(spark, folder, prefix, ".parquet").first()
    rows = spark.read.parquet(newest["path"])
    out = f"{folder.rstrip('/')}/{newest['name'].removesuffix('.parquet')}_labeled.parquet"
    done = enrich_and_label(spark, rows, read_catalog(spark, catalog_path), client_records,
                            out_catalog=catalog_path, out_labelled=out, max_clients=max_clients)
    return {**done, "dataset": newest["path"], "labelled_path": out}
