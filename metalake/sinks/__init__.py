"""Writers. Spark's output committer makes every write atomic per job; a
dataset that is replaced in place goes through ``versions``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schema import CLIENT_COLUMNS, SLIM_COLUMNS
from ..versions import replace


def count_rows(df: DataFrame, name: str) -> tuple[Callable[[], int], DataFrame]:
    """``df`` and the number of its rows, counted by the action that writes it
    (of several, by the first)."""
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    return (lambda: seen.get["n"]), df.observe(seen, F.count(F.lit(1)).alias("n"))


def write_chunks(df: DataFrame, path: str, max_rows: int = 100_000, mode: str = "append") -> str:
    """A3: Parquet part files of at most ``max_rows`` rows each. Appends get
    unique part names, so a resumed run never overwrites earlier chunks."""
    df.write.option("maxRecordsPerFile", max_rows).mode(mode).parquet(path)
    return path


def write_ndjson(df: DataFrame, path: str, gzip: bool = False, mode: str = "append") -> str:
    """A4: one JSON object per line, NULL fields kept, non-ASCII kept."""
    w = df.write.mode(mode).option("ignoreNullFields", False)
    if gzip:
        w = w.option("compression", "gzip")
    w.json(path)
    return path


def _csv_writer(df: DataFrame, mode: str):
    # Spark's writer trims values unless told not to.
    return (df.write.mode(mode).option("header", True).option("quote", '"')
            .option("escape", '"').option("quoteAll", False)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_catalog(df: DataFrame, path: str) -> str:
    """The client catalogue as CSV files of one folder, replaced as a
    whole (``versions.replace``). The rows may come from ``path`` itself, and
    a job that dies on the way leaves the old rows or the new ones."""
    rows = df.select(*CLIENT_COLUMNS)
    replace(df.sparkSession, path, lambda folder: _csv_writer(rows, "errorifexists").csv(folder))
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    _csv_writer(df, mode).csv(path)
    return path


def write_labelled(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """The 17-column labelled table as Parquet or CSV."""
    out = df.select(*SLIM_COLUMNS)
    if fmt == "csv":
        _csv_writer(out, mode).csv(path)
    else:
        out.write.mode(mode).parquet(path)
    return path


def timestamped(base: str, ext: str = ".parquet", ts: str | None = None) -> str:
    ts = ts or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    return f"{base}_{ts}{ext}"


def write_merged(df: DataFrame, base: str, ts: str | None = None) -> str:
    """A10: merged dataset ``<base>_<timestamp>.parquet`` (snappy)."""
    path = timestamped(base, ".parquet", ts)
    df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    return path


def write_enriched(df: DataFrame, csv_path: str | None = None,
                   parquet_path: str | None = None) -> dict:
    """Enriched catalogue sinks."""
    out = {"out_csv": None, "out_parquet": None}
    if csv_path:
        out["out_csv"] = write_csv(df, csv_path)
    if parquet_path:
        df.write.mode("overwrite").parquet(parquet_path)
        out["out_parquet"] = parquet_path
    return out
