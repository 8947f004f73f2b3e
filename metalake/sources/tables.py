"""Tabular inputs: client-id scans, the client catalogue, curated sheets.

Catalogue and sheet follow the text convention "missing = empty string":
every column is a string and NULL becomes ``""``. Only an empty field is
missing; words like ``NA`` or ``None`` stay text (pandas would blank them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import CLIENT_COLUMNS, CLIENT_SCHEMA
from ..versions import current


def _csv(spark: SparkSession, multiline: bool):
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("multiLine", multiline).option("escape", '"').option("quote", '"'))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder as strings; large files are read by many tasks.

    A file may be cut at line ends unless a quoted field holds one. Such a
    field opens a quote in its first line and closes it in a later one, so
    that both have an odd number of quotes (escaped ones come in pairs): one
    pass over the lines tells which files have such a line, and only these are
    read by one task each.
    """
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    whole = [r[0] for r in spark.read.text(path).where(odd).select(F.col("_metadata.file_path")).distinct().collect()]
    if not whole:
        return _csv(spark, False).csv(path)
    wide = _csv(spark, True).csv(path)
    here = F.col("_metadata.file_path").isin(whole)
    plain = _csv(spark, False).schema(wide.schema).csv(path)
    return _with_place(plain.where(~here)).unionByName(_with_place(wide.where(here)))


def _with_place(df: DataFrame) -> DataFrame:
    """``_file`` and ``_line``, which order the rows of a file: the place of the
    split in the file, then the row in the split."""
    if "_file" in df.columns:
        return df
    return df.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_metadata.file_path").alias("_file"),
                     F.struct(F.col("_metadata.file_block_start").alias("split"),
                              F.monotonically_increasing_id().alias("row")).alias("_line"))


def read_client_ids(spark: SparkSession, path: str) -> DataFrame:
    """The single ``client_id`` column of a Parquet or CSV dataset
    (column pruning keeps the scan to that one column)."""
    if path.rstrip("/").lower().endswith(".csv"):
        return read_csv(spark, path).select("client_id")
    return spark.read.parquet(path).select("client_id")


def read_catalog(spark: SparkSession, path: str | None) -> DataFrame:
    """The client catalogue CSV as 20 strings, NULL -> ``""``.

    A path that never held one gives an empty catalogue with the 20 columns.
    Any other failure (no access, unknown file system, the remains of a broken
    replacement) is raised: taken for "empty", it would cost a catalogue its
    rows.
    """
    where = current(spark, path) if path else None
    if where is None:
        return spark.createDataFrame([], CLIENT_SCHEMA)
    df = read_csv(spark, where)
    cols = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in df.columns
            else F.lit("").alias(c) for c in CLIENT_COLUMNS]
    return df.select(*cols)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """An exported sheet CSV, all strings, NULL -> ``""``.

    ``_line`` is the order for keep-first rules: a column of that name in the
    sheet (a sheet written as several files carries one), else the order in
    the file.
    """
    df = read_csv(spark, path)
    texts = [c for c in df.columns if c not in ("_line", "_file")]
    cols = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in texts]
    if "_line" in df.columns and not isinstance(df.schema["_line"].dataType, StructType):
        line = F.struct(F.lit(0).cast("long").alias("split"), F.col("_line").cast("long").alias("row"))
        return df.select(*cols, F.lit("").alias("_file"), line.alias("_line"))
    placed = _with_place(df)
    return placed.select(*cols, "_file", "_line")
