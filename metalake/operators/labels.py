"""Label records with the server name and helper years, then slim
them to the fixed 17-column layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import year_from_iso
from ..schema import SLIM_COLUMNS
from .joins import label_server_name


def slim(df: DataFrame) -> DataFrame:
    """The 17 columns in order; absent ones are added as NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in SLIM_COLUMNS])


def label_records(rows: DataFrame, catalog: DataFrame, keep_existing: bool = False) -> DataFrame:
    """E3 + C9 + C10: ``server_name``, ``created_year``, ``registered_year``
    (string years, NULL unless the text starts with four digits)."""
    out = label_server_name(rows, catalog, keep_existing=keep_existing)
    for src, dst in (("created", "created_year"), ("registered", "registered_year")):
        out = out.withColumn(dst, year_from_iso(F.col(src)) if src in out.columns
                             else F.lit(None).cast("string"))
    return slim(out)
