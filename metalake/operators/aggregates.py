"""Counts, distincts, summaries and unions.

Every group-by here is a hash aggregation with a partial (map-side) step,
so a key holding a large share of rows is pre-counted in each input
partition and ships one row per partition to the final aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import sorted_distinct
from .select import nonblank_ids


def distinct_client_ids(df: DataFrame, column: str = "client_id",
                        max_clients: int | None = None) -> DataFrame:
    """Distinct non-blank stripped ids, ascending; ``max_clients``
    keeps the first N of them."""
    return sorted_distinct(nonblank_ids(df, column), column, max_clients)


def providers_summary(catalog: DataFrame) -> DataFrame:
    """F2/D3: clients per provider (``""`` providers left out), most first."""
    return (catalog.filter(F.col("provider_id") != "")
            .groupBy("provider_id").agg(F.count(F.lit(1)).alias("n_clients"))
            .orderBy(F.desc("n_clients"), F.asc("provider_id")))


def run_summary(rows: DataFrame, catalog: DataFrame, column: str = "client_id") -> DataFrame:
    """scanned (non-blank) rows, unique ids, ids new to the catalogue, in
    one aggregation chain (per-id counts, one lookup join, one sum)."""
    per_id = nonblank_ids(rows, column).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    known = catalog.select(F.col("id").alias("_known")).distinct().withColumn("_hit", F.lit(1))
    flagged = per_id.join(known, F.col(column) == F.col("_known"), "left")
    return flagged.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("scanned_rows"),
        F.count(F.lit(1)).alias("unique_client_ids"),
        F.count_if(F.col("_hit").isNull()).alias("new_clients"),
    )


def trend_per_year(df: DataFrame, column: str = "published_year") -> DataFrame:
    """records per year, years ascending (NULL years left out)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).orderBy(column))


def top_values(df: DataFrame, column: str = "provider_id", n: int | None = None) -> DataFrame:
    """value counts, NULLs dropped, most frequent first (ties by value);
    ``n`` keeps the top N (the report's purpose)."""
    out = (df.filter(F.col(column).isNotNull()).groupBy(column)
           .agg(F.count(F.lit(1)).alias("n_records"))
           .orderBy(F.desc("n_records"), F.asc(column)))
    return out.limit(n) if n else out


def completeness(df: DataFrame, columns=None) -> DataFrame:
    """NULL share per column, ascending; one pass over the data (one
    aggregate row), then unpivoted to one row per column."""
    cols = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n__{i}") for i, c in enumerate(cols)])
    stacked = agg.select("n_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n__{i}").alias("n_null"))
        for i, c in enumerate(cols)])).alias("s"))
    return (stacked.select(F.col("s.column").alias("column"), "n_rows", F.col("s.n_null").alias("n_null"))
            .withColumn("null_share", F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows")))
            .orderBy("null_share", "column"))


def duplicate_stats(df: DataFrame, key: str = "doi") -> DataFrame:
    """F8: rows, distinct keys, rows beyond the first per key (NULL is a
    value) and the duplicate rate."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
    ).withColumn("dup_rate", F.when(F.col("n_rows") > 0, F.col("n_duplicates") / F.col("n_rows")))


def union_all(frames) -> DataFrame:
    """UNION ALL by column name; columns missing on one side are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(frames))
