"""Completeness, coverage, schema and growth checks.

All per-column checks are computed in a single aggregation pass over the
data; thresholds are a small literal table joined to the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import duplicate_stats
from ..schema import COVERAGE_TARGETS, DATE_COLUMNS, REQUIRED_COLUMNS, WIDE_COLUMNS

DATE_RE = r"^\d{4}-\d{2}-\d{2}$"


def column_check(df: DataFrame, expected=WIDE_COLUMNS) -> DataFrame:
    """Unexpected and missing columns against the expected list (schema
    metadata only; no data is read)."""
    spark = df.sparkSession
    have = list(df.columns)
    rows = [("unexpected", c) for c in have if c not in expected]
    rows += [("missing", c) for c in expected if c not in have]
    return spark.createDataFrame(rows, "problem string, column string")


def quality_gates(df: DataFrame, required=REQUIRED_COLUMNS, coverage=COVERAGE_TARGETS,
                  date_columns=DATE_COLUMNS) -> DataFrame:
    """G4 + G5 + G10 in one pass.

    One row per check and column: ``n_rows``, ``n_hits`` (NULLs for
    ``required``, non-NULLs for ``coverage``, non-normalised dates for
    ``dates``), ``target`` and ``passed``. Coverage passes when the share of
    non-NULL rows is strictly above the target.
    """
    spark = df.sparkSession
    specs = ([("required", c, F.count_if(F.col(c).isNull()), None) for c in required] +
             [("coverage", c, F.count_if(F.col(c).isNotNull()), t) for c, t in coverage] +
             [("dates", c, F.count_if(F.col(c).isNotNull() & ~F.col(c).rlike(DATE_RE)), None)
              for c in date_columns])
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[e.alias(f"h__{i}") for i, (_, _, e, _) in enumerate(specs)])
    stacked = agg.select("n_rows", F.explode(F.array(*[
        F.struct(F.lit(chk).alias("check"), F.lit(c).alias("column"), F.col(f"h__{i}").alias("n_hits"))
        for i, (chk, c, _, _) in enumerate(specs)])).alias("s")).select("s.*", "n_rows")
    targets = spark.createDataFrame([(chk, c, t) for chk, c, _, t in specs],
                                    "check string, column string, target double")
    out = stacked.join(F.broadcast(targets), ["check", "column"], "left")
    passed = (F.when(F.col("check") == "coverage",
                     F.col("n_hits") > F.col("target") * F.col("n_rows"))
              .otherwise(F.col("n_hits") == 0))
    return out.withColumn("passed", passed).select(
        "check", "column", "n_rows", "n_hits", "target", "passed")


def yearly_growth(df: DataFrame, year_col, surge_factor: float = 2.0) -> DataFrame:
    """Records per year, previous year's count, growth and a surge flag
    (count above ``surge_factor`` x the previous year).

    The window runs over the per-year counts (one row per year), never over
    the records themselves.
    """
    year = F.col(year_col) if isinstance(year_col, str) else year_col
    counts = (df.select(year.alias("year")).filter(F.col("year").isNotNull())
              .groupBy("year").agg(F.count(F.lit(1)).alias("n_records")))
    w = Window.partitionBy(F.lit(0)).orderBy("year")
    prev = F.lag("n_records").over(w)
    return (counts.withColumn("prev_n", prev)
            .withColumn("growth", F.when(F.col("prev_n") > 0,
                                         (F.col("n_records") - F.col("prev_n")) / F.col("prev_n")))
            .withColumn("surge", F.coalesce(F.col("n_records") > F.lit(surge_factor) * F.col("prev_n"),
                                            F.lit(False)))
            .orderBy("year"))


def counts_vs_external(ours: DataFrame, theirs: DataFrame, key: str,
                       ours_col: str = "n_ours", theirs_col: str = "n_external") -> DataFrame:
    """Full outer join of two per-key count tables, difference and the
    share of our count in theirs."""
    a = ours.groupBy(key).agg(F.count(F.lit(1)).alias(ours_col))
    b = theirs.groupBy(key).agg(F.count(F.lit(1)).alias(theirs_col))
    j = a.join(b, key, "full_outer")
    return (j.withColumn(ours_col, F.coalesce(F.col(ours_col), F.lit(0)).cast("bigint"))
            .withColumn(theirs_col, F.coalesce(F.col(theirs_col), F.lit(0)).cast("bigint"))
            .withColumn("diff", F.col(ours_col) - F.col(theirs_col))
            .withColumn("ratio", F.when(F.col(theirs_col) > 0, F.col(ours_col) / F.col(theirs_col))))


def duplicate_gate(df: DataFrame, key: str = "doi", limit: float = 0.01) -> DataFrame:
    """Whether the share of rows beyond the first per key stays under ``limit``."""
    return (duplicate_stats(df, key).withColumn("limit_rate", F.lit(float(limit)))
            .withColumn("passed", F.coalesce(F.col("dup_rate") < limit, F.lit(True))))


def share_vs_expected(df: DataFrame, expected: DataFrame, column: str = "provider_id",
                      tolerance: float = 0.05) -> DataFrame:
    """The share of rows each value holds against the share expected of it
    (``value``, ``expected_share``); values on one side only count as 0 on the
    other. NULLs belong to no value but to the whole."""
    got = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))
    whole = got.agg(F.sum("n_records").alias("n")).first()["n"] or 0
    both = got.where("value IS NOT NULL").join(expected, "value", "full_outer")
    share = F.coalesce(F.col("n_records"), F.lit(0)) / F.lit(float(max(whole, 1)))
    want = F.coalesce(F.col("expected_share"), F.lit(0.0))
    return both.select("value", F.coalesce("n_records", F.lit(0)).cast("bigint").alias("n_records"), share.alias("share"),
                       want.alias("expected_share"), (F.abs(share - want) <= tolerance).alias("passed"))
