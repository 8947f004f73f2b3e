"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import duckdb

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, `grp` string, `row.id, x` string, "
              "fp long")

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, "THE QUICK brown fox jumps over the lazy dog"),
    (2, "THE QUICK brown fox jumps over the lazy dog"),
    (3, None),
    (4, ""),
    (None, "a text without an id"),
    (None, "a text without an id"),
    (None, None),
    (5, "one"),
    (6, " \t\n "),
    (7, "two  spaces and\ttabs\nand lines "),
    (8, "Éa ÉA éa naïve café 😀 ß"),
    (9, LONG),
    (10, LONG + " tail"),
    (11, "x" * 5000),
    (9, "another text of one id"),
]


def docs(spark, rows=AWKWARD, langs=None):
    langs = langs or ["en"] * len(rows)
    return spark.createDataFrame(
        [(i, t, lg, None, None, "clash", "clash", 7) for (i, t), lg in zip(rows, langs)], DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def texts(sf_dir):
    return duckdb.connect().execute(f"SELECT doc_id, text FROM read_parquet('{sf_dir}/documents.parquet')").fetchall()
