"""Cleaning pipeline over ``documents``: toxicity, exact and near duplicates,
personal data, packing. Each stage calls one operator of ``metalake.llm``.

In every stage null texts count as empty, rows repeated under one id and null
ids are rows like any other, and an empty table stays empty. All stages but
the last return the columns of ``documents``, whatever else the table holds
besides ``doc_id`` and ``text``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metalake.llm.common import materialise, table
from metalake.llm.exact_dedup import drop_exact_duplicates
from metalake.llm.packing import pack_documents
from metalake.llm.pii import redact
from metalake.llm.queries import tokenizer_file
from metalake.llm.simhash import drop_near_duplicates
from metalake.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; without any label all stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z folded) the document with the largest id stays; of rows
    repeated under one id and text, one."""
    return drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every SimHash group the document with the smallest id stays (a null id
    only where the group has no other). Wordless texts form one group."""
    return drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its personal data are replaced by their kind in
    brackets, and ``n_chars`` follows the new text."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids; an empty text is one id."""
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", packing),
]

#: Models and fingerprints have no SQL form; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
