"""Registry records: landed API pages or NDJSON items -> one VARIANT per row.

A1 ``read_items`` and A2 ``page_meta``. A landed file holds API pages
(``{"data": [item, ...], "meta": {...}, "links": {...}}``), lookups of one
record (``{"data": {...}}``) or one item per line; gzip is handled by the
reader. Parsing happens once, into VARIANT, so all later field access is
binary path lookups without re-parsing text. What cannot be parsed and error
answers of the registry (``{"errors": ...}``) are never dropped silently:
``read_rejects`` lists them with their file and reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import query_param, vget, vstring


def _kind(v: Column) -> Column:
    """``malformed``, ``error``, ``page``, ``lookup`` or ``item`` (the commonest
    kind is told by one path lookup)."""
    def has(path, type_="variant"):
        return F.try_variant_get(v, path, type_).isNotNull()

    return (F.when(v.isNull(), "malformed").when(has("$.attributes"), "item")
            .when(has("$.data", "array<variant>"), "page").when(has("$.data", "map<string,variant>"), "lookup")
            .when(has("$.errors"), "error").when(has("$", "map<string,variant>"), "item").otherwise("malformed"))


def parsed_documents(lines: DataFrame, text_col: str = "value", source: bool = True) -> DataFrame:
    """``raw``, parsed ``v`` and ``kind`` of landed text; blank lines are no
    documents. With ``source``, the file as ``source_file``."""
    extra = [F.col("_metadata.file_path").alias("source_file")] if source else []
    parsed = lines.select(F.col(text_col).alias("raw"), F.try_parse_json(F.col(text_col)).alias("v"), *extra)
    return parsed.where(~F.col("raw").rlike(r"^\s*$")).withColumn("kind", _kind(F.col("v")))


def _only(documents: DataFrame, kinds: tuple, made: Column, name: str, keep: list[str]) -> DataFrame:
    """``made`` (an array) of the documents of some kinds, one row per element.
    Other documents give an empty array: a filter on the kind would be pushed
    below the parse and repeat it."""
    empty = F.slice(made, 1, 0)
    return documents.select(F.explode(F.when(F.col("kind").isin(*kinds), made).otherwise(empty)).alias(name), *keep)


def _found(v: Column, kind: Column) -> Column:
    """The items of a document as an array; NULL for a reject."""
    return (F.when(kind == "item", F.array(v)).when(kind == "page", F.try_variant_get(v, "$.data", "array<variant>"))
            .when(kind == "lookup", F.array(F.try_variant_get(v, "$.data", "variant"))))


def items_of(documents: DataFrame) -> DataFrame:
    """One item per row (``v``) of readable documents, with their other columns."""
    keep = [c for c in documents.columns if c not in ("v", "raw", "kind")]
    return documents.select(F.explode(_found(F.col("v"), F.col("kind"))).alias("v"), *keep)  # NULL (a reject) gives no row


def landed_of(documents: DataFrame) -> DataFrame:
    """Items and rejects of documents in one pass: one row per item (``v``) and
    one per document that holds none (``v`` NULL, with its ``reason``)."""
    kind = F.col("kind")
    reject = kind.isin("malformed", "error")
    found = F.when(reject, F.array(F.lit(None).cast("variant"))).otherwise(_found(F.col("v"), kind))
    keep = [c for c in documents.columns if c not in ("v", "kind")]
    return documents.select(F.explode(found).alias("v"), F.when(reject, kind).alias("reason"), *keep)


def rejected_of(documents: DataFrame) -> DataFrame:
    """Documents that hold no item: whole text, reason and other columns."""
    keep = [c for c in documents.columns if c not in ("v", "raw", "kind")]
    row = F.array(F.struct("raw", F.col("kind").alias("reason")))
    return _only(documents, ("malformed", "error"), row, "x", keep).select("x.raw", "x.reason", *keep)


def read_documents(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Landed documents, one per line (``multiline``: one per file)."""
    return parsed_documents(spark.read.text(path, wholetext=multiline))


def read_pages(spark: SparkSession, path, multiline: bool = False,
               with_source: bool = False) -> DataFrame:
    """Readable landed documents (pages, lookups or items), one VARIANT ``v``."""
    return _only(read_documents(spark, path, multiline), ("page", "lookup", "item"), F.array(F.col("v")), "v",
                 ["source_file"] if with_source else [])


def read_items(spark: SparkSession, path, multiline: bool = False,
               with_source: bool = False) -> DataFrame:
    """A1: one registry item per row in column ``v`` (pages are exploded, a
    lookup is its one record)."""
    items = items_of(read_documents(spark, path, multiline))
    return items if with_source else items.select("v")


def read_rejects(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """``raw, reason, source_file`` of the landed documents ``read_items`` leaves out."""
    return rejected_of(read_documents(spark, path, multiline))


def items_from_text(df: DataFrame, text_col: str = "raw", keep=()) -> DataFrame:
    """Parse a JSON text column (pages, lookups or items) into one item
    VARIANT per row; ``quarantine`` returns the rows that hold none."""
    # Parse once: the filter reads the parsed value, so it cannot be pushed
    # below the projection (which would parse every record twice).
    parsed = df.select(F.try_parse_json(F.col(text_col)).alias("v"), *keep).withColumn("kind", _kind(F.col("v")))
    return items_of(parsed)


def quarantine(df: DataFrame, text_col: str = "raw") -> DataFrame:
    """Input rows whose JSON text does not parse or is an error answer."""
    kind = _kind(F.try_parse_json(F.col(text_col)))
    return df.filter(F.col(text_col).isNotNull() & kind.isin("malformed", "error"))


def page_meta(pages: DataFrame, v: str = "v", keep=()) -> DataFrame:
    """A2: per landed page the announced total, item count, next link and
    the decoded ``page[cursor]`` of the next link."""
    nxt = vstring(v, "$.links.next")
    return pages.select(
        *keep,
        vget(v, "$.meta.total", "bigint").alias("total"),
        F.size(F.try_variant_get(F.col(v), "$.data", "array<variant>")).alias("n_items"),
        nxt.alias("next_url"),
        query_param(nxt, "page[cursor]").alias("next_cursor"),
    )
