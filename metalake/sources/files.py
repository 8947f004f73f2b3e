"""File listing as DataFrames.

Listing uses the ``binaryFile`` source without its ``content`` column, so
only file metadata is read, on the cluster, from any Hadoop file system.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
])


def list_files(spark: SparkSession, roots, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """``path, modificationTime, length`` of every file under ``roots``.

    Missing roots are skipped (a warning in the source pipeline); a file
    reached through two overlapping roots is listed once.
    """
    roots = [roots] if isinstance(roots, str) else list(roots)
    frames = []
    for root in roots:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        try:
            frames.append(reader.load(root).select("path", "modificationTime", "length"))
        except AnalysisException as e:  # missing root: reported by the caller, not fatal
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if not frames:
        return spark.createDataFrame([], LISTING_SCHEMA)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.dropDuplicates(["path"])


def file_name(path_col) -> Column:
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.regexp_extract(p, r"([^/]*)$", 1)


def shard_files(spark: SparkSession, parents, name_contains: str = "",
                glob: str = "*.parquet") -> DataFrame:
    """A5: recursive ``*.parquet`` under each parent, optional file-name
    substring filter."""
    files = list_files(spark, parents, glob=glob)
    if name_contains:
        files = files.filter(F.instr(file_name("path"), name_contains) > 0)
    return files


def batch_files(spark: SparkSession, base: str, leaf_name: str,
                glob: str = "*.parquet") -> DataFrame:
    """Files below any folder named exactly ``leaf_name`` under ``base``."""
    files = list_files(spark, base, glob=glob)
    pattern = r"^(.*/" + _re_escape(leaf_name) + r")/"
    return (files.withColumn("batch_dir", F.regexp_extract("path", pattern, 1))
            .filter(F.col("batch_dir") != ""))


def _re_escape(s: str) -> str:
    return re.escape(s)


# --- fixed values: how run folders and files name their dates ---------------
#: A day; the most characters between two days that belong together; the words
#: before the first and the second day where both are named, each followed by
#: one separator or none.
_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_NEAR = 5
_OPENING, _CLOSING = "from", "until"
_SEPARATORS = ("_", "-")


def _without_separator(text: Column) -> Column:
    last = F.right(text, F.lit(1)).isin(*_SEPARATORS)
    return F.when(last, F.left(text, F.length(text) - 1)).otherwise(text)


def _day_pairs(text: Column) -> Column:
    """All neighbouring days of a text with what stands before and between them."""
    days, around = F.regexp_extract_all(text, F.lit(_DAY), F.lit(0)), F.split(text, _DAY, -1)
    return F.transform(F.slice(days, 2, F.greatest(F.size(days) - 1, F.lit(0))), lambda end, i: F.struct(
        F.get(days, i).alias("start"), end.alias("end"), _without_separator(F.get(around, i)).alias("before"),
        F.get(around, i + 1).alias("between")))


def run_date_range(path_col) -> Column:
    """``struct(start, end)`` of a run folder or file, NULLs without one.

    Two forms are known: ``2020-01-01_2020-02-01``, two days at most five
    characters apart, and ``from_2020-01-01_until_2020-02-01``, where "from"
    stands before the first day and "until" before the second, with at most
    five characters between the first day and "until". The last part of the
    path is searched for the first form, then for the second; then the whole
    path likewise. Of several pairs the first counts.
    """
    path = F.col(path_col) if isinstance(path_col, str) else path_col

    def near(pair: Column) -> Column:
        return F.length(pair["between"]) <= _NEAR

    def named(pair: Column) -> Column:
        between = _without_separator(pair["between"])
        return (pair["before"].endswith(_OPENING) & between.endswith(_CLOSING)
                & (F.length(between) <= _NEAR + len(_CLOSING)))

    found = F.coalesce(*[F.get(F.filter(_day_pairs(text), form), F.lit(0))
                         for text in (file_name(path), path) for form in (near, named)])
    return F.struct(found["start"].alias("start"), found["end"].alias("end"))


def latest_dataset(spark: SparkSession, directory: str, prefix: str, ext: str) -> DataFrame:
    """The newest entry ``prefix*ext`` directly under ``directory``.

    An entry is a file or a dataset folder (its newest file counts). One row
    ``name, path, modificationTime``; raises when nothing matches.
    """
    directory = directory.rstrip("/")
    files = list_files(spark, directory)
    # The listing returns qualified URIs; match on the directory's path part.
    dir_path = re.sub(r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "", directory) or "/"
    entry = F.regexp_extract("path", r"^(.*?" + _re_escape(dir_path) + r"/[^/]+)", 1)
    cand = (files.withColumn("entry", entry)
            .withColumn("name", file_name("entry"))
            .filter(F.col("name").startswith(prefix) & F.col("name").endswith(ext))
            .groupBy("name", "entry").agg(F.max("modificationTime").alias("modificationTime")))
    top = cand.orderBy(F.desc("modificationTime"), F.desc("name")).limit(1)
    if top.isEmpty():
        raise FileNotFoundError(f"No entries like {prefix}*{ext} in {directory}")
    return top.select("name", F.col("entry").alias("path"), "modificationTime")
