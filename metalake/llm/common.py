"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, scratch_path, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Python workers can import this package; scratch goes to the shared folder."""
    ship_package(spark)
    checkpoint_root(spark)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's shared ``spark.checkpoint.dir`` and read
    it back: the lineage is cut and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sieved(rows: DataFrame, wanted: DataFrame, column: str, bits: int = 1 << 25) -> DataFrame:
    """``rows`` whose ``column`` (never null) may be among that of ``wanted``: all
    that are, and few of the others.

    The hashes of the wanted values set bits of a bitmap of a fixed size (4 MB),
    which goes to all tasks, so that an exact join that follows shuffles little
    more than the rows it keeps. With far more wanted values than bits nothing
    is sieved out.
    """
    at = F.pmod(F.xxhash64(column), F.lit(bits)) + 1  # Spark numbers the bits of its bitmaps from 1
    bucket, bit = F.bitmap_bucket_number(at), F.bitmap_bit_position(at)
    maps = wanted.select(bucket.alias("_bucket"), bit.alias("_bit")).groupBy("_bucket").agg(
        F.bitmap_construct_agg("_bit").alias("_bitmap"))
    byte = F.conv(F.hex(F.substring("_bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (rows.withColumn("_bucket", bucket).join(F.broadcast(maps), "_bucket")
            .where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(rows.columns))


def text_bytes(col: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if x is None else x for x in col.cast(pa.binary()).to_pylist()]


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id has no remainder."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def held_out(doc_id: Column, modulus: int, left: int) -> Column:
    return F.coalesce(remainder(doc_id, modulus) == left, F.lit(False))


def arrow_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same batches cut to at most ``rows`` rows, so that the working set
    of one step stays small whatever the session's Arrow batch size is."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def arrow_bytes(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The same batches cut so that a text column holds about ``limit`` bytes:
    many short texts or one long one."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield b.slice(at, to - at)
            at = to


def row_key(doc_id: str) -> Column:
    """A join key that a null id has too."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def first_of_repeated(docs: DataFrame, tid: Column, stays: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (``id``, ``tid``) is in ``stays``, with all their
    columns; of rows repeated with one id and one text, the first."""
    here = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), tid.alias("tid"),
                       row_key("doc_id").alias("id"))
    nth = F.row_number().over(Window.partitionBy("id", "tid").orderBy(F.lit(1)))
    return here.join(stays, ["id", "tid"], "left_semi").withColumn("nth", nth).where("nth = 1").select("row.*")
