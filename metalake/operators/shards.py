"""Harmonise drifting Parquet shards and report on them.

Shards written by pandas drift: ``published_year`` is int64 in one file and
double in the next, an all-NULL column has a NULL/int footer type next to
string files, a column is missing or extra. A single Spark scan (with or
without ``mergeSchema``, with or without an explicit schema) rejects such a
set, and a scan per layout plans as many scans as there are layouts.

So the footers are read on the executors, once, and kept: they hold rows,
row groups, sizes and column statistics, which is all that the reports need.
The data come in one pass whatever the number of layouts: the unit of work is
a range of row groups of one file; a task reads its units and puts every
column into the slot of its name and stored type, and one projection casts
the slots to the fixed target. The driver sees the distinct (column, type)
pairs, never a path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema

from ..schema import SHARD_TYPE_OVERRIDES, WIDE_COLUMNS
from ..session import MB, local_path, scratch_path
from ..sources.files import file_name

_COLUMN = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
                        T.StructField("n_null", T.LongType()), T.StructField("low", T.StringType()),
                        T.StructField("high", T.StringType())])
FOOTER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("schema_key", T.StringType()),
    T.StructField("columns", T.ArrayType(_COLUMN)), T.StructField("n_rows", T.LongType()),
    T.StructField("n_groups", T.IntegerType()), T.StructField("bytes", T.LongType()),
    T.StructField("readable", T.BooleanType()), T.StructField("error", T.StringType())])
#: Hadoop's names of file systems that the footer reader knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def _open(path: str):
    """A shard on the executor. An unknown or unreachable file system fails the
    job: it is no property of the file."""
    import pyarrow.parquet as pq
    local = local_path(path)
    if local is not None:
        return pq.ParquetFile(local)
    import pyarrow.fs as pafs
    scheme, rest = path.split("://", 1)
    fs, inner = pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")
    return pq.ParquetFile(inner, filesystem=fs)


def _spark_type(t: pa.DataType) -> str:
    """The type under which a stored column reaches Spark; types that Spark
    does not have come as text."""
    if pa.types.is_dictionary(t):
        return _spark_type(t.value_type)
    if pa.types.is_unsigned_integer(t):
        return "decimal(20,0)" if t.bit_width == 64 else "bigint"
    try:
        return from_arrow_type(t).simpleString()
    except Exception:  # noqa: BLE001 - whatever pyspark raises for a type it lacks
        return "string"


def _footer(path: str) -> dict:
    with _open(path) as file:
        meta, fields = file.metadata, list(file.schema_arrow)
        columns = {f.name: {"name": f.name, "type": _spark_type(f.type), "n_null": None, "low": None, "high": None} for f in fields}
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for i in range(group.num_columns):
                chunk = group.column(i)
                col, stats = columns.get(chunk.path_in_schema), chunk.statistics
                if col is None or stats is None:
                    continue
                if stats.has_null_count:
                    col["n_null"] = (col["n_null"] or 0) + stats.null_count
                if stats.has_min_max:
                    low, high = stats.min, stats.max
                    col["_low"] = min(col.get("_low", low), low)
                    col["_high"] = max(col.get("_high", high), high)
        for col in columns.values():
            low, high = col.pop("_low", None), col.pop("_high", None)
            col["low"], col["high"] = (None if x is None else str(x) for x in (low, high))
        return {"path": path, "schema_key": "|".join(f"{f.name}:{f.type}" for f in fields), "columns": list(columns.values()),
                "n_rows": meta.num_rows, "n_groups": meta.num_row_groups,
                "bytes": sum(meta.row_group(g).total_byte_size for g in range(meta.num_row_groups)),
                "readable": True, "error": None}


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(FOOTER_SCHEMA)
    for batch in batches:
        rows = []
        for path in batch.column(0).to_pylist():
            try:
                rows.append(_footer(path))
            except pa.ArrowInvalid as exc:  # not a readable Parquet file: reported per file (G3)
                rows.append({"path": path, "readable": False, "error": f"{type(exc).__name__}: {exc}"})
        yield from pa.Table.from_pylist(rows, schema).to_batches()


def read_footers(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """Per listed file: layout key, columns with their statistics, rows, row
    groups, uncompressed bytes, and whether it can be read; no data page is
    touched. Kept in the shared folder for everything that asks later."""
    n = max(1, spark.sparkContext.defaultParallelism)
    kept = scratch_path(spark, "shard-footers")
    listing.select("path").repartition(n).mapInArrow(_read_footers, FOOTER_SCHEMA).write.parquet(kept)
    return spark.read.schema(FOOTER_SCHEMA).parquet(kept)


def _widen(types: list[T.DataType]) -> T.DataType:
    real = [t for t in types if not isinstance(t, T.NullType)]
    if not real:
        return T.StringType()
    if any(isinstance(t, T.StringType) for t in real):
        return T.StringType()
    if all(isinstance(t, T.NumericType) for t in real):
        if any(isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)) for t in real):
            return T.DoubleType()
        return T.LongType()
    return real[0]


def default_target(col: str) -> T.DataType | None:
    if col in SHARD_TYPE_OVERRIDES:
        return SHARD_TYPE_OVERRIDES[col]
    if col in WIDE_COLUMNS:
        return T.StringType()
    return None


@dataclass
class ShardSet:
    data: DataFrame        # unified rows (``_source_file`` when requested)
    files: DataFrame       # per file: what ``read_footers`` gives
    target: T.StructType   # the unified schema
    rejects: DataFrame     # per file and column: values that do not fit the target


def _units(files: DataFrame, unit_bytes: int) -> DataFrame:
    """``path, low, high``: ranges of row groups of about ``unit_bytes``, dealt
    to so many tasks that each gets about that much (a file costs 4 MB to open)."""
    groups = F.greatest(F.lit(1), F.floor(F.col("n_groups") * unit_bytes / F.greatest(F.col("bytes"), F.lit(1)))).cast("int")
    some = files.where("readable AND n_groups > 0").withColumn("_per", F.least(groups, F.col("n_groups")))
    units = some.select("path", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1, F.col("_per"))).alias("low"),
                        "_per", "n_groups").select("path", "low", F.least(F.col("low") + F.col("_per"), F.col("n_groups")).alias("high"))
    total = some.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1)),
                     F.coalesce(F.sum(F.ceil(F.col("n_groups") / F.col("_per"))), F.lit(0))).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    return units.repartition(max(1, -(-(total[0] + 4 * MB * total[1]) // unit_bytes), min(int(total[2]), cores)))


def _slots(units: DataFrame, slots: list[tuple[str, str]]) -> DataFrame:
    """Rows of the units: ``_source_file`` and a column for every slot, filled
    where the file stores the slot's column under the slot's type."""
    schema = T.StructType([T.StructField("_source_file", T.StringType())] + [
        T.StructField(f"_{i}", T.StructType.fromDDL(f"x {t}")["x"].dataType) for i, (_, t) in enumerate(slots)])
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, low, high in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with _open(path) as file:
                    stored = {f.name: _spark_type(f.type) for f in file.schema_arrow}
                    have = sorted({c for c, t in slots if stored.get(c) == t})
                    for part in file.iter_batches(batch_size=8192, row_groups=range(low, high), columns=have):
                        cols = [pa.repeat(pa.scalar(path, pa.string()), part.num_rows)]
                        for (name, t), field in zip(slots, list(arrow)[1:]):
                            cols.append(part.column(name).cast(field.type, safe=False) if stored.get(name) == t
                                        else pa.nulls(part.num_rows, field.type))
                        yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return units.mapInArrow(read, schema)


def unify_shards(spark: SparkSession, listing: DataFrame, target_types=default_target, with_source: bool = False,
                 columns: list[str] | None = None, unit_bytes: int = 128 * MB) -> ShardSet:
    """One DataFrame over all readable shards under a fixed schema, read
    in one pass. ``columns`` limits what is read from the files."""
    files = read_footers(spark, listing)
    seen = (files.where("readable").select("path", F.posexplode("columns").alias("pos", "c"))
            .groupBy("c.name", "c.type").agg(F.min(F.struct("path", "pos")).alias("first")).orderBy("first").collect())
    if not seen and files.where("readable").isEmpty():
        raise RuntimeError("No readable .parquet files found.")
    found: dict[str, list[str]] = {}  # columns in first-seen order, with their stored types
    for r in seen:
        if columns is None or r["name"] in columns:
            found.setdefault(r["name"], []).append(r["type"])
    kinds = {name: [T.StructType.fromDDL(f"x {t}")["x"].dataType for t in types] for name, types in found.items()}
    target = T.StructType([T.StructField(c, (target_types(c) if target_types else None) or _widen(kinds[c]), True) for c in found])
    slots = [(c, t) for c, types in found.items() for t in types if t != "void"]
    rows = _slots(_units(files, unit_bytes), slots)
    place = {slot: F.col(f"_{i}") for i, slot in enumerate(slots)}
    made, lost = [], []
    for want in target.fields:
        fits = [(place[want.name, t], _fitted(place[want.name, t], k, want.dataType))
                for t, k in zip(found[want.name], kinds[want.name]) if t != "void"]
        made.append(F.coalesce(F.lit(None).cast(want.dataType), *[c for _, c in fits]).alias(want.name))
        lost += [(want.name, raw.isNotNull() & c.isNull()) for (raw, c), k in zip(fits, [k for k in kinds[want.name] if not isinstance(k, T.NullType)])
                 if k != want.dataType]
    data = rows.select(*made, *(["_source_file"] if with_source else []))
    if not lost:
        return ShardSet(data, files, target, spark.createDataFrame([], "path string, column string, n_rejected bigint"))
    misfits = (rows.select(F.col("_source_file").alias("path"), F.explode(F.filter(F.array(*[
        F.when(bad, F.lit(name)) for name, bad in lost]), lambda x: x.isNotNull())).alias("column"))
        .groupBy("path", "column").agg(F.count(F.lit(1)).alias("n_rejected")))
    return ShardSet(data, files, target, misfits)


def _fitted(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value under the target type: nested ones as JSON text, and NULL (a
    reject) where the value does not fit."""
    nested = isinstance(have, (T.StructType, T.ArrayType, T.MapType))
    if nested and isinstance(want, T.StringType):
        return F.to_json(c)
    return F.lit(None).cast(want) if nested else c.try_cast(want)


def shard_report(files: DataFrame | ShardSet, max_rows: int | None = None,
                 chunk_pattern: str = r"chunk_(\d+)") -> DataFrame:
    """F4 + G8 per file, from the footers alone: rows (0 for empty files, NULL
    when unreadable), bytes, empty and over-limit flags, chunk index from the
    name, a gap before it within its folder, repeated file names, and whether
    its columns and types are those of most files."""
    files = files.files if isinstance(files, ShardSet) else files
    name = file_name("path")
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    idx = F.regexp_extract(name, chunk_pattern, 1)
    rep = (files.withColumn("file_name", name).withColumn("folder", folder)
           .withColumn("chunk_index", F.when(idx != "", idx.cast("bigint"))))
    w = Window.partitionBy("folder").orderBy("chunk_index")
    wn = Window.partitionBy("file_name")
    common = (rep.where("readable").groupBy("schema_key").count()
              .orderBy(F.desc("count"), "schema_key").limit(1).select(F.col("schema_key").alias("_common")))
    rep = rep.join(F.broadcast(common), F.col("schema_key") == F.col("_common"), "left")  # one row
    limit_ok = (F.col("n_rows") <= F.lit(max_rows)) if max_rows else F.lit(True)
    return rep.select(
        "path", "file_name", "folder", "readable", "error", "schema_key", "n_rows", "bytes",
        (F.col("n_rows") == 0).alias("empty"),
        (~limit_ok).alias("over_limit"),
        "chunk_index",
        F.coalesce(F.col("chunk_index") - F.lag("chunk_index").over(w) > 1, F.lit(False))
        .alias("gap_before"),
        (F.count(F.lit(1)).over(wn) > 1).alias("repeated_name"),
        F.col("_common").isNotNull().alias("schema_equal"),
    )


def shard_columns(files: DataFrame | ShardSet, expected=WIDE_COLUMNS) -> DataFrame:
    """G9 over shards: one row per readable file and column, expected or not:
    stored type, NULLs, smallest and largest value from the footer, and
    ``problem`` (``missing``, ``unexpected`` or NULL)."""
    files = (files.files if isinstance(files, ShardSet) else files).where("readable")
    wanted = F.array(*[F.lit(c) for c in expected])
    stored = files.select("path", "n_rows", F.explode("columns").alias("c")).select(
        "path", "n_rows", F.col("c.name").alias("column"), "c.type", "c.n_null", "c.low", "c.high",
        F.when(~F.array_contains(wanted, F.col("c.name")), "unexpected").alias("problem"))
    absent = files.select("path", "n_rows", F.explode(F.array_except(wanted, F.col("columns.name"))).alias("column"),
                          F.lit("missing").alias("problem"))
    return stored.unionByName(absent, allowMissingColumns=True)
