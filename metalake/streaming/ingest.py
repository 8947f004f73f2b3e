"""H1/H2: resumable incremental ingest and a continuously maintained
"best row per key", on Structured Streaming.

* H1 ``ingest_records``: the landing folder is a file stream; every
  micro-batch is parsed once and written by one job into one Parquet table,
  its wide rows and its rejects side by side, under a partition of the
  batch's own. The checkpoint location records which files were consumed, so
  a restart continues where it stopped; a batch that is replayed after a
  failure overwrites its own partition, so nothing is lost or doubled (the
  position bookkeeping of a page-cursor harvester, done by the engine).
* H2 ``maintain_best_rows``: a streaming ``min_by`` aggregation keeps the
  best row per key in the state store (RocksDB). ``read_best_state`` reads
  that store; where a log of updates is wanted too, each batch appends only
  the keys it changed.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.utils import AnalysisException

from ..functions import is_missing, vget
from ..operators.dedup import richness, tie_hash, top1
from ..operators.flatten import flatten_items
from ..schema import WIDE_COLUMNS, WIDE_SCHEMA
from ..sources.items import items_of, landed_of, parsed_documents

#: An ingested table: wide rows, reject columns, and its two partition columns.
INGEST_SCHEMA = T.StructType(
    list(WIDE_SCHEMA) + [T.StructField(c, T.StringType()) for c in ("raw", "reason", "source_file")]
    + [T.StructField("batch_id", T.LongType()), T.StructField("outcome", T.StringType())])


#: How long the listener bus may lag behind a query that has ended.
EVENTS_S = 300


class _Totals(StreamingQueryListener):
    """Batches and input rows of one query, counted event by event: a query's
    own progress history keeps only its last entries."""

    def __init__(self, name: str):
        self.name, self.run, self.batches, self.rows = name, None, 0, 0
        self.ended = threading.Event()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event):
        if event.progress.runId == self.run:
            self.batches += 1
            self.rows += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId == self.run:
            self.ended.set()


def run_available(spark: SparkSession, writer, start) -> dict:
    """Run a stream over everything available and return its totals."""
    totals = _Totals(f"available-{threading.get_ident()}-{id(writer)}")
    spark.streams.addListener(totals)
    try:
        start(writer.queryName(totals.name).trigger(availableNow=True)).awaitTermination()
        # Events arrive after the query itself has ended; totals without the
        # last of them would be short.
        if not totals.ended.wait(EVENTS_S):
            raise TimeoutError(f"the stream ended, but its progress events did not arrive within {EVENTS_S} s")
    finally:
        spark.streams.removeListener(totals)
    return {"batches": totals.batches, "rows": totals.rows}


def document_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                    multiline: bool = False) -> DataFrame:
    """Landed documents (``raw``, parsed ``v``, ``source_file``) as a stream."""
    reader = spark.readStream.format("text")
    if multiline:
        reader = reader.option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parsed_documents(reader.load(landing_dir))


def record_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                  multiline: bool = False) -> DataFrame:
    """Streaming items (``v``) from landed pages / NDJSON files."""
    return items_of(document_stream(spark, landing_dir, max_files_per_trigger, multiline)).select("v")


def landed_rows(documents: DataFrame) -> DataFrame:
    """Items (``v``) and rejects (``raw`` with ``reason``) of parsed documents,
    with their ``source_file``, in one pass over them."""
    kept = F.when(F.col("reason").isNull(), F.lit(None)).otherwise(F.col("raw"))
    return landed_of(documents).select("v", kept.alias("raw"), "reason", "source_file")


def write_landed(batch: DataFrame, batch_id: int, out_dir: str, max_rows_per_file: int, partitions: int | None = None) -> None:
    """One micro-batch of ``landed_rows`` as the partition of its own. The
    same batch written again replaces it, whatever the session's overwrite mode."""
    rows = batch.repartition(partitions) if partitions else batch
    rows = rows.where(F.col("reason").isNotNull() | ~is_missing(vget("v", "$.attributes")))
    wide = flatten_items(rows, keep=["raw", "reason", "source_file"], drop_without_attributes=False)
    outcome = F.when(F.col("reason").isNull(), "item").otherwise("reject")
    (wide.withColumns({"batch_id": F.lit(batch_id).cast("long"), "outcome": outcome})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_rows_per_file)
     .partitionBy("batch_id", "outcome").parquet(out_dir))


def ingest_records(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_dir: str,
                   max_files_per_trigger: int | None = None, multiline: bool = False,
                   max_rows_per_file: int = 100_000, partitions: int | None = None) -> dict:
    """H1: flatten everything landed so far into ``out_dir`` and stop
    (``availableNow``); run again later to pick up only new files.

    ``read_ingested`` gives the wide rows, ``read_ingest_rejects`` the
    malformed and error documents with file and reason. ``partitions``
    round-robins each micro-batch's rows before the flatten, for landings of
    a few large gzip files (one task per file otherwise).
    """
    rows = landed_rows(document_stream(spark, landing_dir, max_files_per_trigger, multiline))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_landed(batch, batch_id, out_dir, max_rows_per_file, partitions)

    done = run_available(spark, rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir),
                         lambda w: w.start())
    # Input rows of a text stream are landed documents (pages), not items.
    return {"batches": done["batches"], "input_docs": done["rows"]}


def _ingested(spark: SparkSession, out_dir: str, outcome: str) -> DataFrame:
    return (spark.read.schema(INGEST_SCHEMA).option("basePath", out_dir).parquet(out_dir)
            .where(F.col("outcome") == outcome))


def read_ingested(spark: SparkSession, out_dir: str) -> DataFrame:
    """The wide rows of all batches."""
    return _ingested(spark, out_dir, "item").select(*WIDE_COLUMNS)


def read_ingest_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """``raw, reason, source_file`` of the landed documents that hold no item."""
    return _ingested(spark, out_dir, "reject").select("raw", "reason", "source_file")


# ----------------------------------------------- H2 on the state store

def best_row_order(rich, order, tie_break: str | None = None, columns=None) -> Column:
    """An orderable struct whose minimum is the D1 winner: fewest missing
    ``rich`` values first, then each ``order`` column ascending with NULLs
    last, then the tie-break. Absent columns count as NULL."""
    have = set(columns) if columns is not None else None
    ok = (lambda c: have is None or c in have)
    parts = [(-richness([c for c in rich if ok(c)])).alias("_score")]
    seq = [F.col(c) for c in order if ok(c)] + ([tie_hash(tie_break)] if tie_break and ok(tie_break) else [])
    for i, c in enumerate(seq):
        parts += [c.isNull().alias(f"_n{i}"), c.alias(f"_v{i}")]
    return F.struct(*parts)


def best_row_updates(stream: DataFrame, key: str, rich, order,
                     tie_break: str | None = None) -> DataFrame:
    """Streaming aggregation: the current best row per key (``min_by`` over
    the D1 order). Spark keeps one row per key in the state store, so a
    micro-batch only touches the keys it contains; in update mode each batch
    emits just the keys whose best row may have changed."""
    cols = [c for c in stream.columns if c != key]
    rank = best_row_order(rich, order, tie_break, stream.columns)
    best = stream.groupBy(key).agg(F.min_by(F.struct(*cols), rank).alias("_best"))
    return best.select(key, "_best.*")


def maintain_best_rows(spark: SparkSession, stream: DataFrame, log_dir: str | None,
                       checkpoint_dir: str, key: str, rich, order,
                       tie_break: str | None = None,
                       state_partitions: int | None = None) -> dict:
    """H2 with per-key state, which ``read_best_state`` reads from the
    checkpoint. With ``log_dir`` every micro-batch's updated best rows are
    written to ``log_dir/batch_id=N`` too, and only that partition is replaced
    when a batch is replayed, whatever the session's overwrite mode;
    ``read_best_rows`` returns the latest row per key of the log.

    ``state_partitions`` fixes the number of state-store partitions (each
    one is a RocksDB instance per micro-batch; AQE cannot coalesce them).
    It applies when the query first starts and is then kept in the
    checkpoint; size it to the cluster, not to the session default.
    """
    updates = best_row_updates(stream, key, rich, order, tie_break).writeStream.outputMode("update")

    def _fn(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(log_dir))

    updates = updates.foreachBatch(_fn) if log_dir else updates.format("noop")
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return run_available(spark, updates.option("checkpointLocation", checkpoint_dir), lambda w: w.start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


def read_best_state(spark: SparkSession, checkpoint_dir: str, key: str) -> DataFrame:
    """The best row per key as the state store holds it after the last
    committed batch: one row per key is read, no log and no compaction."""
    state = spark.read.format("statestore").load(checkpoint_dir)
    best = next(f.name for f in state.schema["value"].dataType if f.name.startswith("valueWith"))
    return state.select(F.col(f"key.`{key}`").alias(key), f"value.{best}.*")


def _compacted(spark: SparkSession, log_dir: str) -> DataFrame | None:
    """The compacted bases, one partition ``upto`` each. Only a folder that is
    not there means that there are none; any other failure is raised."""
    try:
        return spark.read.parquet(f"{log_dir}_compacted")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _best_with_batch(spark: SparkSession, log_dir: str, key: str) -> tuple[DataFrame, int]:
    log = spark.read.parquet(log_dir)
    base, upto = _compacted(spark, log_dir), -1
    if base is not None:
        upto = base.agg(F.max("upto")).first()[0]
        # Only log partitions after the compaction are scanned (partition
        # pruning on batch_id), so reads stay bounded by base + recent.
        log = (base.where(F.col("upto") == upto).drop("upto")
               .unionByName(log.filter(F.col("batch_id") > upto)))
    return top1(log, key, [F.col("batch_id").desc()]), upto


def read_best_rows(spark: SparkSession, log_dir: str, key: str) -> DataFrame:
    """Latest emitted row per key (each emission is the best so far), read
    from the newest compaction plus the updates logged after it."""
    return _best_with_batch(spark, log_dir, key)[0].drop("batch_id")


def compact_best_rows(spark: SparkSession, log_dir: str, key: str) -> int | None:
    """Write the current best rows as a base of their own (partition
    ``upto`` = last logged batch), which later reads start from. A base is
    never overwritten: with no batch since the last one nothing happens."""
    last = spark.read.parquet(log_dir).agg(F.max("batch_id")).first()[0]
    best, upto = _best_with_batch(spark, log_dir, key)
    if last is None or last <= upto:
        return None if last is None else int(upto)
    (best.filter(F.col("batch_id") <= last).withColumn("upto", F.lit(int(last)).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("upto").parquet(f"{log_dir}_compacted"))
    return int(last)
