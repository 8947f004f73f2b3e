"""Session settings and shared scratch locations.

Every job in the package runs on a plain ``SparkSession``. ``build_session``
is a convenience for tests, the benchmark and the driver entry; on a cluster
the session comes from the platform and only the SQL settings below matter.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# SQL settings the operators rely on. AQE re-plans joins/aggregations from
# runtime sizes (coalesces small shuffle partitions, splits skewed join
# partitions, turns a join into a broadcast only when the measured side is
# small). Duplicate JSON keys keep the last value, like Python's json module.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Wide projections (38 VARIANT lookups) generate methods too large for
    # the HotSpot JIT (8000 bytes); above that size run that subtree without
    # whole-stage fusion instead of interpreting one huge method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming state (best row per key) lives in RocksDB, off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "metalake", extra: dict | None = None) -> SparkSession:
    """Local/test session. ``master`` defaults to ``local[*]``."""
    builder = (SparkSession.builder.master(master or "local[*]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in {**SQL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    prepare(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (cluster case)."""
    for k, v in SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``metalake`` importable in Python workers (the title UDF and the
    footer reader run there). Spark distributes the zipped package through
    ``addPyFile``; on a cluster the package may instead be installed on the
    executors or passed with ``--py-files``."""
    try:
        sc = spark.sparkContext
    except PySparkException:  # Spark Connect: ship with the server's artifact mechanism instead
        return
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import zipfile

    import metalake
    pkg_dir = os.path.dirname(os.path.abspath(metalake.__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="metalake-pyfiles-"), "metalake.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings plus the package on the Python workers."""
    apply_sql_conf(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (tests, a laptop) a private temporary
    folder is created and registered, so lineage cuts and scratch tables
    always land on storage every executor can reach.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except PySparkException:  # Spark Connect: no SparkContext on the client
        sc = None
    if root:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if sc is not None and sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir().rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local"):
        # A driver-local folder is invisible to executors on a cluster.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if sc is None:
        global _LOCAL_ROOT
        _LOCAL_ROOT = _LOCAL_ROOT or tempfile.mkdtemp(prefix="metalake-ckpt-")
        return _LOCAL_ROOT
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="metalake-ckpt-"))  # local runs and tests only
    return sc.getCheckpointDir().rstrip("/")


_LOCAL_ROOT: str | None = None


MB = 1 << 20


def scale_conf(shuffle_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict:
    """Shuffle sizing for a given expected shuffle volume.

    One initial shuffle partition per ``target_partition_mb`` of shuffled
    data (at least two per core), so a partition stays that size at any
    volume; AQE then coalesces small partitions toward the same advisory
    size and splits partitions over 4x that size in joins. Scan splits stay
    at 256 MB so each task's input fits comfortably in memory.
    Example: 30 TB shuffled on 8 000 cores -> 111 759 partitions.
    """
    target = target_partition_mb * MB
    n = max(2 * total_cores, -(-shuffle_bytes // target))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
    }


def spread(df, min_partitions: int | None = None):
    """Round-robin repartition when ``df`` has fewer partitions than cores.

    For inputs that are small on disk but expand into heavy per-row work
    (JSON text -> VARIANT -> 38 columns), a single small file would
    otherwise be processed by one task. Large inputs already arrive in many
    splits and pass through unchanged (no extra shuffle).
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except PySparkException:  # Spark Connect: leave partitioning to the server
        return df
    return df.repartition(want) if have < want else df


#: Rows of a task that makes, parses and flattens JSON records: half a minute or so of one core.
ROWS_PER_TASK = 100_000


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for so many rows: one a core at least, and none that grows with the input."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except PySparkException:  # Spark Connect: no SparkContext on the client
        cores = 1
    return max(cores, -(-rows // rows_per_task))


def spread_rows(df, rows_per_task: int = ROWS_PER_TASK):
    """``df``, a table whose rows each expand into heavy work, dealt round-robin
    to tasks of a bounded number of rows. How the input is cut says nothing of
    that: a Parquet file has as many splits as bytes call for, but only those
    that hold the middle of a row group have rows."""
    return df.repartition(tasks_for(df.sparkSession, df.count(), rows_per_task))


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder under the shared checkpoint root."""
    try:
        app = spark.sparkContext.applicationId
    except PySparkException:  # Spark Connect: no SparkContext on the client
        app = spark.session_id
    return f"{checkpoint_root(spark)}/metalake-scratch/{app}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder of this application's scratch space."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables. Results that have not been
    written elsewhere read from them, so this comes last."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def kept(df, name: str):
    """``df`` written to the shared scratch folder and read back. A join with
    it is a join of two plain shuffles, whose skewed partitions Spark splits;
    it does not split those next to an aggregation or a window."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str | None:
    """Filesystem path for ``file:`` URIs or plain paths, else ``None``."""
    if path.startswith("file:"):
        p = path[5:]
        while p.startswith("//"):
            p = p[1:]
        return p
    if "://" in path:
        return None
    return os.path.abspath(path)
