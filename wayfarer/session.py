"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "wayfarer",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE and skew handling switched on.

    On a cluster the master and resources come from spark-submit; ``master``
    is only for local runs and tests.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint directory). Only when neither is set (local tests) is
    ``fallback`` installed.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    target = conf_dir or fallback
    if not target:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """Path for an intermediate table under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def has_checkpoint_dir(spark: SparkSession) -> bool:
    if spark.sparkContext.getCheckpointDir():
        return True
    return bool(spark.conf.get("spark.checkpoint.dir", None))


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the intermediate tables written inside the block when it ends.

    Nothing that outlives the block may still read one of those tables, but for
    those that ``keep`` has taken out of it.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.remove(paths)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            target = jvm.org.apache.hadoop.fs.Path(p)
            target.getFileSystem(conf).delete(target, True)


def keep(df, paths: list[str]):
    """Let a stored table outlive the scope whose ``paths`` these are (it then belongs to the scope around it)."""
    paths.remove(df.scratch_path)
    around = [s for s in _scopes if s is not paths]
    if around:
        around[-1].append(df.scratch_path)
    return df


def store(df, name: str = "stage", **options):
    """Write ``df`` once to the shared folder and read it back; raises where no
    shared folder is configured. For tables whose rows depend on how they were
    partitioned (ranks, row numbers): a recomputation could change them.
    ``options`` are the Parquet writer's."""
    spark = df.sparkSession
    path = scratch_table_path(spark, f"{name}-{uuid.uuid4().hex}")
    if _scopes:
        _scopes[-1].append(path)
    # keys are hexadecimal digests, which only an entropy coder makes smaller
    df.write.mode("overwrite").option("compression", "zstd").options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def materialize(df, name: str = "stage"):
    """Cut the lineage of a DataFrame that feeds several consumers.

    With a shared checkpoint folder configured the rows are written there once
    as a Parquet table and read back: the write survives executor loss, and
    every consumer gets column pruning and filter pushdown on the stored
    columns instead of recomputing joins and shuffles. Without a shared
    folder, fall back to ``persist(MEMORY_AND_DISK)``: lost blocks are
    recomputed from lineage, to the same rows, as nothing that depends on the
    partitioning comes this way (``store`` is for that).
    """
    from pyspark import StorageLevel

    if has_checkpoint_dir(df.sparkSession):
        return store(df, name)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def small_table(df, max_rows: int = 100_000):
    """A table that should be small, written once and marked for broadcast
    after counting it; ``None`` where it has more than ``max_rows`` rows
    (callers then keep a shuffle join). Its rows never pass through the driver
    program."""
    from pyspark.sql import functions as F

    table = materialize(df, "small")
    if table.limit(max_rows + 1).count() > max_rows:
        return None
    return F.broadcast(table)


def spread_if_narrow(df, *cols):
    """Hash-spread a scan that yields fewer partitions than the session has
    cores (a file with a single row group is read by a single task). On a
    large input this is a no-op: its scan already has many splits."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    n = 2 * cores
    return df.repartition(n, *cols) if cols else df.repartition(n)
