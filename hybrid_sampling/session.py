"""Session construction and the shared working folder."""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = 8, app: str = "hybrid-sampling") -> SparkSession:
    """Session with the settings the library assumes (ANSI, UTC, AQE, UI off).
    ``shuffle_partitions=None`` keeps the cluster's configured value."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _scheme(spark: SparkSession, path: str) -> str:
    """The file system that a path leads to, the default one for a path without a scheme."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf).getUri().getScheme()


@lru_cache(maxsize=64)
def _check_shared(spark: SparkSession, path: str) -> None:
    """Refuse a folder where the rows that executors write are not there to be read: one of each machine's own."""
    n = min(max(spark.sparkContext.defaultParallelism, 2), 32)
    probe = f"{path.rstrip('/')}/probe-{uuid.uuid4().hex[:12]}"
    try:
        spark.range(0, n, 1, n).write.parquet(probe)
        seen = spark.read.parquet(probe).count()
    except PySparkException as e:
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (cluster mode): {path} can't be written and read by all") from e
    if seen != n:
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (cluster mode): {path} showed {seen} of {n} rows written")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``; where that is unset, one below the warehouse.

    On a cluster a ``file:`` folder (or a bare path where that is the default file system) may be a mounted shared one
    or one of each machine's own: a few rows are written and read there once a session, and it is refused if they are not all seen.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if not sc.master.startswith("local") and _scheme(spark, current) == "file":
        _check_shared(spark, current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
