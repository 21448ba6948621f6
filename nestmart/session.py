"""Session construction and shared scratch space.

Library code never builds its own session: it takes the one it is given.
``local_session`` is for tests, the bench and command-line runs.

Scratch space (materialised intermediate tables, lineage cuts) lives under the
folder the cluster names in ``spark.checkpoint.dir``; only when that is unset
(a bare local session, as in tests) is a folder created and registered.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "nestmart") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        # Only reached in bare local sessions (tests): no cluster folder exists.
        configured = tempfile.mkdtemp(prefix="nestmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/nestmart/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (later jobs start from the files, and a lost executor
    does not force recomputing the upstream plan) with a single computation
    of ``df``, unlike an RDD checkpoint that computes it once to count and
    again to save unless it was cached first.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a frame that ``materialize`` returned; nothing may read it later."""
    spark = df.sparkSession
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = hpath(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Removes a statement's shuffle files when it ends, not at the driver's next collection.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a statement's shuffle files go when it ends.

    For chains of writes, whose frames run once: a frame that runs again makes
    its shuffles again. Set it around threads, not in them, as it holds for
    the session.
    """
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side checks can look at a local path."""
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works on any store."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder (Hadoop content summary, any file system)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else 0


def new_id() -> str:
    return uuid.uuid4().hex[:12]


__all__ = ["local_session", "ensure_checkpoint_dir", "scratch_path", "path_exists",
           "local_path", "new_id", "materialize", "discard", "shuffles_removed",
           "folder_bytes"]
