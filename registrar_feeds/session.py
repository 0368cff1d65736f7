"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Shuffle files of an action go when it ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_inside: dict[str, tuple[int, str | None]] = {}


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "registrar_feeds", extra: dict | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """A session configured the way the feeds expect.

    On a cluster the same settings go into the job's submit configuration;
    ``master`` is only set here for local runs and tests.
    """
    b = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Dimensions are never hinted; the planner broadcasts a side only when
        # its (runtime) size is under this bound and shuffles otherwise.
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        # Buckets of one key serve joins on more keys (``sources.catalog``).
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        # The feeds of a scheduled run share the executors evenly.
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.session.timeZone", "America/Chicago")
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it is set by the job and only read here.  When it is unset in
    a local run (tests) a temporary folder becomes the context's checkpoint
    folder; on a cluster that is an error, as each executor would write to its
    own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="registrar-feeds-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def is_local(master: str) -> bool:
    """One JVM is driver and executor (``local-cluster`` is a cluster)."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """What is written within (by plans built within) leaves no shuffle files: a
    long job holds those of the steps at work, not of all steps so far.  Threads
    may be in it side by side; the last one out restores the session's setting."""
    key = f"{spark.sparkContext.applicationId} {spark._jsparkSession.hashCode()}"
    with _lock:
        n, before = _inside.get(key, (0, None))
        if not n:
            before = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _inside[key] = (n + 1, before)
    try:
        yield
    finally:
        with _lock:
            n, before = _inside.pop(key)
            if n > 1:
                _inside[key] = (n - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed and kept under the shared checkpoint folder, until
    ``drop_checkpoint``."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_checkpoint(frame: DataFrame) -> None:
    """Delete the files of a frame of ``checkpointed`` that is used no more."""
    folder = frame._jdf.logicalPlan().rdd().getCheckpointFile()
    if folder.isDefined():
        remove(frame.sparkSession, folder.get())


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local checks in tests."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "checkpoint_root", "checkpointed", "drop_checkpoint", "is_local", "local_path", "remove",
           "scratch_dir", "shuffles_freed"]
