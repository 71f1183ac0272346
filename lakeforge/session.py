"""Session helpers: a local session for tests/bench, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lakeforge") -> SparkSession:
    """Local session with AQE on and the UI off (tests and bench only)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The cluster names it in ``spark.checkpoint.dir``; that setting is read
    from the session.  Only a local-mode session without the setting (tests,
    bench) gets a fresh folder of its own under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder for checkpoints")
        configured = tempfile.mkdtemp(prefix="lakeforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and return a frame reading it back: later plans start from the stored
    result instead of re-running (and re-planning) its whole lineage.  The
    data sits on shared storage, so a lost executor does not lose it, and
    readers get column pruning and filter pushdown (an RDD checkpoint gives
    neither)."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/lakeforge-stage-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
    owner = _OWNER.get()
    if owner is not None:
        owner.append(path)
    return spark.read.parquet(path)


#: Codec of stored tables: half of Snappy's size on keys and digests in hex.
COMPRESSION = "zstd"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes, _writes_lock = 0, threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes started in here drop their shuffle files when they end, so that a
    load needs disk for the shuffles of the steps that run, not of all steps
    before.  The setting is the session's, so it stays on until the last of the
    writes that overlap has ended."""
    global _writes
    with _writes_lock:
        _writes += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _writes_lock:
            _writes -= 1
            if not _writes:
                spark.conf.unset(_CLEANUP)


# Stage tables of the run that this context belongs to.
_OWNER: ContextVar[list[str] | None] = ContextVar("owner", default=None)


@contextmanager
def owned_stages(spark: SparkSession):
    """Deletes at its end the stage tables that ``cut_lineage`` stored in this
    context; for runs that write their results elsewhere before they end.
    Threads of the run must be given a copy of its context."""
    mine: list[str] = []
    token = _OWNER.set(mine)
    try:
        yield mine
    finally:
        _OWNER.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in mine:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def stored(spark: SparkSession, build) -> DataFrame:
    """The frame that ``build`` returns, stored like ``cut_lineage``; the stage
    tables it was built from are deleted once it is."""
    return last_stage(spark, lambda: cut_lineage(build()))


def last_stage(spark: SparkSession, build) -> DataFrame:
    """The frame that ``build`` returns, which reads the stage table that
    ``build`` stored last; those stored before are deleted."""
    owner = _OWNER.get()
    with owned_stages(spark) as stages:
        out = build()
        path = stages.pop()
    if owner is not None:
        owner.append(path)
    return out


def folder_stamp(spark: SparkSession, path: str) -> int:
    """A number that changes when files under ``path`` change (names, sizes
    and times, two levels deep), read through Spark's file systems."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(conf)
    found = []
    for entry in fs.listStatus(top):
        files = fs.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    return hash(tuple(sorted(found)))
