"""Versioned table store.

Spark cannot overwrite a Parquet table it is reading, and a load reads the
table it replaces.  Each write therefore goes to a new folder
``<root>/<table>/v=<n>-<token>/`` and is then recorded in an append-only
commit log ``<root>/_log`` (small rows written by Spark, so it works on any
shared file system).  Readers take the highest committed version; a folder
that was written but never logged (a failed run) is simply ignored, and a
re-run writes a fresh folder.  Old versions stay for rollback.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import COMPRESSION, shuffles_dropped

LOG = "_log"
#: Columns with this prefix serve the checks of a write and are not stored.
CHECKED = "_lf_check_"
LOG_SCHEMA = ("table string, version int, path string, rows long, max_key long, "
              "committed_at timestamp_ntz")


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}/{LOG}"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Committed versions: table, version, path, rows, committed_at.  Only a
    log that does not exist counts as empty; any other failure is raised."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(_log_path(root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


class ConcurrentCommit(RuntimeError):
    """Another run committed a version of the same table first."""


def read_version(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """Read the current (or a given) committed version of ``table``."""
    log = versions(spark, root).filter(F.col("table") == table)
    if version is not None:
        log = log.filter(F.col("version") == version)
    row = log.orderBy(F.col("version").desc()).select("path").first()
    if row is None:
        raise FileNotFoundError(f"no committed version of {table} under {root}")
    return spark.read.parquet(row[0])


class ConstraintViolation(RuntimeError):
    """Rows that were written break a constraint of their table."""


def check_metrics(checks: dict[str, Column]) -> list[Column]:
    """Counts of the rows for which each check's column is true."""
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(f"check {name}") for name, c in checks.items()]


class Store:
    """Writer of one run: reads the newest version of each table from the
    commit log once, writes new versions, and logs them in one commit per layer
    (``commit``).  One writer per root at a time: the check in ``commit`` finds
    runs that overlap but is no lock."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.token = uuid.uuid4().hex[:8]
        newest = F.max_by(F.struct("version", "path", "rows", "max_key"), "version").alias("v")
        found = versions(spark, root).groupBy("table").agg(newest, F.max("max_key").alias("top")).collect()  # a row per table
        self.current: dict[str, tuple[int, str, int]] = {r["table"]: (r["v"]["version"], r["v"]["path"], r["v"]["rows"]) for r in found}
        self.newest_key: dict[str, int | None] = {r["table"]: r["v"]["max_key"] for r in found}
        self.top_key: dict[str, int | None] = {r["table"]: r["top"] for r in found}
        self.pending: list[tuple] = []
        self.observed: list[tuple[str, str, int]] = []
        self.names: list[str] = []  # catalog tables of this session, see `forget`
        self._lock = threading.Lock()  # writes of different tables may run concurrently

    def version(self, table: str) -> int:
        return self.current.get(table, (0, None, 0))[0]

    def has(self, table: str) -> bool:
        return table in self.current

    def new_version(self, table: str, folder: str | None = None) -> tuple[str, int]:
        """Folder and number of the next version of ``table``."""
        with self._lock:
            version = self.version(table) + 1
        return f"{self.root}/{folder or table}/v={version}-{self.token}", version

    def record(self, table: str, version: int, path: str, rows: int, max_key: int | None) -> None:
        """A version that is complete: visible to this run at once, to other
        readers after ``commit``."""
        with self._lock:
            self.current[table], self.newest_key[table] = (version, path, rows), max_key
            self.top_key[table] = max((k for k in (self.top_key.get(table), max_key) if k is not None), default=None)
            self.pending.append((table, version, path, rows, max_key))

    def passed(self, table: str, got: dict, checks: dict[str, Column]) -> None:
        """Keeps the observed counts of ``checks`` and fails if one is not zero."""
        counts = [(table, name, int(got[f"check {name}"])) for name in checks]
        with self._lock:
            self.observed += counts
        broken = [f"{name}: {n} rows" for _, name, n in counts if n]
        if broken:
            raise ConstraintViolation(f"{table} is not committed: {', '.join(broken)}")

    def write(self, df: DataFrame, table: str, key: str | None = None, checks: dict[str, Column] | None = None) -> int:
        """Write ``df`` as the next version of ``table``.  The row count, the
        largest ``key`` and the rows that break one of ``checks`` (conditions that
        no row may meet) are observed while writing, with no second pass; a
        broken check fails the write before its version is logged (S12)."""
        path, version = self.new_version(table)
        obs, checks = Observation(f"w{uuid.uuid4().hex}"), checks or {}
        metrics = [F.count(F.lit(1)).alias("rows"), (F.max(key) if key else F.lit(None)).cast("long").alias("max_key")]
        out = df.observe(obs, *metrics, *check_metrics(checks))
        with shuffles_dropped(self.spark):
            (out.select(*(c for c in df.columns if not c.startswith(CHECKED))).write.mode("errorifexists")
             .option("compression", COMPRESSION).parquet(path))
        got = obs.get
        self.passed(table, got, checks)
        self.record(table, version, path, int(got["rows"]), got["max_key"])
        return version

    def max_key(self, *tables: str) -> int:
        """Largest logged key (>= 0) over every version of ``tables``."""
        return max([0, *(self.top_key[t] for t in tables if self.top_key.get(t) is not None)])

    def latest_max_key(self, table: str) -> int:
        """Largest logged key of the current version of ``table`` (0 if none)."""
        return max(0, self.newest_key.get(table) or 0)  # identity values start at 1: seeds such as -9 never raise the start

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.current[table][1])

    def all_versions(self, table: str) -> list[tuple[int, str, int]]:
        """Every version of ``table`` (version, path, rows), oldest first."""
        log = versions(self.spark, self.root).filter(F.col("table") == table).select("version", "path", "rows")
        return sorted([tuple(r) for r in log.collect()] + [p[1:4] for p in self.pending if p[0] == table])

    def forget(self) -> None:
        """Drops this session's names of the tables; their files stay."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []

    def commit(self, *steps: str) -> None:
        """Log the pending versions, and ``steps`` of a run as done (``has``).
        Fails if another run has logged the same or a later version of one of
        their tables since this run began."""
        for step in steps:
            self.record(step, self.version(step) + 1, "", 0, None)
        if not self.pending:
            return
        first = {}
        for t, v, *_ in self.pending:
            first[t] = min(v, first.get(t, v))
        log = versions(self.spark, self.root).filter(F.col("table").isin(*first))
        taken = log.groupBy("table").agg(F.max("version").alias("v")).collect()  # a row per pending table
        lost = sorted(r["table"] for r in taken if r["v"] >= first[r["table"]])
        if lost:
            raise ConcurrentCommit(f"another run committed {', '.join(lost)} first; start this run again")
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = [(t, v, p, n, mk, now) for t, v, p, n, mk in self.pending]
        self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(_log_path(self.root))
        self.pending = []


def write_version(df: DataFrame, root: str, table: str) -> int:
    """Write and commit one new version of ``table``."""
    st = Store(df.sparkSession, root)
    v = st.write(df, table)
    st.commit()
    return v
