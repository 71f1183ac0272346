"""Tables in buckets of their merge hash (M3, M5): a load writes only the
buckets that it changes, and its merge join does not shuffle the table.

The files of a version are written with Spark's bucketing (``bucketBy`` on the
merge hash), one directory per bucket: ``<table>/of=<buckets>/v=<n>/bucket=<b>``.
A version holds the buckets that its load changed, whole; the commit log has a
row for each of them, so a bucket's newest version is where the last load that
changed it put it, and a run that fails changes nothing.  Readers see an
external catalog table with one partition per bucket, located there: Spark's
scan knows the bucketing, and the join on the merge hash needs no exchange on
this side.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.predicates import q
from ..operators.merge import CHANGED, HASH
from ..session import COMPRESSION, shuffles_dropped
from .snapshot import Store, check_metrics

BUCKET = "bucket"
#: Buckets of a new table.  About 1 GB of rows in each is a good size.
BUCKETS = 16


class BucketedTable:
    """``table`` of ``store``; a new one gets ``buckets`` buckets, an existing
    one keeps its number."""

    def __init__(self, store: Store, table: str, buckets: int = BUCKETS):
        self.store, self.table, self.spark = store, table, store.spark
        found = {m[1] for t in store.current if (m := re.fullmatch(re.escape(table) + r"/of=(\d+)/bucket=\d+", t))}
        self.buckets = int(found.pop()) if found else buckets

    @property
    def base(self) -> str:
        return f"{self.table}/of={self.buckets}"

    @property
    def _empty(self) -> str:
        """A file without rows that has the table's columns, for tables that have none."""
        return f"{self.store.root}/{self.base}/columns"

    def bucket(self) -> Column:
        """The bucket of a row, as Spark's bucketing computes it."""
        return F.pmod(F.hash(HASH), F.lit(self.buckets))

    def paths(self) -> dict[int, str]:
        """Where the newest version of each bucket that has rows is."""
        entries = {b: self.store.current.get(f"{self.base}/bucket={b}") for b in range(self.buckets)}
        return {b: e[1] for b, e in entries.items() if e is not None and e[2] > 0}

    def read(self) -> DataFrame | None:
        """The table with ``HASH``, scanned by buckets; None if it was never written."""
        if not self.store.has(self.table):
            return None
        digest = hashlib.md5(repr((self.store.root, self.table, sorted(self.paths().items()))).encode()).hexdigest()
        name = f"lakeforge_buckets_{digest}"
        if not self.spark.catalog.tableExists(name):
            self.create(name)
            self.store.names.append(name)
        return self.spark.table(name).drop(BUCKET)

    def create(self, name: str) -> None:
        """The newest version as external catalog table ``name``."""
        paths = self.paths()
        columns = ", ".join(f"{q(f.name)} {f.dataType.simpleString()}" for f in self.spark.read.parquet(self._empty).schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                       f"CLUSTERED BY ({HASH}) INTO {self.buckets} BUCKETS LOCATION '{self.store.current[self.table][1]}'")
        if paths:
            self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{p}'" for b, p in paths.items()))

    def apply(self, rows: DataFrame, keep: Column, key: str, out_cols: list[str], checks: dict[str, Column] | None = None) -> None:
        """Writes the next version from all rows of the table after a load:
        ``rows`` has ``HASH``, ``CHANGED`` and, where ``keep`` does not hold,
        rows that leave the table.  Buckets without a changed row stay as they are.
        Each task writes the rows it has into its own files of their buckets, in
        the order of ``key``, so nothing is shuffled: stored rows lie in ranges of
        the key or, after a merge, in buckets.
        ``checks``: see :meth:`Store.write`."""
        # At most one row per bucket.
        stats = rows.groupBy(self.bucket().alias("b")).agg(
            F.max(CHANGED).alias("changed"), F.count_if(keep).alias("n"), F.max(F.when(keep, F.col(key))).alias("top")).collect()
        touched = [r["b"] for r in stats if r["changed"]]
        path, version = self.store.new_version(self.table, self.base)
        new = rows.filter(keep & self.bucket().isin(touched))
        obs, metrics = Observation(f"w{uuid.uuid4().hex}"), check_metrics(checks or {})
        new = new.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics).select(*out_cols, HASH, self.bucket().alias(BUCKET))
        name = f"lakeforge_write_{uuid.uuid4().hex}"
        with shuffles_dropped(self.spark):
            (new.write.partitionBy(BUCKET).bucketBy(self.buckets, HASH).sortBy(key).format("parquet")
             .option("compression", COMPRESSION).option("path", path).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # external: the files stay
        if version == 1:
            self.spark.createDataFrame([], rows.select(*out_cols, HASH).schema).coalesce(1).write.mode("overwrite").parquet(self._empty)
        self.store.passed(self.table, obs.get, checks or {})
        tops = [r["top"] for r in stats if r["top"] is not None]
        self.store.record(self.table, version, path, sum(r["n"] for r in stats), max(tops, default=None))
        for r in stats:
            if r["changed"]:
                self.store.record(f"{self.base}/bucket={r['b']}", version, f"{path}/{BUCKET}={r['b']}", r["n"], None)
