"""Finding keys that occur in several groups of documents.

Documents are dealt into groups of neighbouring ids.  A task sends the distinct
64-bit keys of a group once, packed by bucket (a range of key values), so a key
that half of all documents hold is sent once per group and not once per
document.  A bucket compares the keys of all groups and answers each group with
the keys it shares: those some group before it holds (`earlier`) and those that
only groups after it hold (`later`).  What repeats inside a group is left to
the group itself, which has all its documents together when it reads the
answers.

An id with many rows (one id, or NULL, may hold a third of a table) doesn't fit
a group: its rows are sorted by their texts, stored once and cut into groups of
bounded size that hold nothing else.  Groups follow one another in the order of
(doc_id, text), and `Deal.owners` tells which of them belong to one id."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store

PACKED = "bucket int, grp long, keys binary"
ANSWER = "grp long, earlier binary, later binary"
GROUP_BYTES = 2 * 2**20
LARGEST_GROUP = 64 * 2**20
LEAST_TASKS = 128
#: What a row counts beside its text.
ROW_BYTES = 64
#: Least number of ids per group if some ids are cut, so that group numbers stay in 64 bits.
LEAST_IDS = 4
#: Group numbers kept free for an id that is cut, and for each partition of its sorted rows.
SLOTS, PART_SLOTS = 2**40, 2**20
SAMPLE_SIZE = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


@dataclass(frozen=True)
class Deal:
    """How documents are dealt: ids per group, buckets of keys, the ids that
    are cut (sorted) and the bytes of their rows."""

    ids: int
    buckets: int
    large: tuple[int, ...] = ()
    large_bytes: int = 0

    def dealt(self, docs: DataFrame) -> DataFrame:
        """`docs` with the group of each row, `grp`.  It never falls as
        (doc_id, text) grows."""
        group = F.expr(f"doc_id div {self.ids}")
        if not self.large:
            return docs.select(group.alias("grp"), *docs.columns)
        cut = F.array(*(F.lit(x).cast("long") for x in self.large))
        is_cut = F.col("doc_id").isin(list(self.large))
        before = F.size(F.filter(cut, lambda x: x < F.col("doc_id"))).cast("long")
        first = group + before * F.lit(SLOTS)
        rest = docs.filter(~is_cut).select(first.alias("grp"), *docs.columns)
        return rest.unionByName(self._cut(docs.filter(is_cut).select((first + 1).alias("grp"), *docs.columns)))

    def _cut(self, rows: DataFrame) -> DataFrame:
        """Rows of the ids that are cut, each id in groups of GROUP_BYTES.
        Equal rows are told apart by a number, so they spread as well."""
        limit = GROUP_BYTES

        def run(batches):
            grp, last, size = TaskContext.get().partitionId() * PART_SLOTS, None, 0
            for batch in batches:
                column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                moved = []
                for base, doc, n in zip(*(column[c].to_pylist() for c in ("grp", "doc_id", "bytes"))):
                    if last is not None and (doc != last or size + n > limit):
                        grp, size = grp + 1, 0
                    last, size = doc, size + n
                    moved.append(base + grp)
                yield pa.RecordBatch.from_arrays([pa.array(moved, pa.int64()), *(column[c] for c in names)], names=["grp", *names])

        names = rows.columns[1:]
        out = T.StructType([T.StructField("grp", T.LongType()), *(rows.schema[c] for c in names)])
        parts = max(16, self.large_bytes // (LARGEST_GROUP // 2))
        placed = (rows.withColumn("bytes", F.octet_length("text") + ROW_BYTES).withColumn("number", F.monotonically_increasing_id())
                  .repartitionByRange(parts, "doc_id", "text", "number").sortWithinPartitions("doc_id", "text"))
        spark = rows.sparkSession
        before = spark.conf.get(SAMPLE_SIZE)
        spark.conf.set(SAMPLE_SIZE, "20")  # the sample holds whole texts
        try:
            return store(placed.mapInArrow(run, out), "cut-ids")[0]
        finally:
            spark.conf.set(SAMPLE_SIZE, before)

    def owners(self, grp: np.ndarray) -> np.ndarray:
        """A number that the groups of one cut id share and that is the
        group's own for the others.  It never falls as the group grows."""
        if not self.large:
            return grp
        start = np.array([abs(x) // self.ids * (1 if x > 0 else -1) for x in self.large], np.int64)  # as `div`
        start = start + np.arange(len(start)) * SLOTS + 1
        at = np.maximum(np.searchsorted(start, grp, side="right") - 1, 0)
        inside = (grp >= start[at]) & (grp < start[at] + SLOTS - 1)
        return np.where(inside, start[at], grp)


def deal(docs: DataFrame, keys_per_byte: float, bucket_keys: int = 1_250_000) -> Deal:
    """Groups of about GROUP_BYTES of text, and at most LARGEST_GROUP even if
    all its ids had as much text as the largest; ids with more than a share of
    that are cut.  Buckets of `bucket_keys`."""
    most = LARGEST_GROUP // LEAST_IDS
    by_id = docs.groupBy("doc_id").agg(F.sum(F.octet_length("text").cast("long")).alias("b"),
                                       F.sum(F.octet_length("text").cast("long") + ROW_BYTES).alias("w"))
    fits = F.col("w") <= most
    row = by_id.agg(F.sum("b").alias("size"), F.count(F.when(fits, 1)).alias("n"), F.sum(F.when(fits, F.col("b"))).alias("b"),
                    F.max(F.when(fits, F.col("b"))).alias("m"), F.sum(F.when(~fits, F.col("w"))).alias("large_bytes"),
                    F.collect_list(F.when(~fits, F.col("doc_id"))).alias("large")).first()
    n, size, longest = (int(row[c] or 0) for c in ("n", "b", "m"))
    ids = min(GROUP_BYTES * n // max(1, size), LARGEST_GROUP // max(1, longest), n // LEAST_TASKS)
    return Deal(max(LEAST_IDS if row["large"] else 1, ids), max(LEAST_TASKS, int((row["size"] or 0) * keys_per_byte / bucket_keys)),
                tuple(sorted(row["large"])), int(row["large_bytes"] or 0))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit keys (the finalizer of MurmurHash3)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pack(by_group, buckets: int):
    """(group, distinct sorted keys) pairs to record batches of PACKED."""
    for grp, keys in by_group:
        if not len(keys):
            continue
        bucket = (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cuts))
        data = keys.astype("<u8").tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), grp, np.int64)),
             pa.array([data[8 * cuts[b]:8 * cuts[b + 1]] for b in full], pa.binary())], names=["bucket", "grp", "keys"])


def unpack(column) -> np.ndarray:
    """The keys of a column of packed keys, sorted."""
    data = b"".join(x for x in column.to_pylist() if x)
    return np.sort(np.frombuffer(data, "<u8"))


def contains(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


def extremes(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest owner of each key, given back per row; owners must
    not fall along the rows."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(keys, kind="stable")
    k, o = keys[order], owner[order]
    first = np.concatenate([[True], k[1:] != k[:-1]])
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(k)) - 1
    which = np.cumsum(first) - 1
    least, greatest = np.empty_like(o), np.empty_like(o)
    least[order], greatest[order] = o[starts][which], o[ends][which]
    return least, greatest


def _meet(table: pa.Table, owners) -> pa.Table:
    grp = table.column("grp").to_numpy()
    order = np.argsort(grp, kind="stable")
    parts = table.column("keys").to_pylist()
    parts = [np.frombuffer(parts[i], "<u8") for i in order]
    keys = np.concatenate(parts)
    holder = np.repeat(grp[order], list(map(len, parts)))
    owner = owners(holder)
    least, greatest = extremes(keys, owner)
    shared = np.flatnonzero(least != greatest)
    keys, holder, early = keys[shared], holder[shared], owner[shared] > least[shared]
    cuts = np.flatnonzero(np.concatenate([[True], holder[1:] != holder[:-1]])) if len(holder) else np.empty(0, np.int64)
    rows = [(holder[a], keys[a:b][early[a:b]].tobytes(), keys[a:b][~early[a:b]].tobytes())
            for a, b in zip(cuts, np.append(cuts[1:], len(holder)))]
    cols = zip(*rows) if rows else [()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.binary()))],
                    names=["grp", "earlier", "later"])


def shared_keys(packed: DataFrame, owners=lambda grp: grp) -> DataFrame:
    """ANSWER rows, several per group (one per bucket).  Groups with one owner
    (`Deal.owners`) do not share keys with each other."""
    return packed.groupBy("bucket").applyInArrow(lambda table: _meet(table, owners), ANSWER)


def by_group(batch: pa.RecordBatch):
    """(group, rows of the batch) for a batch with a `grp` column."""
    grp = batch.column(batch.schema.get_field_index("grp")).to_numpy(zero_copy_only=False)
    order = np.argsort(grp, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], grp[order][1:] != grp[order][:-1]])) if len(grp) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(grp)) if len(grp) else []):
        yield int(grp[order[a]]), batch.take(pa.array(order[a:b]))
