"""SimHash near-duplicates by a grid join over segment popcounts.

A fingerprint has 32 segments of two bits.  Its embedding is the vector of the
segments' bit counts; the Manhattan distance of two embeddings never exceeds
the Hamming distance of the fingerprints.  The embedding is kept in unary (a
segment's ones moved to its low end), so that Manhattan distance is the number
of differing bits of two embeddings.

Grid range-join: the 32 axes are cut into `max_bits + shared` groups.  Two
points within distance `max_bits` differ in at most `max_bits` groups, so they
share the coordinates of at least `shared` groups; every choice of that many
groups is a grid in which each point has one cell, and every link lies within
a cell of some grid.  More groups make more grids of finer cells: their number
follows from the number of fingerprints (`shared_groups`), so that cells stay
small as the input grows; it changes no link.  Inside a cell the Manhattan
distance is checked first, as lower bound, and then the exact bit distance.

Equal fingerprints are merged before the join and cells hand on a spanning
forest of their links, never all pairs, so a large group of copies stays
small.  Large cells are walked breadth first: a point leaves the cell once it
is linked, so dense groups take few comparisons.

Texts without words have fingerprint zero and are linked like any other; NULL
text counts as empty.  Rows are linked through their fingerprints alone, so
rows with the same id and different texts may be in different components."""

from __future__ import annotations

import math
import uuid
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stored, id_and_text, store, with_null_ids
from .components import connected

SEGMENTS = 32
#: Least number of groups that linked points share; a grid per choice of so many.
GROUPS_SHARED = 3
#: Chance that two unrelated points agree in one axis (bit counts 0, 1, 2 by 1/4, 1/2, 1/4).
AXIS_MATCH = 3 / 8
#: Comparisons that take as long as one entry of a cell.
ENTRY_COST = 32
SEED = 42
#: Cells up to this size are compared pair by pair.
SMALL_CELL = 24
#: Cell entries per bucket, a task's unit of work.
BUCKET_ROWS = 250_000


def fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)  # one shingle: its own bits
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def text_hash() -> Column:
    """Tells rows with one id apart by their texts."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int, with_hash: bool = False) -> DataFrame:
    """(doc_id, fp), fp as a signed 64-bit integer with the same bits; with
    the hash of the text, if wanted."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                                             names=["doc_id", "fp", *batch.schema.names[2:]])

    texts = id_and_text(docs)
    if with_hash:
        return texts.select("*", text_hash().alias("text_hash")).mapInArrow(run, "doc_id long, fp long, text_hash long")
    return texts.mapInArrow(run, "doc_id long, fp long")


def embed(fp: np.ndarray) -> np.ndarray:
    """Segment popcounts in unary: 00, 01 or 11 per segment."""
    low = np.uint64(0x5555555555555555)
    a, b = fp & low, (fp >> np.uint64(1)) & low
    return (a | b) | ((a & b) << np.uint64(1))


def shared_groups(points: int, max_bits: int) -> int:
    """How many groups a grid takes, for the least work on so many points:
    entries of cells, and comparisons of unrelated points that share a cell."""

    def work(shared: int) -> float:
        n = max_bits + shared
        chance = AXIS_MATCH ** (SEGMENTS * shared / n)
        return math.comb(n, shared) * (ENTRY_COST + points * chance / 2)

    return min(range(GROUPS_SHARED, max(GROUPS_SHARED, SEGMENTS - max_bits) + 1), key=work)


def grids(max_bits: int, shared: int = GROUPS_SHARED) -> list[int]:
    """A mask of embedding bits per grid."""
    n = max_bits + shared
    groups = [0] * n
    for s in range(SEGMENTS):
        groups[s * n // SEGMENTS] |= 3 << (2 * s)
    return [sum(c) for c in combinations(groups, shared)]


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads bits (the finalizer of MurmurHash3)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def cells(points: DataFrame, max_bits: int, buckets: int, shared: int = GROUPS_SHARED) -> DataFrame:
    """(bucket, grid, fp): each fingerprint once per grid."""
    masks = np.array(grids(max_bits, shared), np.uint64)

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            e = embed(fp.view(np.uint64))
            for g in range(len(masks)):
                cell = _mix((e & masks[g]) + np.uint64(g + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((cell % np.uint64(buckets)).astype(np.int32)),
                     pa.array(np.full(len(fp), g, np.int32)), batch.column(0)],
                    names=["bucket", "grid", "fp"])

    return points.select("fp").mapInArrow(run, "bucket int, grid int, fp long")


def _pairs_in_small(order, size, cell_start, fp, e, max_bits):
    """Linked pairs of cells of at most SMALL_CELL entries."""
    at = np.flatnonzero((size > 1) & (size <= SMALL_CELL))
    left, right = [], []
    end = cell_start + size
    d = 1
    while len(at):
        at = at[at + d < end[at]]
        a, b = order[at], order[at + d]
        near = np.bitwise_count(e[a] ^ e[b]) <= max_bits
        a, b = a[near], b[near]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        left.append(a[near])
        right.append(b[near])
        d += 1
    return left, right


def _links_in_large(members, fp, e, max_bits):
    """A spanning forest of one large cell, breadth first."""
    left, right = [], []
    rest = members
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            p = todo.pop()
            near = np.bitwise_count(e[rest] ^ e[p]) <= max_bits
            near[near] = np.bitwise_count(fp[rest[near]] ^ fp[p]) <= max_bits
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), p))
                right.append(found)
                todo.extend(found.tolist())
                rest = rest[~near]
    return left, right


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each index's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for x in (a, b, label[a], label[b]):
            np.minimum.at(new, x, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def links(entries: DataFrame, max_bits: int, shared: int = GROUPS_SHARED) -> DataFrame:
    """Links of each bucket as (u, v): a fingerprint and one it reaches there."""
    masks = np.array(grids(max_bits, shared), np.uint64)

    def run(table: pa.Table) -> pa.Table:
        grid = table.column("grid").to_numpy()
        fp = table.column("fp").to_numpy().view(np.uint64)
        e = embed(fp)
        cell = e & masks[grid]
        order = np.lexsort((fp, cell, grid))
        g, c = grid[order], cell[order]
        first = np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])])
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(order)))
        which = np.cumsum(first) - 1
        left, right = _pairs_in_small(order, sizes[which], starts[which], fp, e, max_bits)
        for s, n in zip(starts[sizes > SMALL_CELL], sizes[sizes > SMALL_CELL]):
            more = _links_in_large(order[s:s + n], fp, e, max_bits)
            left += more[0]
            right += more[1]
        a = np.concatenate(left) if left else np.empty(0, np.int64)
        b = np.concatenate(right) if right else np.empty(0, np.int64)
        nodes, index = np.unique(fp.view(np.int64), return_inverse=True)
        label = _least_labels(len(nodes), index[a], index[b])
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.table({"u": nodes[moved], "v": nodes[label[moved]]})

    return entries.groupBy("bucket").applyInArrow(run, "u long, v long")


def _components(spark: SparkSession, fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) per fingerprint: a fingerprint that names its
    component, and the component's least doc_id."""
    points, points_path = store(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    n = points.count()
    shared = shared_groups(n, max_bits)
    buckets = max(64, math.ceil(n * len(grids(max_bits, shared)) / BUCKET_ROWS))
    found, edges_path = connected(links(cells(points, max_bits, buckets, shared), max_bits, shared))
    member = (points.join(found.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least", F.coalesce("component", "fp").alias("root")))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    roots, _ = store(member.join(least, "root").select("fp", "root", "component_id"), "roots")
    for path in (points_path, edges_path):
        drop_stored(spark, path)
    return roots


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) per document row; component_id is the least
    doc_id that links of at most `max_bits` differing bits reach."""
    fps, _ = store(fingerprints(docs, shingle), "fingerprints")
    roots = _components(docs.sparkSession, fps, max_bits)
    out = fps.join(roots, "fp").select("doc_id", "fp", "component_id")
    return with_null_ids(with_null_ids(out), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """`docs` with one document of each component: the one with the least id,
    and of several rows with that id the one with the least hash of its text.
    All columns stay; equal rows of that document stay once."""
    fps, _ = store(fingerprints(docs, shingle, with_hash=True), "fingerprints")
    roots = _components(docs.sparkSession, fps, max_bits)
    first = fps.join(roots, "fp").filter("doc_id = component_id").groupBy("root", "doc_id").agg(F.min("text_hash").alias("kept_hash"))
    kept = with_null_ids(first).select(F.col("doc_id").alias("kept_id"), "kept_hash").distinct()
    key = f"text_hash_{uuid.uuid4().hex}"
    rows = docs.withColumn(key, text_hash())
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows[key] == kept["kept_hash"]), "left_semi")
    return rows.dropDuplicates(["doc_id", key]).drop(key)
