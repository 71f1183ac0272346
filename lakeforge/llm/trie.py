"""Prefix trie of conversations with totals of its subtrees.

A node is a distinct sequence of first turns; its identity is a SHA-256 over
them, its name the smallest conversation that starts with it.  Nothing runs
along a whole conversation and nothing explodes a node to all its ancestors:

* Turns are cut into bands of HEIGHT.  A band's turns give one digest, the
  digests of a conversation's bands are cut into bands again, and so on up;
  the identities of the ends of the bands come back down, and each band chains
  its own turns to the identity before it.  A conversation of n turns takes
  log(n) levels and no task ever holds more than a band of it.
* For totals, every node adds its value to the band root above it (the node at
  the end of the band before).  The band roots are a trie of the next level,
  whose totals are found first; completed band-root totals are then added to
  the values of the nodes at the ends of bands, and each node explodes to the
  ancestors in its own band."""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import number_within_groups
from ..session import owned_stages
from .common import drop_stored, store

HEIGHT = 16
ROOT = b""
#: Bytes of joined ids in one row before they are hashed.
PIECE_BYTES = 2**20
#: Most turns that a rebuilt conversation takes from another one, plus one.
BORROWED = 6


def _sha(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, digest, chars): each turn's number in its conversation
    from 1, by `turn` with NULL first, ties by the digest of role and text.
    Rows without a conv_id belong to no conversation.  A conversation of any
    length is numbered by many tasks."""
    role, text = _text("role"), _text("text")
    slim = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        _sha(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.length(text).cast("long").alias("chars"))
    return number_within_groups(slim, ["conv_id"], ["turn", "digest"], "place", hot=0).select(
        "conv_id", F.col("place").cast("long").alias("place"), "digest", "chars")


def conversations(own: DataFrame) -> DataFrame:
    """(conv_id, base, head, taken, length) of the rebuilt conversations: how
    many turns of its own one gives up, how many it takes from `base`."""
    base = F.col("conv_id") - F.col("conv_id") % 100
    each = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", base.alias("base"), "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED).alias("head"))
    lent = each.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("lent"))
    taken = F.least("head", F.coalesce("lent", F.lit(0)))
    return each.join(lent, "base", "left").select(
        "conv_id", "base", "head", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length"))


def rebuilt(own: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars): the turns of the rebuilt conversations,
    pos from 0."""
    lent = own.filter((F.col("conv_id") % 100 == 0) & (F.col("place") < BORROWED)).withColumnRenamed("conv_id", "base")
    first = convs.select("conv_id", "base", "taken").join(lent, "base").filter("place <= taken").select(
        "conv_id", (F.col("place") - 1).alias("pos"), "digest", "chars")
    rest = own.join(convs.select("conv_id", "head", "taken"), "conv_id").filter("place > head").select(
        "conv_id", (F.col("taken") + F.col("place") - F.col("head") - 1).alias("pos"), "digest", "chars")
    return first.unionByName(rest)


class Trie:
    """Tables of one run.  `paths[l]` has for every conversation and band of
    level l: `before` (identity of the band root) and `ids` (of the nodes in
    the band, as far as the conversation goes)."""

    def __init__(self, height: int = HEIGHT):
        self.height, self.paths, self.stored = height, {}, []

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        out, path = store(df, tag)
        self.stored.append(path)
        return out

    def band(self) -> Column:
        return F.floor(F.col("pos") / self.height)

    def ends(self) -> Column:
        return F.col("pos") % self.height == self.height - 1

    def chain(self, elements: DataFrame, longest: int, level: int = 0) -> DataFrame:
        """Stores `paths` from this level up; gives back this level's table.
        `elements`: conv_id, pos, digest, chars; `longest` is above every pos."""
        bands = self.keep(elements.groupBy("conv_id", self.band().alias("band")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("e")), "trie-bands")
        digests = F.col("e.digest")
        if longest > self.height:
            whole = _sha(F.aggregate(digests, F.lit(b""), lambda a, x: F.concat(a, x)))
            up = self.chain(bands.select("conv_id", F.col("band").alias("pos"), whole.alias("digest"), F.lit(0).cast("long").alias("chars")),
                            -(-longest // self.height), level + 1)
            at = F.posexplode("ids").alias("i", "end")
            up = up.select("conv_id", "band", "before", "ids", at).select(
                "conv_id", (F.col("band") * self.height + F.col("i")).alias("band"), "end",
                F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("ids", F.col("i") - 1)).alias("before"))
            bands = bands.join(up, ["conv_id", "band"])
        else:
            bands = bands.withColumns({"before": F.lit(ROOT), "end": F.lit(None).cast("binary")})
        tag = F.lit(bytes([level]))
        linked = F.aggregate(digests, F.array("before"),
                             lambda a, x: F.concat(a, F.array(_sha(F.concat(tag, F.element_at(a, -1), x)))))
        ids = F.slice(linked, 2, self.height)
        full = (F.size("e") == self.height) & F.col("end").isNotNull()
        ids = F.when(full, F.concat(F.slice(ids, 1, self.height - 1), F.array("end"))).otherwise(ids)
        self.paths[level] = self.keep(bands.select("conv_id", "band", "before", ids.alias("ids"), F.col("e.chars").alias("chars")), "trie-paths")
        return self.paths[level]

    def nodes(self) -> DataFrame:
        """All nodes but the root: id, conv_id, pos (depth - 1), parent, n_convs, chars."""
        at = F.posexplode(F.arrays_zip("ids", "chars")).alias("i", "e")
        rows = self.paths[0].select("conv_id", "band", "before", "ids", at).select(
            "conv_id", (F.col("band") * self.height + F.col("i")).alias("pos"), F.col("e.ids").alias("id"), F.col("e.chars").alias("chars"),
            F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("ids", F.col("i") - 1)).alias("parent"))
        return rows.groupBy("id").agg(F.min("conv_id").alias("conv_id"), F.min("pos").alias("pos"), F.min("parent").alias("parent"),
                                      F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"))

    def totals(self, elements: DataFrame, longest: int, level: int = 0) -> DataFrame:
        """(id, leaves, saved) summed over the subtree of each element of a
        level, its top included.  `elements`: id, conv_id, pos, leaves, saved."""
        values = ("leaves", "saved")
        where = self.paths[level].select("conv_id", "band", "before", "ids")
        placed = elements.withColumn("band", self.band()).join(where, ["conv_id", "band"]).select(
            "id", "conv_id", "pos", "before", F.slice("ids", 1, (F.col("pos") % self.height + 1).cast("int")).alias("path"), *values)
        if longest > self.height:
            placed = self.keep(placed, "trie-placed")
            below = placed.filter(F.col("pos") >= self.height).groupBy(F.col("before").alias("id")).agg(*(F.sum(v).alias(v) for v in values))
            roots = placed.filter(self.ends()).select("id", "conv_id", self.band().alias("pos")).join(below, "id", "left").fillna(0, values)
            done = self.totals(roots, -(-longest // self.height), level + 1).select("id", *(F.col(v).alias(f"done_{v}") for v in values))
            placed = placed.join(done, "id", "left").fillna(0, [f"done_{v}" for v in values]).withColumns(
                {v: F.col(v) + F.col(f"done_{v}") for v in values})
        exploded = placed.select(F.explode("path").alias("id"), *values)
        return exploded.groupBy("id").agg(*(F.sum(v).alias(v) for v in values))

    def last_nodes(self, convs: DataFrame) -> DataFrame:
        """(id, conv_id): the node at which each rebuilt conversation ends."""
        some = convs.filter("length > 0").select("conv_id", F.floor((F.col("length") - 1) / self.height).alias("band"))
        none = convs.filter("length = 0").select(F.lit(ROOT).alias("id"), "conv_id")
        return some.join(self.paths[0], ["conv_id", "band"]).select(F.element_at("ids", -1).alias("id"), "conv_id").unionByName(none)


def digests_of_ids(rows: DataFrame) -> DataFrame:
    """(id, ends_sha256): SHA-256 of the decimal conv_ids of each id, ascending
    and joined by commas.  Ranges of (id, conv_id) join their ids to pieces in
    many tasks; only the pieces of one id, in order, pass through one hash."""

    def pieces(batches):
        part = TaskContext.get().partitionId()
        nth = 0
        for batch in batches:
            out = []
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for key, group in groupby(pairs, key=lambda p: p[0]):
                held, size = [], 0
                for _, conv in group:
                    held.append(str(conv))
                    size += len(held[-1]) + 1
                    if size >= PIECE_BYTES:
                        out.append((key, part, nth, ",".join(held)))
                        nth, held, size = nth + 1, [], 0
                if held:
                    out.append((key, part, nth, ",".join(held)))
                    nth += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.binary(), pa.int32(), pa.int64(), pa.string()))],
                names=["id", "part", "nth", "piece"])

    def digests(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if state is None or k != key:
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
            yield _digest_rows(out)
        if state is not None:
            yield _digest_rows([(key, state.hexdigest())])

    def _digest_rows(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 2, (pa.binary(), pa.string()))],
                                          names=["id", "ends_sha256"])

    joined = (rows.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
              .mapInArrow(pieces, "id binary, part int, nth long, piece string"))
    return joined.repartition("id").sortWithinPartitions("id", "part", "nth").mapInArrow(digests, "id binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of `rows`
    (conv_id, turn, role, text): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by `turn`, NULL first; turns with the same number are
    ordered by a digest of role and text, so equal ones are interchangeable.  NULL
    role or text is empty, NULL conv_ids belong to no conversation.  Every
    conversation is rebuilt (:func:`conversations`); those without a turn left are
    members of the root alone.  Without conversations there is no root either:
    no rows.  Other columns, whatever their names, stay out."""
    spark = rows.sparkSession
    trie = Trie(height)
    with owned_stages(spark):
        own = trie.keep(turns(rows.select("conv_id", "turn", "role", "text")), "trie-turns")
    convs = trie.keep(conversations(own), "trie-conversations")
    size = convs.agg(F.max("length").alias("longest"), F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n")).first()
    longest, root_conv = int(size["longest"] or 0), size["first"]
    trie.chain(rebuilt(own, convs), longest)
    nodes = trie.keep(trie.nodes(), "trie-nodes")
    children = nodes.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    valued = nodes.join(children, "id", "left").fillna(0, ["n_children"]).withColumns(
        {"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")})
    valued = trie.keep(valued, "trie-values")
    totals = trie.totals(valued.select("id", "conv_id", "pos", "leaves", "saved"), longest)
    names = valued.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    inner = valued.filter("pos > 0").join(names, "parent").unionByName(valued.filter("pos = 0").withColumn("parent_conv_id", F.lit(root_conv).cast("long")))
    body = inner.drop("leaves", "saved").join(totals, "id").select(
        "id", "conv_id", (F.col("pos") + 1).alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"))
    root = valued.agg(F.count(F.when(F.col("pos") == 0, 1)).alias("n_children"), F.coalesce(F.sum("leaves"), F.lit(0)).alias("leaves"),
                      F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"))
    root = root.select(F.lit(ROOT).alias("id"), F.lit(root_conv).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
                       F.lit(None).cast("long").alias("parent_conv_id"), F.lit(size["n"]).cast("long").alias("n_convs"), "n_children",
                       F.greatest("leaves", F.lit(1)).alias("n_leaves"), "saved_tokens").filter(F.lit(root_conv is not None))
    ends = digests_of_ids(trie.last_nodes(convs))
    out = body.unionByName(root).join(ends, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
    result, _ = store(out, "trie")
    for path in trie.stored:
        drop_stored(spark, path)
    return result
