"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is found in a document when at least `threshold` of the item's
distinct five-word shingles occur in the document; an item of fewer words is
one shingle, its whole word sequence.  Items are short and documents long, so
Jaccard banding would miss them; the search works on containment instead.
Items are partitioned by size (powers of two of their shingle count).  In a
partition whose items have at most u shingles, an item's signature is its
`u - ceil(threshold * u) + 1` smallest MinHash values: a document that holds
enough of the item misses fewer shingles than that, so it meets at least one
value of the signature.  No item is missed.

The search is a chain of joins, in which neither side passes through the
driver.  Tasks write the items with their signatures.  Documents are hashed
once; a filter of the signature values (at most `LARGEST_FILTER` words, the
only thing that is broadcast) leaves the shingles that may be in a signature,
and these meet the signature values in a salted join, so that a passage that a
third of all documents hold spreads over many tasks.  Equal texts are searched
once.  Each candidate's items come to its text in chunks of `CHUNK` for the
exact check, shingle by shingle, over the whole text.

Words are runs of letters and digits, A-Z lower-cased, other ASCII characters
separate.  Items without a word match nothing; neither do NULL texts.  Items
without an id are not reported by `search`, but `clean` drops the documents
that hold them.  Repeated rows are judged one by one; repeated item ids are
merged into one item per text.  What is found in a text goes back to its rows
by 128 bits of the text's hashes."""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop_stored, store

SHINGLE = 5
THRESHOLD = 0.8
#: 64-bit words of the broadcast filters: two keys a word up to this size.
LEAST_FILTER, LARGEST_FILTER = 2**10, 2**22
#: Bits per key in its word of the filter, and the first bit of the key that chooses them.
BITS, FIRST_BIT = 4, 22
#: Parts into which a hot key of a join is split.
SALTS = 16
#: Items that are sent to a text at a time.
CHUNK = 64
# ASCII letters to lower case, other ASCII characters but digits to blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


def shingles(w: list[bytes], size: int = SHINGLE) -> list[bytes]:
    """Shingles of `size` words in order, repeats included."""
    joined = b" ".join(w)
    ends = list(accumulate(len(x) + 1 for x in w))
    return list(map(joined.__getitem__, map(slice, [0, *ends], (e - 1 for e in ends[size - 1:]))))


def hashes(w: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the shingles, in order of their value."""
    s = shingles(w, size)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, s), np.uint64, len(s)))


def needed(n: int, threshold: float) -> int:
    """Shingles of n that a document must hold."""
    return math.ceil(threshold * n - 1e-9)


def signature(w: list[bytes], threshold: float) -> np.ndarray:
    h = hashes(w, min(SHINGLE, len(w)))
    u = 1 << (len(h) - 1).bit_length()  # the largest size of its partition
    return h[:u - needed(u, threshold) + 1]


def signed_items(items: DataFrame, threshold: float, named: bool) -> DataFrame:
    """(item, item_id, text, size, signature): the items with a word, their
    key, words per shingle and signature; those without an id only if they
    need not be `named`."""
    known = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    known = known.filter("text IS NOT NULL").distinct()
    known = known.filter("item_id IS NOT NULL") if named else known

    def sign(batches):
        for batch in batches:
            split = [words(t) for t in batch.column("text").to_pylist()]
            keep = pa.array([bool(w) for w in split], pa.bool_())
            split = [w for w in split if w]
            yield pa.RecordBatch.from_arrays(
                [*batch.filter(keep).columns, pa.array([min(SHINGLE, len(w)) for w in split], pa.int32()),
                 pa.array([signature(w, threshold).view(np.int64) for w in split], pa.list_(pa.int64()))],
                names=["item", "item_id", "text", "size", "signature"])

    return known.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text").mapInArrow(
        sign, "item long, item_id long, text string, size int, signature array<long>")


def key_filter(keys: DataFrame, largest: int) -> np.ndarray:
    """A blocked Bloom filter of the 64-bit `key` column: a word is chosen by
    the low bits of a key, its bits by the next ones.  Tasks fill the words,
    of which the driver gets no more than `largest`."""
    size = 1 << max(0, math.ceil(math.log2(max(LEAST_FILTER, keys.count() // 2))))
    size = min(size, largest)
    bits = F.lit(0).cast("long")
    for k in range(BITS):
        at = F.shiftrightunsigned("key", FIRST_BIT + 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    filled = keys.select(F.col("key").bitwiseAND(F.lit(size - 1)).alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    rows = filled.toArrow()
    out = np.zeros(size, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(words_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the (unsigned) keys may be in the filter."""
    bits = np.zeros(len(keys), np.uint64)
    for k in range(BITS):
        bits |= np.uint64(1) << ((keys >> np.uint64(FIRST_BIT + 6 * k)) & np.uint64(63))
    return words_[(keys & np.uint64(len(words_) - 1)).astype(np.int64)] & bits == bits


def salted_join(many: DataFrame, few: DataFrame, on: str, by: str) -> DataFrame:
    """Inner join in which a value of `on` that many rows hold is split into
    SALTS parts by the hash of `by`; the other side is repeated for each."""
    left = many.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    right = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [on, "salt"]).drop("salt")


def _keys(text="text") -> list:
    """Two hashes that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _candidates(texts: DataFrame, signed: DataFrame, sizes: list[int], largest: int) -> DataFrame:
    """(k1, k2, item): the texts that meet a value of the item's signature."""
    spark = texts.sparkSession
    values = signed.select(F.explode("signature").alias("key"), "item")
    sent = spark.sparkContext.broadcast(key_filter(values.select("key"), largest))

    def meet(batches):
        for batch in batches:
            met = []
            for text in batch.column("text").to_pylist():
                w = words(text)
                h = np.concatenate([hashes(w, k) for k in sizes])
                met.append(h[may_hold(sent.value, h)].view(np.int64))
            some = pa.array([bool(len(x)) for x in met], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.select(["k1", "k2"]).filter(some).columns,
                                              pa.array([x for x in met if len(x)], pa.list_(pa.int64()))], names=["k1", "k2", "met"])

    # Equal texts meet the same values: one of them goes on.
    hits = texts.mapInArrow(meet, "k1 long, k2 long, met array<long>").distinct()
    hits = hits.select("k1", "k2", F.explode("met").alias("key"))
    return salted_join(hits, values, "key", "k1").select("k1", "k2", "item").distinct()


def _verified(texts: DataFrame, candidates: DataFrame, signed: DataFrame, threshold: float, largest: int) -> DataFrame:
    """(k1, k2, item_id, n_shingles, n_shared): the candidates whose
    containment reaches the threshold."""
    sent = texts.sparkSession.sparkContext.broadcast(key_filter(candidates.select(F.col("k1").alias("key")), largest))

    def pick(batches):
        for batch in batches:
            keys = batch.column("k1").to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(may_hold(sent.value, keys)))

    def check(batches):
        for batch in batches:
            rows, last, inside = [], None, {}
            for k1, k2, text, chunk in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) != last:
                    last, w, inside = (k1, k2), words(text), {}
                for item in chunk:
                    size = item["size"]
                    if size not in inside:
                        inside[size] = frozenset(shingles(w, size))
                    wanted = frozenset(shingles(words(item["text"]), size))
                    shared = len(wanted & inside[size])
                    if shared >= needed(len(wanted), threshold):
                        rows.append((k1, k2, item["item_id"], len(wanted), shared))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 5)],
                                             names=["k1", "k2", "item_id", "n_shingles", "n_shared"])

    place = F.row_number().over(W.partitionBy("k1", "k2").orderBy("item"))
    numbered = candidates.withColumn("chunk", F.floor((place - 1) / F.lit(CHUNK)))
    items = signed.select("item", F.struct("item_id", "text", "size").alias("of"))
    chunks = salted_join(numbered, items, "item", "k1").groupBy("k1", "k2", "chunk").agg(F.collect_list("of").alias("items"))
    some = texts.mapInArrow(pick, texts.schema).distinct()
    return some.join(chunks, ["k1", "k2"]).select("k1", "k2", "text", "items").mapInArrow(
        check, "k1 long, k2 long, item_id long, n_shingles long, n_shared long")


def found_in_texts(docs: DataFrame, items: DataFrame, threshold: float, named: bool, largest: int) -> DataFrame:
    """(k1, k2, item_id, n_shingles, n_shared) per distinct text and item
    found in it, stored."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").select(*_keys(), "text")
    signed, items_path = store(signed_items(items, threshold, named), "benchmark-items")
    sizes = sorted(r[0] for r in signed.select("size").distinct().collect()) or [SHINGLE]
    candidates, path = store(_candidates(texts, signed, sizes, largest), "benchmark-candidates")
    found, _ = store(_verified(texts, candidates, signed, threshold, largest), "benchmark-found")
    drop_stored(spark, items_path)
    drop_stored(spark, path)
    return found


def search(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, largest_filter: int = LARGEST_FILTER) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared): one row per document row and
    item found in it.  The size of the filters changes no result."""
    found = found_in_texts(docs, items, threshold, True, largest_filter)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.filter("text IS NOT NULL").select("doc_id", *_keys())
    return keyed.join(found, ["k1", "k2"]).select("doc_id", "item_id", "n_shingles", "n_shared")


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, largest_filter: int = LARGEST_FILTER) -> DataFrame:
    """The rows of `docs` that hold no item, all columns unchanged."""
    found = found_in_texts(docs, items, threshold, False, largest_filter).select("k1", "k2").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row")).select(*_keys(F.col("row.text").cast("string")), "row")
    # A NULL text holds nothing, and no key of a NULL text is ever found.
    kept = rows.join(found, ["k1", "k2"], "left_anti")
    return kept.select("row.*")
