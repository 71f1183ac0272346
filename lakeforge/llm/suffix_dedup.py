"""Exact substring deduplication with suffix arrays built by induced sorting.

Every string of `length` bytes (a window) that also starts anywhere else, in
the same document or in another, is found, and the bytes it covers go.

Dealing windows to shards.  A window belongs to its anchor: the `gram`-byte
string in it with the least hash (leftmost of equals).  Equal windows have
equal anchors, so an anchor that occurs once rules out all its windows, and
the windows of one anchor can be judged in one shard.  Neighbouring windows
mostly share their anchor; the text they span together is a context.

Shards.  Equal contexts are merged, with their number.  The distinct contexts
of a shard are joined, with separators, into one string; its suffix array
comes from induced sorting (suffixes classified, leftmost-smaller substrings
sorted recursively, the array induced in linear time) and its permuted common
prefixes tell for each window whether a neighbour in the array shares `length`
bytes.  Matches never cross a separator, hence no document.

Hot anchors.  An anchor with more than `hot_rows` contexts (a passage in a
large share of all documents, each with other surroundings) does not go to one
shard: its windows are compared one by one by 128-bit hash in a grouped count
that pre-aggregates, and the result is the same.

NULL text is empty, NULL ids come last, repeated rows count as repeats of each
other.  Hashes only rule windows out or name equal texts (128 bits); what goes
is decided on bytes in the shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, id_and_text, store, with_null_ids
from .exchange import Deal, by_group, contains, deal, extremes, mix, pack, shared_keys, unpack
from .suffix_array import permuted_common_prefixes, suffix_array

#: Bytes of text whose windows are listed at a time.
SEGMENT = 1 << 20
#: Bytes of contexts per shard.
SHARD_BYTES = 3 * 2**20
HOT_ROWS = 20_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
CONTEXTS = "grp long, key long, ctx int, n int, text binary, places binary"
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    if base not in _powers or len(_powers[base]) < n:
        size = max(n, SEGMENT + 4096)
        _powers[base] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]))
    return _powers[base][:n]


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _segments(texts: list[bytes], length: int):
    """Texts in runs of at most SEGMENT bytes: (index, offset, bytes) lists.
    A longer text comes in parts that overlap by length - 1 bytes, so each
    window lies in exactly one part."""
    some, size = [], 0
    for k, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), SEGMENT):
            part = t[at:at + SEGMENT + length - 1] if len(t) > SEGMENT else t
            if size + len(part) > SEGMENT and some:
                yield some
                some, size = [], 0
            some.append((k, at, part))
            size += len(part)
            if len(t) <= SEGMENT:
                break
    if some:
        yield some


def anchors(texts: list[bytes], length: int, gram: int):
    """For each run of windows with one anchor: index of the text, start of
    the first window, number of windows, key of the anchor."""
    out = []
    for some in _segments(texts, length):
        buffer = np.frombuffer(b"".join(p for *_, p in some), np.uint8)
        n, width = len(buffer), length - gram + 1
        if n < length:
            continue
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_byte_values()[buffer] * _power(_BASE, n))])
        key = mix((sums[gram:] - sums[:-gram]) * _power(_INVERSE, n - gram + 1))
        least = (key & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(key), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        windows = n - length + 1
        least = np.minimum(least[:windows], least[width - span:width - span + windows])
        sizes = np.array([len(p) for *_, p in some])
        ends = np.cumsum(sizes)
        which = np.repeat(np.arange(len(some)), sizes)[:windows]
        starts = np.flatnonzero(np.arange(windows) + length <= ends[which])
        if not len(starts):
            continue
        at = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        part = which[starts[first]]
        begin = starts[first] - (ends - sizes)[part] + np.array([a for _, a, _ in some])[part]
        # Least hashes crowd at the low end; mixed again they spread over all buckets.
        spread = mix(key[at[first]] ^ np.uint64(_BASE))
        out.append((np.array([k for k, *_ in some])[part], begin, np.diff(np.append(first, len(starts))), spread))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _anchor_keys(docs: DataFrame, length: int, gram: int, plan: Deal) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield from pack(((g, np.unique(anchors([t.encode("utf-8", "replace") for t in rows.column(1).to_pylist()],
                                                   length, gram)[3])) for g, rows in by_group(batch)), plan.buckets)

    return docs.mapInArrow(run, "bucket int, grp long, keys binary")


def _in_order(texts: pa.Table) -> list[tuple[int, bytes]]:
    """A group's documents in an order that no shuffle changes."""
    return sorted(zip(texts.column("doc_id").to_pylist(),
                      (t.encode("utf-8", "replace") for t in texts.column("text").to_pylist())))


def _contexts(docs: DataFrame, answers: DataFrame, length: int, gram: int) -> DataFrame:
    """Per group: its distinct contexts of repeating anchors, and one row
    (ctx -1) with the place of every occurrence of them."""

    def run(key, texts: pa.Table, answer: pa.Table) -> pa.Table:
        grp = key[0].as_py()
        raw = [t for _, t in _in_order(texts)]
        which, begin, count, keys = anchors(raw, length, gram)
        least, greatest = extremes(keys, np.arange(len(keys)))
        known = np.sort(np.concatenate([unpack(answer.column("earlier")), unpack(answer.column("later"))]))
        again = np.flatnonzero((least != greatest) | contains(known, keys))
        found: dict = {}
        rows, places = [], []
        for w, a, c, k in zip(*(x[again].tolist() for x in (which, begin, count, keys.view(np.int64)))):
            text = raw[w][a:a + c + length - 1]
            at = found.setdefault((k, text), len(rows))
            if at == len(rows):
                rows.append([grp, k, at, 0, text, None])
            rows[at][3] += 1
            places.append((w, a, at))
        if places:
            rows.append([grp, 0, -1, 0, None, np.array(places, "<u4").tobytes()])
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, (
            pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
            names=["grp", "key", "ctx", "n", "text", "places"])

    return docs.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(run, CONTEXTS)


def _repeating(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Which windows of each of some distinct texts start elsewhere too."""
    sizes = np.array([len(t) for t in texts])
    joined = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8).astype(np.int64) + 2
    starts = np.cumsum(sizes + 1) - sizes - 1
    joined[starts + sizes] = 1  # separators
    joined = np.append(joined, 0)
    array = suffix_array(joined, 258)
    common = permuted_common_prefixes(joined, array, stop=1)
    again = common >= length
    following = array[1:][common[array[1:]] >= length]
    rank = np.empty(len(array), np.int64)
    rank[array] = np.arange(len(array))
    again[array[rank[following] - 1]] = True
    return [again[a:a + n - length + 1] for a, n in zip(starts, sizes)]


def _shards(contexts: DataFrame, shards: int, length: int) -> DataFrame:
    """(grp, ctx, flags): a byte per window of the context, 1 if it repeats."""

    def run(table: pa.Table) -> pa.Table:
        key, n = table.column("key").to_numpy(), table.column("n").to_pylist()
        classes: dict[int, dict[bytes, list[int]]] = {}
        for i, (k, t) in enumerate(zip(key.tolist(), table.column("text").to_pylist())):
            classes.setdefault(k, {}).setdefault(t, []).append(i)
        flags: list = [None] * len(n)
        compared = []
        for found in classes.values():
            for text, where in found.items():
                if sum(n[i] for i in where) > 1:
                    every = b"\1" * (len(text) - length + 1)
                    for i in where:
                        flags[i] = every
            if len(found) > 1:
                compared += found.items()
        if compared:
            for (_, where), again in zip(compared, _repeating([t for t, _ in compared], length)):
                if again.any():
                    for i in where:
                        flags[i] = flags[i] or again.astype(np.uint8).tobytes()
        hit = [i for i, f in enumerate(flags) if f]
        return pa.table({"grp": table.column("grp").take(pa.array(hit, pa.int64())),
                         "ctx": table.column("ctx").take(pa.array(hit, pa.int64())),
                         "flags": pa.array([flags[i] for i in hit], pa.binary())})

    dealt = contexts.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, "grp long, ctx int, flags binary")


def _hot(contexts: DataFrame, length: int) -> DataFrame:
    """The same for contexts of hot anchors, window by window."""

    def run(batches):
        for batch in batches:
            for grp, ctx, n, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                           for c in ("grp", "ctx", "n", "text"))):
                m = len(text) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([grp] * m, pa.int64()), pa.array([ctx] * m, pa.int32()), pa.array([m] * m, pa.int32()),
                     pa.array(range(m), pa.int32()), pa.array([n] * m, pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(text[i:i + length]) for i in range(m)], pa.binary())],
                    names=["grp", "ctx", "m", "at", "n", "w"])

    windows = contexts.mapInArrow(run, "grp long, ctx int, m int, at int, n long, w binary")
    again = windows.groupBy("w").agg(F.sum("n").alias("total")).filter("total > 1").select("w")
    hit = windows.join(again, "w").groupBy("grp", "ctx", "m").agg(F.collect_set("at").alias("ats"))
    flags = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda i: F.when(F.array_contains("ats", i), "01").otherwise("00"))
    return hit.select("grp", "ctx", F.unhex(F.array_join(flags, "")).alias("flags"))


def _without(docs: DataFrame, notes: DataFrame, length: int) -> DataFrame:
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"

    def run(key, texts: pa.Table, note: pa.Table) -> pa.Table:
        rows = _in_order(texts)
        flags = {c: f for c, f in zip(note.column("ctx").to_pylist(), note.column("flags").to_pylist()) if c >= 0}
        places = b"".join(p for p in note.column("places").to_pylist() if p)
        starts: dict[int, list[np.ndarray]] = {}
        for w, a, c in np.frombuffer(places, "<u4").reshape(-1, 3).tolist():
            if c in flags:
                starts.setdefault(w, []).append(a + np.flatnonzero(np.frombuffer(flags[c], np.uint8)))
        out = []
        for w, (doc, raw) in enumerate(rows):
            if w not in starts:
                out.append((doc, len(raw), 0, 0, raw))
                continue
            at = np.concatenate(starts[w])
            change = np.zeros(len(raw) + 1, np.int64)
            change[at] += 1
            change[at + length] -= 1
            gone = np.cumsum(change[:-1]) > 0
            spans = np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]]))
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            out.append((doc, len(raw), len(raw) - len(kept), spans, kept))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, [pa.int64()] * 4 + [pa.binary()])],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return docs.groupBy("grp").cogroup(notes.groupBy("grp")).applyInArrow(run, schema)


def deduplicate(docs: DataFrame, length: int = 200, gram: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs) and kept (the other bytes)."""
    spark, gram = docs.sparkSession, gram or (length + 1) // 2
    texts = id_and_text(docs)
    plan = deal(texts, keys_per_byte=0.025)
    texts = plan.dealt(texts).select("grp", "text", "doc_id")
    answers, answers_path = store(shared_keys(_anchor_keys(texts, length, gram, plan)), "anchors")
    contexts, contexts_path = store(_contexts(texts, answers, length, gram), "contexts")
    drop_stored(spark, answers_path)

    some = contexts.filter("ctx >= 0")
    counted = some.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > hot_rows)
    # At most (all contexts / hot_rows) keys.
    hot = F.broadcast(counted.select("key"))
    size = some.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(64, size // SHARD_BYTES)
    flags = _shards(some.join(hot, "key", "left_anti"), int(shards), length).unionByName(
        _hot(some.join(hot, "key", "left_semi"), length))
    flags, _ = store(flags, "flags")
    notes = (flags.withColumn("places", F.lit(None).cast("binary"))
             .unionByName(contexts.filter("ctx < 0").select("grp", "ctx", F.lit(None).cast("binary").alias("flags"), "places")))
    return with_null_ids(_without(texts, notes, length))
