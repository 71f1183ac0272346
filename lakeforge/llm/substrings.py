"""Substring deduplication by level-wise doubling.

The first level takes the windows of `min_words` consecutive words of each
document.  Windows that repeat in another document, and only those, are
extended to twice the length: a window of 2n words starts at word i if the
windows of n words at i and at i + n both repeat.  Doubling goes on until no
candidate survives.  Every window that repeats at a higher level is made of
windows that repeat at the first one, so the first level alone decides which
words go: those covered by a window whose words also start in a document with
a smaller id.  The higher levels tell how long the repeats are.

Windows are compared by 64-bit keys (XXH64 of the words, combined by position
and mixed).  All texts are read whole.  NULL text has no words; a NULL id is
the greatest id.  Rows with the same id are one document: repeats among them
do not count.  Intermediate tables lie in the shared checkpoint folder and are
deleted as soon as a level is done."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, id_and_text, store, with_null_ids
from .exchange import Deal, by_group, contains, deal, extremes, mix, pack, shared_keys, unpack

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
STATE = ("grp long, doc_id long, text_key long, n_words long, longest long, spans binary, starts binary, keys binary")
_TYPES = [pa.int64()] * 5 + [pa.binary()] * 3
_NAMES = [c.split()[0] for c in STATE.split(", ")]


def word_keys(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words in order, and the number of words of each text."""
    split = [(t or "").encode("utf-8", "replace").split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    keys = np.fromiter((xxhash.xxh64_intdigest(w) for words in split for w in words), np.uint64, int(sizes.sum()))
    return keys, sizes


def window_keys(keys: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, key) of every window of `length` words inside one text."""
    n = len(keys) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    window = np.zeros(n, np.uint64)
    for k in range(length):
        window = window * MULTIPLIER + keys[k:k + n]
    inside = np.arange(n) + length <= np.repeat(np.cumsum(sizes), sizes)[:n]
    starts = np.flatnonzero(inside)
    return starts, mix(window[starts])


def text_key(text: str | None) -> int:
    return xxhash.xxh64_intdigest((text or "").encode("utf-8", "replace")) - 2**63


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of `length` from one of `starts`."""
    change = np.zeros(n + 1, np.int64)
    change[starts] += 1
    change[starts + length] -= 1
    return np.cumsum(change[:-1]) > 0


def runs(flags: np.ndarray) -> np.ndarray:
    """Start and end of each run of true values, one after another."""
    return np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))


def _first_keys(docs: DataFrame, length: int, plan: Deal) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield from pack(((g, np.unique(window_keys(*word_keys(rows.column(1).to_pylist()), length)[1]))
                             for g, rows in by_group(batch)), plan.buckets)

    return docs.mapInArrow(run, "bucket int, grp long, keys binary")


def _state_rows(rows) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(_NAMES), _TYPES)], names=_NAMES)


def _first_level(docs: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    """State after the first level: words to remove and repeating windows."""

    def run(key, texts: pa.Table, answer: pa.Table) -> pa.Table:
        ids = texts.column("doc_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        text = texts.column("text").take(pa.array(order)).to_pylist()
        words, sizes = word_keys(text)
        starts, keys = window_keys(words, sizes, length)
        rank = np.cumsum(np.concatenate([[0], ids[1:] != ids[:-1]])) if len(ids) else ids
        owner = np.repeat(rank, sizes)[starts]
        least, greatest = extremes(keys, owner)
        earlier = contains(unpack(answer.column("earlier")), keys)
        later = contains(unpack(answer.column("later")), keys)
        remove = covered(starts[earlier | (owner > least)], length, len(words))
        again = np.flatnonzero(earlier | later | (least != greatest))
        starts, keys = starts[again], keys[again]
        ends = np.cumsum(sizes)
        cuts = np.searchsorted(starts, np.concatenate([[0], ends]))
        out = []
        for k, (doc, t, size, end) in enumerate(zip(ids.tolist(), text, sizes.tolist(), ends.tolist())):
            a, b = cuts[k], cuts[k + 1]
            out.append((key[0].as_py(), doc, text_key(t), size, length if b > a else 0,
                        runs(remove[end - size:end]).astype("<u4").tobytes(),
                        (starts[a:b] - (end - size)).astype("<u4").tobytes(), keys[a:b].tobytes()))
        return _state_rows(out)

    return docs.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(run, STATE)


def _doubled(starts: bytes, keys: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of twice the length whose two halves both repeat."""
    s, k = np.frombuffer(starts, "<u4").astype(np.int64), np.frombuffer(keys, "<u8")
    if not len(s):
        return s, k
    other = np.minimum(np.searchsorted(s, s + length), len(s) - 1)
    ok = s[other] == s + length
    return s[ok], mix(k[ok] * MULTIPLIER + k[other[ok]])


def _next_keys(state: DataFrame, length: int, plan: Deal) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield from pack(((g, np.unique(np.concatenate([_doubled(s, k, length)[1] for s, k in zip(
                rows.column(1).to_pylist(), rows.column(2).to_pylist())]))) for g, rows in by_group(batch)), plan.buckets)

    return state.select("grp", "starts", "keys").filter(F.octet_length("starts") > 0).mapInArrow(
        run, "bucket int, grp long, keys binary")


def _next_level(state: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    def run(key, table: pa.Table, answer: pa.Table) -> pa.Table:
        rows = sorted(zip(*(c.to_pylist() for c in table.columns)), key=lambda r: (r[1], r[2]))
        made = [_doubled(r[6], r[7], length) for r in rows]
        rank = np.cumsum([0] + [a[1] != b[1] for a, b in zip(rows, rows[1:])])
        keys = np.concatenate([k for _, k in made]) if made else np.empty(0, np.uint64)
        owner = np.repeat(rank[:len(made)], [len(k) for _, k in made])
        least, greatest = extremes(keys, owner)
        again = (least != greatest) | contains(np.sort(np.concatenate(
            [unpack(answer.column("earlier")), unpack(answer.column("later"))])), keys)
        out, at = [], 0
        for r, (s, k) in zip(rows, made):
            keep = again[at:at + len(k)]
            at += len(k)
            out.append((*r[:4], 2 * length if keep.any() else r[4], r[5], s[keep].astype("<u4").tobytes(), k[keep].tobytes()))
        return _state_rows(out)

    return state.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(run, STATE)


def _without(docs: DataFrame, state: DataFrame) -> DataFrame:
    """Each document with its spans cut out."""
    schema = "doc_id long, n_words long, n_removed long, longest_repeat long, spans array<struct<start:int,end:int>>, kept_text string"

    def run(key, texts: pa.Table, table: pa.Table) -> pa.Table:
        known = {(d, t): (longest, spans) for d, t, longest, spans in zip(
            *(table.column(c).to_pylist() for c in ("doc_id", "text_key", "longest", "spans")))}
        out = []
        for doc, text in zip(texts.column("doc_id").to_pylist(), texts.column("text").to_pylist()):
            words = text.encode("utf-8", "replace").split()
            longest, spans = known[doc, text_key(text)]
            cut = np.frombuffer(spans, "<u4").reshape(-1, 2).tolist()
            kept, at = [], 0
            for a, b in cut:
                kept += words[at:a]
                at = b
            kept += words[at:]
            out.append((doc, len(words), len(words) - len(kept), longest, [{"start": a, "end": b} for a, b in cut],
                        b" ".join(kept).decode()))
        types = [pa.int64()] * 4 + [pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.string()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, types)],
                        names=["doc_id", "n_words", "n_removed", "longest_repeat", "spans", "kept_text"])

    return docs.groupBy("grp").cogroup(state.groupBy("grp")).applyInArrow(run, schema)


def deduplicate(docs: DataFrame, min_words: int = 13) -> DataFrame:
    """Per document row: doc_id, n_words, n_removed, longest_repeat (length of
    the highest level at which it has a repeating window, else 0), spans
    (removed runs of words) and kept_text (the other words, one space between)."""
    spark = docs.sparkSession
    texts = id_and_text(docs)
    plan = deal(texts, keys_per_byte=0.16)
    texts = plan.dealt(texts).select("grp", "text", "doc_id")
    answers, answers_path = store(shared_keys(_first_keys(texts, min_words, plan), plan.owners), "windows")
    state, state_path = store(_first_level(texts, answers, min_words), "levels")
    drop_stored(spark, answers_path)
    length = min_words
    while left := (state.agg(F.sum(F.octet_length("starts"))).first()[0] or 0) // 4:
        level = Deal(plan.ids, max(16, min(plan.buckets, left // 500_000)))
        answers = shared_keys(_next_keys(state, length, level), plan.owners)
        following, path = store(_next_level(state, answers, length), "levels")
        drop_stored(spark, state_path)
        state, state_path, length = following, path, 2 * length
    return with_null_ids(_without(texts, state))
