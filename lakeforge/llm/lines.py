"""Line deduplication with a suffix array over line-id sequences.

Each document is the sequence of the ids of its lines (64-bit hashes of the
lines without white space at their ends; blank lines are no part of it and
stay).  The suffix array of all sequences is built by distributed prefix
doubling: a suffix's rank by its first 2n lines is its place among those with
the same rank by n lines, in order of the rank n lines on.  A rank is the place
of its class in the array, so a class is refined within its own stretch of
ranks and nothing else moves.  Suffixes alone in their class are settled and
leave the sort.

Classes with several members after n lines are the intervals of the array with
a longest common prefix of at least n: their members start the same run of n
lines.  A run of `min_lines` or more lines is deleted wherever the same run
starts earlier (smaller doc_id, or further up in the same document), so that
the maximal repeated runs keep their first copy only; a single line is such a
run unless `min_lines` says otherwise.  Doubling goes on until every suffix is
settled and tells how long the repeats are.

Ranks are found in buckets (stretches of ranks).  Groups of documents send each
distinct pair of ranks once, with its count, so a line that half of all
documents hold is one entry per group.

NULL text has no lines and stays as an empty text; NULL ids come last.  Rows
with one id are ordered by their text, so of equal rows the later one is a copy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NULL_ID, drop_stored, id_and_text, store, with_null_ids
from .exchange import Deal, by_group, deal, extremes, mix
from .substrings import MULTIPLIER, covered, runs

#: Ranks of one bucket: a stretch of 2 ** SHIFT.
SHIFT = 40
PAIRS = "bucket int, grp long, first binary, second binary, counts binary"
ANSWER = "grp long, first binary, second binary, ranks binary, earlier binary"
STATE = "grp long, at int, longest int, runs binary, starts binary, ranks binary"
_STRIP = " \t\n\v\f\r"


def line_ids(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All lines, the numbers of those that aren't blank, and their ids."""
    lines = text.split("\n")
    trimmed = [x.strip(_STRIP) for x in lines]
    full = np.flatnonzero([bool(x) for x in trimmed])
    ids = np.fromiter((xxhash.xxh64_intdigest(trimmed[i].encode("utf-8", "replace")) for i in full), np.uint64, len(full))
    return lines, full, ids


def first_pairs(ids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Before the first level all suffixes of a bucket are one class and line
    ids stand for the ranks to sort by."""
    bucket = ((ids >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return bucket << np.uint64(SHIFT), ids


def next_pairs(starts: bytes, ranks: bytes, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, rank, rank `step` lines on) where both are unsettled; a suffix
    that ends, or goes on with a settled one, is settled by that."""
    s, r = np.frombuffer(starts, "<u4").astype(np.int64), np.frombuffer(ranks, "<u8")
    if not len(s):
        return s, r, r
    on = np.minimum(np.searchsorted(s, s + step), len(s) - 1)
    ok = s[on] == s + step
    return s[ok], r[ok], r[on[ok]]


def _send(by_groups):
    """(group, firsts, seconds) to record batches of PAIRS, distinct pairs with counts."""
    for grp, first, second in by_groups:
        if not len(first):
            continue
        order = np.lexsort((second, first))
        first, second = first[order], second[order]
        new = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
        counts = np.diff(np.append(new, len(first))).astype("<u4")
        first, second = first[new], second[new]
        bucket = (first >> np.uint64(SHIFT)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = np.append(cuts[1:], len(bucket))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts].astype(np.int32)), pa.array(np.full(len(cuts), grp, np.int64)),
             *(pa.array([x[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()) for x in (first, second, counts))],
            names=["bucket", "grp", "first", "second", "counts"])


def _read(column, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype)


def _rank(table: pa.Table) -> pa.Table:
    """One bucket: new ranks of all pairs that occur more than once."""
    first, second, counts = (_read(table.column(c), t) for c, t in (("first", "<u8"), ("second", "<u8"), ("counts", "<u4")))
    grp = np.repeat(table.column("grp").to_numpy(), [len(x) // 8 for x in table.column("first").to_pylist()])
    order = np.lexsort((grp, second, first))
    first, second, counts, grp = first[order], second[order], counts[order].astype(np.int64), grp[order]
    new_class = np.concatenate([[True], first[1:] != first[:-1]])
    new_pair = new_class | np.concatenate([[True], second[1:] != second[:-1]])
    pair = np.cumsum(new_pair) - 1
    at = np.flatnonzero(new_pair)
    total = np.add.reduceat(counts, at)
    before = np.cumsum(total) - total
    base = np.maximum.accumulate(np.where(new_class[at], before, 0))
    rank = first[at] + (before - base).astype(np.uint64)
    keep = np.flatnonzero(total[pair] > 1)
    keep = keep[np.argsort(grp[keep], kind="stable")]
    grp, earlier = grp[keep], (grp > grp[at][pair])[keep].astype(np.uint8)
    first, second, rank = first[keep], second[keep], rank[pair][keep]
    cuts = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]])) if len(grp) else np.empty(0, np.int64)
    ends = np.append(cuts[1:], len(grp)) if len(grp) else cuts
    return pa.table([pa.array(grp[cuts])] + [pa.array([x[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())
                                             for x in (first, second, rank, earlier)],
                    names=["grp", "first", "second", "ranks", "earlier"])


def _ranked(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("bucket").applyInArrow(_rank, ANSWER)


class Answers:
    """A group's new ranks by pair."""

    def __init__(self, table: pa.Table):
        self.first, self.second, self.ranks = (_read(table.column(c), "<u8") for c in ("first", "second", "ranks"))
        self.earlier = _read(table.column("earlier"), "u1").astype(bool)
        self.keys = mix(self.first * MULTIPLIER + self.second)
        self.order = np.argsort(self.keys, kind="stable")

    def look_up(self, first: np.ndarray, second: np.ndarray):
        """Which pairs are unsettled; rank and `earlier` of those."""
        if not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
        keys = mix(first * MULTIPLIER + second)
        at = self.order[np.minimum(np.searchsorted(self.keys[self.order], keys), len(self.keys) - 1)]
        hit = np.flatnonzero((self.first[at] == first) & (self.second[at] == second))
        return hit, self.ranks[at[hit]], self.earlier[at[hit]]


def _state(rows) -> pa.Table:
    types = [pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)],
                    names=["grp", "at", "longest", "runs", "starts", "ranks"])


def _refined(grp: int, docs: list, answers: Answers, length: int, decide: bool):
    """State rows after a level.  docs: (at, longest, runs, lines, places,
    firsts, seconds) in document order."""
    sizes = [len(d[5]) for d in docs]
    first = np.concatenate([d[5] for d in docs]) if docs else np.empty(0, np.uint64)
    second = np.concatenate([d[6] for d in docs]) if docs else np.empty(0, np.uint64)
    hit, ranks, earlier = answers.look_up(first, second)
    least, _ = extremes(ranks, np.arange(len(ranks)))  # places rise along the rows
    earlier = earlier | (least < np.arange(len(ranks)))
    cuts = np.searchsorted(hit, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    for k, (at, longest, removed, lines, places, *_) in enumerate(docs):
        a, b = cuts[k], cuts[k + 1]
        starts = places[hit[a:b] - offsets[k]]
        if decide:
            removed = runs(covered(starts[earlier[a:b]], length, lines)).astype("<u4").tobytes()
        yield (grp, at, length if b > a else longest, removed, starts.astype("<u4").tobytes(), ranks[a:b].astype("<u8").tobytes())


def _in_order(texts: pa.Table) -> list[int]:
    """Row numbers of a group's documents in an order that no shuffle changes."""
    ids, text = texts.column("doc_id").to_pylist(), texts.column("text").to_pylist()
    return sorted(range(len(ids)), key=lambda i: (ids[i], text[i]))


def _first_keys(docs: DataFrame, plan: Deal) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield from _send((g, *first_pairs(np.concatenate([line_ids(t)[2] for t in rows.column(1).to_pylist()]), plan.buckets))
                             for g, rows in by_group(batch))

    return docs.select("grp", "text").mapInArrow(run, PAIRS)


def _first_level(docs: DataFrame, answers: DataFrame, plan: Deal, min_lines: int) -> DataFrame:
    def run(key, texts: pa.Table, answer: pa.Table) -> pa.Table:
        text, rows = texts.column("text").to_pylist(), []
        for at, i in enumerate(_in_order(texts)):
            ids = line_ids(text[i])[2]
            rows.append((at, 0, b"", len(ids), np.arange(len(ids)), *first_pairs(ids, plan.buckets)))
        return _state(list(_refined(key[0].as_py(), rows, Answers(answer), 1, min_lines == 1)))

    return docs.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(run, STATE)


def _next_keys(state: DataFrame, step: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for g, rows in by_group(batch):
                made = [next_pairs(s, r, step) for s, r in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist())]
                yield from _send([(g, np.concatenate([m[1] for m in made]), np.concatenate([m[2] for m in made]))])

    return state.select("grp", "starts", "ranks").filter(F.octet_length("starts") > 0).mapInArrow(run, PAIRS)


def _next_level(state: DataFrame, answers: DataFrame, length: int, step: int, decide: bool) -> DataFrame:
    def run(key, table: pa.Table, answer: pa.Table) -> pa.Table:
        rows = []
        for _, at, longest, removed, starts, ranks in sorted(zip(*(c.to_pylist() for c in table.columns)), key=lambda r: r[1]):
            places, first, second = next_pairs(starts, ranks, step)
            last = int(places[-1]) + length if len(places) else 0
            rows.append((at, longest, removed, last, places, first, second))
        return _state(list(_refined(key[0].as_py(), rows, Answers(answer), length, decide)))

    return state.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(run, STATE)


def _without(docs: DataFrame, state: DataFrame, rest: T.StructType) -> DataFrame:
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_lines", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("longest_repeat", T.LongType()),
                        T.StructField("kept_text", T.StringType()),
                        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("rest", rest)])

    def run(key, texts: pa.Table, table: pa.Table) -> pa.Table:
        order = _in_order(texts)
        known = {a: (n, r) for a, n, r in zip(*(table.column(c).to_pylist() for c in ("at", "longest", "runs")))}
        ids, text, rows = texts.column("doc_id").to_pylist(), texts.column("text").to_pylist(), []
        for at, i in enumerate(order):
            lines, full, _ = line_ids(text[i])
            gone = np.zeros(len(lines), bool)
            spans = np.frombuffer(known[at][1], "<u4").reshape(-1, 2).tolist()
            for a, b in spans:
                gone[full[a:b]] = True
            spans = [[int(full[a]), int(full[b - 1]) + 1] for a, b in spans]
            rows.append((ids[i], len(full), int(gone.sum()), known[at][0], "\n".join(x for x, g in zip(lines, gone) if not g), spans))
        types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.list_(pa.int32()))]
        cols = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)]
        return pa.table(cols + [texts.column("rest").take(pa.array(order, pa.int64()))],
                        names=["doc_id", "n_lines", "n_removed", "longest_repeat", "kept_text", "spans", "rest"])

    return docs.groupBy("grp").cogroup(state.groupBy("grp")).applyInArrow(run, out)


def deduplicate(docs: DataFrame, min_lines: int = 1) -> DataFrame:
    """Per document row: doc_id, n_lines (blank ones apart), n_removed,
    longest_repeat (a level: lines of the longest doubled run that it shares),
    kept_text, spans (numbers of the first line and of the one behind the last of
    each deleted stretch, blank lines inside it counted), and `rest`, a struct of
    the row's other columns."""
    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.struct(F.lit(0).alias("none"))
    whole = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), rest.alias("rest"))
    plan = deal(id_and_text(docs), keys_per_byte=0.01, bucket_keys=250_000)
    whole = plan.dealt(whole).select("grp", "text", "doc_id", "rest")
    texts = whole.select("grp", "text", "doc_id")
    answers, answers_path = store(_ranked(_first_keys(texts, plan)), "lines")
    state, path = store(_first_level(texts, answers, plan, min_lines), "ranks")
    drop_stored(spark, answers_path)
    length = 1
    while state.agg(F.sum(F.octet_length("starts"))).first()[0]:
        longer = min(2 * length, min_lines) if length < min_lines else 2 * length
        answers = _ranked(_next_keys(state, longer - length))
        following, new = store(_next_level(state, answers, longer, longer - length, longer == min_lines), "ranks")
        drop_stored(spark, path)
        state, path, length = following, new, longer
    return with_null_ids(_without(whole, state, whole.schema["rest"].dataType))


def clean(docs: DataFrame, min_lines: int = 1) -> DataFrame:
    """`docs` with the repeated runs deleted from `text`; `n_chars`, if there
    is such a column, is set to the new length.  All rows and columns stay."""
    out = deduplicate(docs, min_lines)
    value = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        value["n_chars"] = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(value.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))
