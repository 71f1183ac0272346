"""Merges: SCD type 2 history load (M1–M3) and SCD type 1 upsert (M4, M5).

Both merges evaluate target and source once, in one full outer join with one
shuffle of each side.  If the target is stored in buckets (see
:mod:`lakeforge.sources.buckets`) it is not shuffled: the sides meet on a 64-bit
hash of the natural key and the keys themselves are compared as well; else they
meet on the key.  A row with a NULL key gets a hash of its own: it matches
nothing, and such rows spread over all tasks (active target rows are closed,
source rows opened, G4).  The source's rows are checked for a key that occurs
twice (G20) where the join's shuffle, or in a first load the ranges of the key,
have brought them together.

An SCD2 load joins the *active* target rows only; closed history is passed
through untouched.  Each joined row emits one or two rows through a small
action array:

=====================  =========================
joined row             emitted
=====================  =========================
both, unchanged        target row as is
both, changed          target row closed + new source version
target only            target row closed
source only            new source version
=====================  =========================

The merged rows are stored once.  Those without an id yet, and only those, are
dealt into ranges of (natural key, digest) and get ``max(id) + row_number()``
from :func:`assign_keys`; the digest of all data columns orders rows with a
NULL key and is 0 for the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..contracts import CREATE_DATE, HEX_TEXT, ID, UPDATE_DATE, VALID_FROM, VALID_TO
from ..functions.dates import ts_lit
from ..functions.predicates import any_changed_sql, any_null, q
from ..session import cut_lineage
from .keys import AGAIN, PLACE, RANGE, assign_keys, max_key_col, number_ranges, range_offsets, store_ranges

_S = "_lf_s_"
#: Hash that target and source meet on, whether a merged row differs from the
#: stored one, and the order of rows with a NULL key.
HASH, CHANGED, DIGEST = "_lf_h", "_lf_changed", "_lf_digest"
#: Takes the place of ``HASH`` where no side is stored in buckets: 0, or a hash
#: of its own for a row with a NULL in its key.  Eight bytes that do not compress
#: stay out of both shuffles.
LOOSE = "_lf_loose"


def _ts_sql(load_date) -> str:
    """SQL literal of a load time (TIMESTAMP_NTZ)."""
    return f"TIMESTAMP_NTZ '{load_date}'"


def history_columns(source_columns: list[str], id_col: str = ID) -> list[str]:
    return [id_col, *source_columns, VALID_FROM, VALID_TO, CREATE_DATE, UPDATE_DATE]


def empty_history(source: DataFrame, id_col: str = ID) -> DataFrame:
    """Typed empty Silver table for ``source`` columns."""
    ntz = "timestamp_ntz"
    return source.limit(0).select(
        F.lit(None).cast("long").alias(id_col), *source.columns,
        F.lit(None).cast(ntz).alias(VALID_FROM), F.lit(None).cast(ntz).alias(VALID_TO),
        F.lit(None).cast(ntz).alias(CREATE_DATE), F.lit(None).cast(ntz).alias(UPDATE_DATE))


def merge_hash(df: DataFrame, keys: list[str], id_col: str | None = None) -> str:
    """SQL text of ``HASH``: of the key (integers of any width as BIGINT), or of
    its own for a row with a NULL in its key: that of its id, if it has one."""
    null = " OR ".join(f"{q(k)} IS NULL" for k in keys)
    values = [f"CAST({q(k)} AS BIGINT)" if isinstance(df.schema[k].dataType, IntegralType) else q(k) for k in keys]
    own = f"'id', {q(id_col)}" if id_col in df.columns else "monotonically_increasing_id()"
    return f"CASE WHEN {null} THEN xxhash64({own}) ELSE xxhash64({', '.join(values)}) END"


def loose_rows(keys: list[str]) -> str:
    """SQL text of ``LOOSE``."""
    null = " OR ".join(f"{q(k)} IS NULL" for k in keys)
    return f"CASE WHEN {null} THEN xxhash64(monotonically_increasing_id()) ELSE 0L END"


def packed(df: DataFrame) -> DataFrame:
    """``df`` with hexadecimal text as bytes: a first byte 1 and what the digits
    stand for, or, if the text is no pairs of lower-case digits, a first byte 0
    and the text.  Equal bytes are equal texts."""
    def sql(c):
        return f"CASE WHEN lower(hex(unhex({c}))) = {c} THEN concat(X'01', unhex({c})) ELSE concat(X'00', CAST({c} AS BINARY)) END"
    text = [c for c, t in df.dtypes if c in HEX_TEXT and t == "string"]
    return df.withColumns({c: F.expr(sql(q(c))) for c in text}) if text else df


def unpacked(column: str) -> str:
    """SQL text of the text that ``packed`` made bytes of."""
    return f"CASE WHEN substring({column}, 1, 1) = X'01' THEN lower(hex(substring({column}, 2))) ELSE CAST(substring({column}, 2) AS STRING) END"


def order_digest(keys: list[str], data_cols: list[str]) -> str:
    """SQL text of ``DIGEST``: 60 bits of the MD5 of all data columns if the
    key holds a NULL, else 0."""
    null = " OR ".join(f"{q(k)} IS NULL" for k in keys)
    text = ", ".join(f"coalesce(CAST({q(c)} AS STRING), '-')" for c in data_cols)
    return f"CASE WHEN {null} THEN CAST(conv(substring(md5(concat_ws('|', {text})), 1, 15), 16, 10) AS BIGINT) ELSE 0L END"


def _several_rows(keys: list[str]) -> Column:
    return F.raise_error(F.lit(f"merge source has several rows for one key ({', '.join(keys)})"))


def once_per_key(source: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """``source`` that fails the job if a non-NULL key occurs twice (merge
    cardinality rule, G20).  Equal keys are neighbours after the shuffle on
    ``by`` that the merge needs anyway."""
    w = Window.partitionBy(*by).orderBy(*keys)
    before = [f"_lf_before_{i}" for i in range(len(keys))]
    same = " AND ".join(f"{q(k)} = {q(b)}" for k, b in zip(keys, before))
    return (source.withColumns({b: F.lag(k).over(w) for k, b in zip(keys, before)})
            .filter(F.when(F.expr(same), _several_rows(keys)).otherwise(F.lit(True))).drop(*before))


def _paired(target: DataFrame, source: DataFrame, keys: list[str], data_cols: list[str], buckets: int | None) -> DataFrame:
    """Target rows and source rows (columns prefixed ``_S``) by key, unmatched
    ones of both sides included; ``_lf_tp`` / ``_lf_sp`` tell which are there.
    With ``buckets``, the target is stored in so many buckets of ``HASH`` and the
    source is dealt likewise; without, both sides are dealt by the key."""
    for k in keys:
        types = [df.schema[k].dataType for df in (target, source)]
        if types[0] != types[1] and not all(isinstance(t, IntegralType) for t in types):
            raise TypeError(f"merge key {k} is {types[0]} in the target and {types[1]} in the source")
    if buckets:
        s = source.selectExpr(*map(q, data_cols), f"{merge_hash(source, keys)} AS {HASH}")
        s, met = once_per_key(s.repartition(buckets, HASH), keys, [HASH]), HASH
        t = target if HASH in target.columns else target.selectExpr("*", f"{merge_hash(target, keys)} AS {HASH}")
        # Two inequalities, so that the join is partitioned by the hash alone.
        same = [(F.col(k) <= F.col(_S + k)) & (F.col(k) >= F.col(_S + k)) for k in keys]
    else:
        source, target = packed(source), packed(target)
        s = source.selectExpr(*map(q, data_cols), f"{loose_rows(keys)} AS {LOOSE}")
        s, met = once_per_key(s, keys, [LOOSE, *keys]), LOOSE
        t = target.selectExpr("*", f"{loose_rows(keys)} AS {LOOSE}")
        same = [F.col(k) == F.col(_S + k) for k in keys]
    s = s.selectExpr(*[f"{q(c)} AS {q(_S + c)}" for c in [*data_cols, met]], "true AS _lf_sp")
    j = t.withColumn("_lf_tp", F.lit(True)).join(s, [F.col(met) == F.col(_S + met), *same], "full_outer")
    types = dict(j.dtypes)
    both = [c for c in data_cols if not buckets and c in HEX_TEXT and types[c] == "binary"]
    return j.withColumns({name: F.expr(unpacked(q(name))) for c in both for name in (c, _S + c)}) if both else j


def _bucket_columns(changed: str, buckets: int | None) -> list[str]:
    """What a bucketed table needs of a merged row."""
    return [f"coalesce({HASH}, {q(_S + HASH)}) AS {HASH}", f"{changed} AS {CHANGED}"] if buckets else []


def number_new(merged: DataFrame, keys: list[str], data_cols: list[str], id_col: str, start, first: bool = False) -> DataFrame:
    """The rows of ``merged`` without an id, numbered after ``start`` in the
    order of their key.  They are stored once; the numbers are added as they are
    read.  In a ``first`` load they come straight from the source, so a non-NULL
    key that occurs twice fails the job here (G20)."""
    new = merged.filter(F.col(id_col).isNull()).drop(id_col).selectExpr("*", f"{order_digest(keys, data_cols)} AS {DIGEST}")
    again = F.when(any_null(keys), F.lit(True)).otherwise(_several_rows(keys)) if first else None
    small = packed(new)
    out = assign_keys(small, [*keys, DIGEST], id_col, start, again).drop(DIGEST)
    return out.withColumns({c: F.expr(unpacked(q(c))) for c, t in small.dtypes if t != new.schema[c].dataType.simpleString()})


def number_first(source: DataFrame, keys: list[str], id_col: str, start) -> DataFrame:
    """The source of a first load, numbered like ``number_new``.  Only its own
    columns are dealt and stored; load times and ``HASH``, which follow from
    them, are added as the numbers are read."""
    cols = list(source.columns)
    return number_new(source.selectExpr(f"CAST(NULL AS BIGINT) AS {q(id_col)}", *map(q, cols)), keys, cols, id_col, start, first=True)


def _id_of(source: DataFrame, id_col: str) -> str:
    """The id of a numbered source, else NULL."""
    return q(id_col) if id_col in source.columns else f"CAST(NULL AS BIGINT) AS {q(id_col)}"


def store_by_key(source: DataFrame, keys: list[str], dealt: bool = False) -> DataFrame:
    """``source`` stored in the ranges of its key that a first load numbers, so
    that the load needs neither a shuffle nor a copy of it (``scd2_first``).
    Keys that occur twice are marked; they fail the load, not this.  ``dealt``:
    see ``store_ranges``."""
    rows = source.selectExpr("*", f"{order_digest(keys, source.columns)} AS {DIGEST}")
    return store_ranges(packed(rows), [*keys, DIGEST], marked=True, dealt=dealt).drop(DIGEST)


def by_key(ranged: DataFrame) -> DataFrame:
    """A frame from ``store_by_key`` with hexadecimal text as text."""
    return ranged.withColumns({c: F.expr(unpacked(q(c))) for c, t in ranged.dtypes if c in HEX_TEXT and t == "binary"})


def scd2_first(ranged: DataFrame, keys: list[str], load_date, id_col: str = ID) -> DataFrame:
    """A first load of a source that ``store_by_key`` has stored: every row is
    opened and numbered in the order of its key as it is read.  A non-NULL key
    that occurs twice fails the load (G20)."""
    again = F.when(F.col(AGAIN) & ~any_null(keys), _several_rows(keys)).otherwise(F.lit(False))
    ranged.filter(again).isEmpty()
    data_cols, tl = [c for c in ranged.columns if c not in (RANGE, PLACE, AGAIN)], _ts_sql(load_date)
    numbered = number_ranges(ranged.drop(AGAIN), id_col, 0, cut_lineage(range_offsets(ranged)))
    return numbered.selectExpr(q(id_col), *map(q, data_cols), f"{tl} AS {VALID_FROM}", f"CAST(NULL AS TIMESTAMP_NTZ) AS {VALID_TO}",
                               f"{tl} AS {CREATE_DATE}", f"{tl} AS {UPDATE_DATE}")


def scd2_opened(source: DataFrame, keys: list[str], load_date, id_col: str = ID) -> DataFrame:
    """Every source row as a new version: the transitions of a first load.  Ids
    are those of ``number_first``, or NULL."""
    tl, cols = _ts_sql(load_date), [c for c in source.columns if c != id_col]
    s = source.selectExpr("*", f"{merge_hash(source, keys, id_col)} AS {HASH}")
    return s.selectExpr(
        _id_of(source, id_col), *map(q, cols), f"{tl} AS {VALID_FROM}", f"CAST(NULL AS TIMESTAMP_NTZ) AS {VALID_TO}",
        f"{tl} AS {CREATE_DATE}", f"{tl} AS {UPDATE_DATE}", HASH, f"true AS {CHANGED}")


def scd2_transitions(target: DataFrame, source: DataFrame, keys: list[str], tracked: list[str],
                     load_date, null_safe: bool = False, id_col: str = ID,
                     include_open: bool = True, buckets: int | None = None) -> DataFrame:
    """The merged *active* part after a load, before ids of new versions are
    assigned (their ``id_col`` is NULL); with ``buckets``, also ``HASH`` and
    ``CHANGED``.  Closed history is not included."""
    tl = _ts_sql(load_date)
    data_cols = list(source.columns)
    j = _paired(target.filter(F.col(VALID_TO).isNull()), source, keys, data_cols, buckets)
    changed = any_changed_sql([(c, _S + c) for c in tracked], null_safe)
    close_open = "array('close', 'open')" if include_open else "array('close')"
    only_s = "array('open')" if include_open else "array()"
    actions = (f"CASE WHEN _lf_tp AND _lf_sp AND {changed} THEN {close_open} "
               f"WHEN _lf_tp AND _lf_sp THEN array('keep') WHEN _lf_tp THEN array('close') "
               f"ELSE CAST({only_s} AS array<string>) END")
    x = j.selectExpr("*", f"explode({actions}) AS _lf_act")
    is_open, is_close = "_lf_act = 'open'", "_lf_act = 'close'"
    return x.selectExpr(
        f"CASE WHEN {is_open} THEN CAST(NULL AS BIGINT) ELSE {q(id_col)} END AS {q(id_col)}",
        *[f"CASE WHEN {is_open} THEN {q(_S + c)} ELSE {q(c)} END AS {q(c)}" for c in data_cols],
        f"CASE WHEN {is_open} THEN {tl} ELSE {VALID_FROM} END AS {VALID_FROM}",
        f"CASE WHEN {is_close} THEN {tl} WHEN {is_open} THEN CAST(NULL AS TIMESTAMP_NTZ) "
        f"ELSE {VALID_TO} END AS {VALID_TO}",
        f"CASE WHEN {is_open} THEN {tl} ELSE {CREATE_DATE} END AS {CREATE_DATE}",
        f"CASE WHEN {is_open} OR {is_close} THEN {tl} ELSE {UPDATE_DATE} END AS {UPDATE_DATE}",
        *_bucket_columns("_lf_act != 'keep'", buckets))


def scd2_load(target: DataFrame | None, source: DataFrame, keys: list[str], tracked: list[str],
              load_date, null_safe: bool = False, id_col: str = ID) -> DataFrame:
    """One SCD2 load (close changed/missing active versions, open new ones)
    in a single pass over the active target.  Without a target every source
    row is opened.  The result reads the stage tables that the load has stored,
    so it need not be stored again."""
    keys, tracked = list(keys), list(tracked)
    data_cols = list(source.columns)
    cols = history_columns(data_cols, id_col)
    if target is None:
        return scd2_opened(number_first(source, keys, id_col, 0), keys, load_date, id_col).select(*cols)
    history = target.filter(F.col(VALID_TO).isNotNull()).select(*cols)
    merged = cut_lineage(scd2_transitions(target, source, keys, tracked, load_date, null_safe, id_col).select(*cols))
    new = number_new(merged, keys, data_cols, id_col, max_key_col(target, id_col))
    return history.unionByName(merged.filter(F.col(id_col).isNotNull()).select(*cols)).unionByName(new.select(*cols))


def scd2_close(target: DataFrame, source: DataFrame, keys: list[str], tracked: list[str],
               load_date, null_safe: bool = False, id_col: str = ID) -> DataFrame:
    """First half of a load (M1): close active versions that changed or whose
    key left the source; nothing is inserted."""
    cols = history_columns(list(source.columns), id_col)
    history = target.filter(F.col(VALID_TO).isNotNull()).select(*cols)
    merged = scd2_transitions(target, source, list(keys), list(tracked), load_date, null_safe,
                              id_col, include_open=False)
    return history.unionByName(merged.select(*cols))


def scd2_open(target: DataFrame, source: DataFrame, keys: list[str], load_date,
              id_col: str = ID) -> DataFrame:
    """Second half of a load (M2): insert a new version for every source row
    without an *active* target row on its key (new keys and keys just closed)."""
    keys = list(keys)
    data_cols = list(source.columns)
    cols = history_columns(data_cols, id_col)
    active_keys = target.filter(F.col(VALID_TO).isNull()).select(*keys)
    fresh = source.join(active_keys, keys, "left_anti").select(*data_cols)  # NULL keys never match: opened
    opened = scd2_opened(fresh, keys, load_date, id_col).select(*cols)
    new = number_new(opened, keys, data_cols, id_col, max_key_col(target, id_col), first=True)
    return target.select(*cols).unionByName(new.select(*cols))


def scd1_merged(target: DataFrame | None, source: DataFrame, keys: list[str], compared: list[str], surrogate: str,
                load_date, null_safe: bool = False, buckets: int | None = None) -> DataFrame:
    """All rows of the target after an SCD1 upsert, before surrogates of new
    rows are assigned (theirs is NULL); with ``buckets``, also ``HASH`` and
    ``CHANGED``.  Without a target all rows are new, and whoever numbers them,
    before (``number_first``) or after, finds keys that occur twice."""
    tl = _ts_sql(load_date)
    data_cols = keys + [c for c in compared if c not in keys]
    if target is None:
        hashed = [f"{merge_hash(source, keys, surrogate)} AS {HASH}", f"true AS {CHANGED}"] if buckets else []
        return source.selectExpr(_id_of(source, surrogate), *map(q, data_cols), f"{tl} AS {CREATE_DATE}",
                                 f"{tl} AS {UPDATE_DATE}", *hashed)
    kept = [surrogate, *data_cols, CREATE_DATE, UPDATE_DATE, *([HASH] if buckets and HASH in target.columns else [])]
    j = _paired(target.select(*kept), source, keys, data_cols, buckets)
    changed = any_changed_sql([(c, _S + c) for c in compared], null_safe)
    take_s = f"(_lf_tp IS NULL OR (_lf_sp IS NOT NULL AND {changed}))"
    return j.selectExpr(
        q(surrogate),
        *[f"CASE WHEN {take_s} THEN {q(_S + c)} ELSE {q(c)} END AS {q(c)}" for c in data_cols],
        f"CASE WHEN _lf_tp IS NULL THEN {tl} ELSE {CREATE_DATE} END AS {CREATE_DATE}",
        f"CASE WHEN {take_s} THEN {tl} ELSE {UPDATE_DATE} END AS {UPDATE_DATE}",
        *_bucket_columns(take_s, buckets))


def scd1_upsert(target: DataFrame | None, source: DataFrame, key, compared: list[str],
                surrogate: str, load_date, null_safe: bool = False,
                start: int | Column | None = None) -> DataFrame:
    """SCD type 1 upsert (M4/M5): matched and any compared column differs →
    source attributes, target surrogate and create date, ``update = load``;
    matched and equal, or target only → target row unchanged (rows are never
    deleted, G8); source only → new surrogate, ``create = update = load``.

    ``key`` may be a list of columns (fact grain).  NULL keys never match.
    Without a target every source row is new.
    ``start`` is the largest surrogate in use when the caller knows it (e.g.
    from a commit log); otherwise it is a scalar subquery over the target.
    """
    keys = [key] if isinstance(key, str) else list(key)
    data_cols = keys + [c for c in compared if c not in keys]
    out_cols = [surrogate, *data_cols, CREATE_DATE, UPDATE_DATE]
    merged = scd1_merged(target, source, keys, compared, surrogate, load_date, null_safe)
    if target is None:
        return number_new(merged, keys, data_cols, surrogate, start or 0, first=True).select(*out_cols)
    merged = cut_lineage(merged)
    first = max_key_col(target, surrogate) if start is None else start
    new = number_new(merged, keys, data_cols, surrogate, first)
    return merged.filter(F.col(surrogate).isNotNull()).select(*out_cols).unionByName(new.select(*out_cols))


def as_of(history: DataFrame, at) -> DataFrame:
    """Point-in-time read (S17): versions valid at ``at`` (half-open
    ``[valid_from, valid_to)`` intervals)."""
    t = ts_lit(at)
    return history.filter((F.col(VALID_FROM) <= t) & (F.col(VALID_TO).isNull() | (t < F.col(VALID_TO))))
