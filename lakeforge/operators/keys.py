"""Surrogate keys (S10, S11) and key checks.

``assign_keys`` gives the rows of a frame the dense numbers
``start + ROW_NUMBER() OVER (ORDER BY order_by)``, by one algorithm at every
size: rows are dealt into contiguous key ranges (Spark's range partitioning),
sorted, and stored once together with the number of their range and their
place in it, so that numbers do not depend on how a later job partitions them;
rows are counted per range and the counts summed up over the ranges before (one
row per range).  The bounds of the ranges hold the columns of ``order_by``
only, so these should be few and short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

RANGE, PLACE, AGAIN = "_lf_range", "_lf_place", "_lf_again"


def _ascending(order_by: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order_by]


def store_ranges(df: DataFrame, order_by: list[str], repeated: Column | None = None, marked: bool = False, dealt: bool = False) -> DataFrame:
    """``df`` stored in contiguous ranges of ``order_by`` (NULLs first), with
    the number of each row's range as column ``RANGE`` and its place in the
    sorted range, from 0, as ``PLACE``.  ``repeated`` is evaluated for each row
    that equals the one before it in ``order_by`` (to raise an error, or true to
    keep the row): equal rows are neighbours, so this needs no shuffle of its own.
    ``marked`` keeps these rows and tells them by column ``AGAIN``.  A ``dealt``
    frame lies in ranges of the first columns of ``order_by`` already and has no
    such rows, so it is sorted without a shuffle."""
    nth = F.row_number().over(Window.partitionBy(*order_by).orderBy(order_by[-1]))
    if not dealt:
        df = df.repartitionByRange(*_ascending(order_by))
        if repeated is not None:
            df = df.withColumn("_lf_nth", nth).filter(F.when(F.col("_lf_nth") > 1, repeated).otherwise(F.lit(True))).drop("_lf_nth")
    if marked:
        df = df.withColumn(AGAIN, F.lit(False) if dealt else nth > 1)
    dealt = df.sortWithinPartitions(*_ascending(order_by))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))  # the lower bits count the rows of a task
    return cut_lineage(dealt.withColumns({RANGE: F.spark_partition_id(), PLACE: place}))


def range_offsets(ranged: DataFrame) -> DataFrame:
    """For each range of a frame from ``store_ranges``, the rows in those before:
    as many rows as the shuffle had partitions."""
    return (ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_lf_n"))
            .select(RANGE, (F.sum("_lf_n").over(Window.orderBy(RANGE)) - F.col("_lf_n")).alias("_lf_off")))


def number_ranges(ranged: DataFrame, key_col: str, start: int | Column = 0, offsets: DataFrame | None = None) -> DataFrame:
    """Number the rows of a frame from ``store_ranges``; ``RANGE`` stays as a
    column.  ``offsets``: its ``range_offsets``, if they are stored."""
    offsets = range_offsets(ranged) if offsets is None else offsets
    first = start if isinstance(start, Column) else F.lit(start)
    return (ranged.join(F.broadcast(offsets), RANGE)
            .withColumn(key_col, (first + F.col("_lf_off") + F.col(PLACE) + 1).cast("long")).drop("_lf_off", PLACE))


def assign_keys(df: DataFrame, order_by: list[str], key_col: str, start: int | Column = 0, repeated: Column | None = None) -> DataFrame:
    """Add ``key_col = start + row_number() over (order by order_by)`` as BIGINT.

    ``start`` may be a scalar-subquery Column (e.g. the current max id), so
    it is evaluated inside the plan.  ``order_by`` should be unique over ``df``
    for the numbers to be deterministic (ties are numbered in an unspecified
    order, as in SQL); ``repeated``: see ``store_ranges``."""
    return number_ranges(store_ranges(df, order_by, repeated), key_col, start).drop(RANGE)


#: Rows of a group that one task may sort.
HOT_GROUP = 1_000_000


def number_within_groups(df: DataFrame, group_by: list[str], order_by: list[str], out_col: str, hot: int = HOT_GROUP) -> DataFrame:
    """``row_number() over (partition by group_by order by order_by)`` that
    never gathers a group of more than ``hot`` rows into one task.

    Groups are counted first (partial counts per task).  The others are numbered
    by a window, in one shuffle; the hot ones, of which there are at most rows /
    ``hot``, by ranges.  With ``hot`` 0 all rows are numbered by ranges."""
    if not hot:
        return _number_by_ranges(df, group_by, order_by, out_col)
    return number_and_deal(df, group_by, order_by, out_col, hot)[0]


def number_and_deal(df: DataFrame, group_by: list[str], order_by: list[str], out_col: str, hot: int = HOT_GROUP) -> tuple[DataFrame, bool]:
    """As ``number_within_groups``, and whether the rows lie in contiguous
    ranges of ``group_by`` (NULLs first): they do unless there are hot groups,
    since the one shuffle is by ranges."""
    names = [f"_lf_hot_{c}" for c in group_by]
    large = cut_lineage(df.groupBy(*group_by).agg(F.count(F.lit(1)).alias("_lf_n")).filter(F.col("_lf_n") > hot)
                        .select(*[F.col(c).alias(n) for c, n in zip(group_by, names)]))
    parts = [df]
    if not large.isEmpty():
        same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(group_by, names)]
        parts = [df.join(F.broadcast(large), same, how) for how in ("left_anti", "left_semi")]  # at most rows / hot groups
    w = Window.partitionBy(*group_by).orderBy(*_ascending(order_by))
    out = parts[0].repartitionByRange(*_ascending(group_by)).withColumn(out_col, F.row_number().over(w))
    if len(parts) == 1:
        return out, True
    return out.unionByName(_number_by_ranges(parts[1], group_by, order_by, out_col)), False


def _number_by_ranges(df: DataFrame, group_by: list[str], order_by: list[str], out_col: str) -> DataFrame:
    """Row numbers inside groups that may be of any size.

    Rows are numbered globally over (group, order), so a hot group spreads
    over several ranges.  A row's number in its group is ``global -
    start_of_group + 1``; the start is the smallest global number of the group
    inside the row's range, corrected for the groups that span ranges.  Only
    the first and last group of a range can span ranges, so the correction has
    at most two rows per range."""
    order = list(group_by) + list(order_by)
    numbered = number_ranges(store_ranges(df, order), "_lf_gid")
    x = numbered.withColumn("_lf_lstart", F.min("_lf_gid").over(Window.partitionBy(RANGE, *group_by)))
    edge = F.struct(*[F.col(c) for c in group_by], F.col("_lf_lstart").alias("_lf_lstart"))
    ends = (x.groupBy(RANGE).agg(F.min(edge).alias("a"), F.max(edge).alias("b"))
            .select(F.explode(F.array("a", "b")).alias("e")).select("e.*")
            .groupBy(*group_by).agg(F.min("_lf_lstart").alias("_lf_gstart")))
    ends = ends.select(*[F.col(c).alias(f"_lf_e_{c}") for c in group_by], "_lf_gstart")
    cond = [x[c].eqNullSafe(ends[f"_lf_e_{c}"]) for c in group_by]
    j = x.join(F.broadcast(ends), cond, "left")  # at most two rows per range
    start = F.coalesce(F.col("_lf_gstart"), F.col("_lf_lstart"))
    return (j.withColumn(out_col, (F.col("_lf_gid") - start + 1).cast("int"))
            .drop("_lf_gid", RANGE, "_lf_lstart", "_lf_gstart", *[f"_lf_e_{c}" for c in group_by]))


def max_key_col(df: DataFrame, key_col: str) -> Column:
    """Scalar subquery: largest identity value ``>= 1`` (seeds such as -9 do
    not count), 0 if none.  Evaluated inside the consuming plan."""
    return df.agg(F.coalesce(F.max(F.when(F.col(key_col) >= 1, F.col(key_col))),
                             F.lit(0)).cast("long")).scalar()


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (S12 primary key check); expect 0 rows."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: NULL count per column (S12 NOT NULL check)."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"null_{c}") for c in columns])


def check_foreign_key(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose ``key`` resolves in no dimension row (S12 FK check)."""
    return fact.join(dim.select(F.col(dim_key).alias(key)), key, "left_anti")
