"""Surrogate key assigner: equals a global row_number, with NULLs first and
composite keys, hot leading keys and wide rows, over many ranges."""

import random
import time

from pyspark.sql import functions as F

from lakeforge.operators.keys import RANGE, assign_keys, check_unique, max_key_col, number_ranges, store_ranges


def _expected(rows, start):
    key = lambda r: tuple((v is not None, v) for v in r)
    return {r: start + i + 1 for i, r in enumerate(sorted(rows, key=key))}


def test_few_rows(spark):
    rows = [(3, "b"), (1, "z"), (2, "a"), (None, "q")]
    df = spark.createDataFrame(rows, "a int, b string")
    got = {(r.a, r.b): r.id for r in assign_keys(df, ["a", "b"], "id", 10).collect()}
    assert got == _expected(rows, 10)


def test_matches_row_number(spark):
    rnd = random.Random(1)
    rows = list({(rnd.choice([None, *range(30)]), rnd.randint(0, 500)) for _ in range(900)})
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    out = assign_keys(df, ["a", "b"], "id", 100)
    got = {(r.a, r.b): r.id for r in out.collect()}
    assert got == _expected(rows, 100)


def test_hot_leading_key(spark):
    # one leading key holds most rows: ranges split it on the second column
    rows = [(1, i) for i in range(600)] + [(k, 0) for k in range(2, 50)]
    df = spark.createDataFrame(rows, "a int, b int")
    out = assign_keys(df, ["a", "b"], "id", 0)
    assert {(r.a, r.b): r.id for r in out.collect()} == _expected(rows, 0)


def test_scalar_start_and_checks(spark):
    t = spark.createDataFrame([(-9,), (4,), (7,)], "id long")
    assert t.select(max_key_col(t, "id").alias("m")).first().m == 7
    assert check_unique(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]).count() == 1


def _rn(rows):
    out, seen = {}, {}
    key = lambda r: tuple((v is not None, v) for v in r)
    for r in sorted(rows, key=key):
        seen[r[0]] = seen.get(r[0], 0) + 1
        out[r] = seen[r[0]]
    return out


def test_number_within_groups_hot_group_spans_ranges(spark):
    from lakeforge.operators.keys import number_within_groups
    rows = [(7, i) for i in range(400)] + [(g, i) for g in range(1, 40) for i in range(3)] + \
           [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "g int, o int").repartition(5)
    out = number_within_groups(df, ["g"], ["o"], "rn")
    got = {(r.g, r.o): r.rn for r in out.collect()}
    assert got == _rn(rows)


def test_wide_rows_over_many_ranges(spark):
    """22 columns, a hot leading key and NULL keys over 64 ranges, in seconds."""
    wide = spark.range(20_000).select(
        F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        *[F.concat(F.lit(f"c{i}-"), (F.col("id") * (i + 3) % 9973).cast("string")).alias(f"c{i}") for i in range(20)], "id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    began = time.time()
    try:
        ranged = store_ranges(wide, wide.columns)
        out = number_ranges(ranged, "n", 5)
        assert ranged.select(RANGE).distinct().count() > 32
        rows = out.select("n", *wide.columns).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert time.time() - began < 60
    assert {tuple(r[1:]): r[0] for r in rows} == _expected([tuple(r[1:]) for r in rows], 5)
