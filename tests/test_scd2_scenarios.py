"""Scenario tier: the warehouse's manual SCD2 scenarios as assertions."""

import datetime as dt

import pytest

from lakeforge.operators.checks import duplicate_current, overlapping_intervals
from lakeforge.operators.merge import (as_of, empty_history, scd2_close, scd2_load, scd2_open)

T1, T2, T3 = "2024-01-01 06:00:00", "2024-01-02 06:00:00", "2024-01-03 06:00:00"
SCHEMA = "k int, city string, code string"
KEYS, TRACKED = ["k"], ["city", "code"]


def ts(s):
    return dt.datetime.fromisoformat(s)


def load(spark, target, rows, t, **kw):
    src = spark.createDataFrame(rows, SCHEMA)
    tgt = empty_history(src) if target is None else target
    return scd2_load(tgt, src, KEYS, TRACKED, t, **kw).cache()


def by_key(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["k"], []).append(r.asDict())
    for v in out.values():
        v.sort(key=lambda r: r["_tf_valid_from"])
    return out


DAY1 = [(1, "Paris", "75001"), (2, "Lyon", "69001"), (3, "Nice", None), (4, "Brest", "29200")]


def test_initial_load_ids_and_dates(spark):
    h = by_key(load(spark, None, DAY1, T1))
    assert [h[k][0]["_tf_id"] for k in (1, 2, 3, 4)] == [1, 2, 3, 4]
    for k in h:
        r = h[k][0]
        assert r["_tf_valid_from"] == ts(T1) and r["_tf_valid_to"] is None
        assert r["_tf_create_date"] == r["_tf_update_date"] == ts(T1)


def test_update_delete_rekey_and_insert(spark):
    h1 = load(spark, None, DAY1, T1)
    day2 = [(1, "Paris", "12345"),    # update (as the postal-code scenario)
            (3, "Nice", None),        # unchanged
            (40, "Brest", "29200"),   # re-key 4 -> 40
            (5, "Metz", "57000")]     # new; key 2 deleted
    h = by_key(load(spark, h1, day2, T2))
    old, new = h[1]
    assert old["_tf_valid_to"] == ts(T2) and old["_tf_update_date"] == ts(T2)
    assert new["_tf_valid_from"] == ts(T2) and new["_tf_valid_to"] is None and new["code"] == "12345"
    assert old["_tf_valid_to"] == new["_tf_valid_from"]  # G2: half-open intervals touch
    assert h[2][0]["_tf_valid_to"] == ts(T2)             # deleted key closed
    assert len(h[3]) == 1 and h[3][0]["_tf_valid_to"] is None
    assert h[4][0]["_tf_valid_to"] == ts(T2) and h[40][0]["_tf_valid_to"] is None
    # new ids continue after the max, in key order: 1 (new version), 5, 40
    assert (new["_tf_id"], h[5][0]["_tf_id"], h[40][0]["_tf_id"]) == (5, 6, 7)


def test_noop_rerun_changes_nothing(spark):
    h1 = load(spark, None, DAY1, T1)
    h2 = load(spark, h1, DAY1, T2)
    assert sorted(map(tuple, h1.collect())) == sorted(map(tuple, h2.collect()))


def test_return_after_delete_opens_new_version(spark):
    h1 = load(spark, None, DAY1, T1)
    h2 = load(spark, h1, [r for r in DAY1 if r[0] != 2], T2)
    h3 = by_key(load(spark, h2, DAY1, T3))
    assert [r["_tf_valid_to"] for r in h3[2]] == [ts(T2), None]   # G5: a gap is legal
    assert h3[2][1]["_tf_valid_from"] == ts(T3)


def test_null_blind_change_is_not_detected(spark):
    h1 = load(spark, None, DAY1, T1)
    filled = [(3, "Nice", "06000") if r[0] == 3 else r for r in DAY1]
    blind = by_key(load(spark, h1, filled, T2))
    assert len(blind[3]) == 1 and blind[3][0]["code"] is None    # G1
    safe = by_key(load(spark, h1, filled, T2, null_safe=True))
    assert len(safe[3]) == 2 and safe[3][1]["code"] == "06000"


def test_null_key_rows_are_closed_and_reinserted_each_run(spark):
    rows = DAY1 + [(None, "Nowhere", "0")]
    h1 = load(spark, None, rows, T1)
    h2 = load(spark, h1, rows, T2)
    nulls = [r for r in h2.collect() if r["k"] is None]
    assert len(nulls) == 2                                      # G4
    assert sorted([r["_tf_valid_to"] is None for r in nulls]) == [False, True]
    assert duplicate_current(h2, KEYS).filter("k IS NOT NULL").count() == 0


def test_duplicate_source_key_fails(spark):
    with pytest.raises(Exception, match="several rows for one key"):
        load(spark, None, DAY1 + [(1, "Paris", "x")], T1).collect()


def test_close_then_open_equals_single_pass(spark):
    h1 = load(spark, None, DAY1, T1)
    day2 = [(1, "Paris", "12345"), (3, "Nice", None), (5, "Metz", "57000")]
    src = spark.createDataFrame(day2, SCHEMA)
    two = scd2_open(scd2_close(h1, src, KEYS, TRACKED, T2), src, KEYS, T2)
    one = scd2_load(h1, src, KEYS, TRACKED, T2)
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, one.collect()))


def test_invariants_and_as_of(spark):
    h1 = load(spark, None, DAY1, T1)
    day2 = [(1, "Paris", "12345"), (3, "Nice", None), (5, "Metz", "57000")]
    h2 = load(spark, h1, day2, T2)
    assert duplicate_current(h2, KEYS).count() == 0
    assert overlapping_intervals(h2, KEYS).count() == 0
    ids = [r["_tf_id"] for r in h2.collect()]
    assert len(ids) == len(set(ids))
    snap1 = sorted((r["k"], r["city"], r["code"]) for r in as_of(h2, "2024-01-01 12:00:00").collect())
    assert snap1 == sorted(DAY1)
    snap2 = sorted((r["k"], r["city"], r["code"]) for r in as_of(h2, T3).collect())
    assert snap2 == sorted(day2)
