"""Property tier: random snapshot sequences vs a plain-Python fold of the
SCD2 rule (NULL-blind change test, ids in key order after the max)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeforge.operators.merge import empty_history, scd2_load

LOADS = ["2024-01-01 06:00:00", "2024-01-02 06:00:00", "2024-01-03 06:00:00"]


def fold(snapshots, null_safe=False):
    rows, next_id = [], 1
    for t, snap in zip(LOADS, snapshots):
        tt = dt.datetime.fromisoformat(t)
        active = [r for r in rows if r["vt"] is None]
        keep = set()
        for r in active:
            v = snap.get(r["k"], "<absent>")
            if null_safe:
                same = r["k"] in snap and r["v"] == v
            else:
                same = r["k"] in snap and (r["v"] is None or v is None or r["v"] == v)
            if same:
                keep.add(r["k"])
            else:
                r["vt"], r["ud"] = tt, tt
        for k in sorted(k for k in snap if k not in keep):
            rows.append({"id": next_id, "k": k, "v": snap[k], "vf": tt, "vt": None, "cd": tt, "ud": tt})
            next_id += 1
    return sorted((r["id"], r["k"], r["v"], r["vf"], r["vt"], r["cd"], r["ud"]) for r in rows)


snapshot = st.dictionaries(st.integers(1, 12), st.one_of(st.none(), st.sampled_from("abc")), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(snapshot, min_size=1, max_size=3), st.booleans())
def test_scd2_matches_python_fold(spark, snapshots, null_safe):
    h = None
    for t, snap in zip(LOADS, snapshots):
        src = spark.createDataFrame(sorted(snap.items()), "k int, v string")
        h = scd2_load(empty_history(src) if h is None else h, src, ["k"], ["v"], t,
                      null_safe=null_safe).cache()
    got = sorted(tuple(r) for r in h.select("_tf_id", "k", "v", "_tf_valid_from", "_tf_valid_to",
                                            "_tf_create_date", "_tf_update_date").collect())
    assert got == fold(snapshots, null_safe)
