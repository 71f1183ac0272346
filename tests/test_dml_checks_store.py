"""DML emulation, history checks and the versioned store."""

import pathlib

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import checks
from lakeforge.operators.dml import delete_where, insert_values, rekey_where, update_where
from lakeforge.sources import snapshot as store
from lakeforge.sources.jdbc import partition_options

from .conftest import SF_SMALL


def test_update_delete_keep_unknown_predicate_rows(spark):
    df = spark.createDataFrame([(1, "Paris", 2), (2, None, 3), (3, "Lyon", 4)], "k int, city string, q smallint")
    up = {r.k: r for r in update_where(df, F.col("city") == "Paris", {"q": F.col("q") + 1}).collect()}
    assert (up[1].q, up[2].q, up[3].q) == (3, 3, 4)
    assert dict(update_where(df, "city = 'Paris'", {"q": "q + 1"}).dtypes)["q"] == "smallint"
    assert sorted(r.k for r in delete_where(df, "city = 'Paris'").collect()) == [2, 3]   # NULL stays
    assert sorted(r.k for r in rekey_where(df, "k = 3", "k", F.lit(999)).collect()) == [1, 2, 999]
    assert insert_values(df, [(4, "Metz", 1)]).count() == 4


def test_history_checks(spark):
    rows = [(1, "g1", "2024-01-01", "2024-01-02"), (1, "g1", "2024-01-02", None),
            (2, "g2", "2024-01-01", "2024-01-02"), (20, "g2", "2024-01-02", None),
            (3, "g3", "2024-01-01", "2024-01-02")]
    h = (spark.createDataFrame(rows, "k int, rowguid string, f string, t string")
         .select("k", "rowguid", F.col("f").cast("timestamp_ntz").alias("_tf_valid_from"),
                 F.col("t").cast("timestamp_ntz").alias("_tf_valid_to")))
    assert sorted(r.k for r in checks.versions_of_changed_keys(h, ["k"]).collect()) == [1, 1]
    assert sorted(r.k for r in checks.closed_deleted(h, ["k"]).collect()) == [2, 3]
    rk = checks.rekeyed(h, ["k"]).collect()
    assert [(r.old_k, r.new_k) for r in rk] == [(2, 20)]
    st = checks.version_stats(h, ["k"]).collect()
    assert [(r.k, r.nb_versions) for r in st] == [(1, 2)]
    assert checks.duplicate_current(h, ["k"]).count() == 0


def test_store_versions_and_uncommitted_writes(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    df1 = spark.createDataFrame([(1,), (2,)], "k int")
    assert store.write_version(df1, root, "t") == 1
    st = store.Store(spark, root)
    st.write(spark.createDataFrame([(3,)], "k int"), "t")
    assert st.read("t").count() == 1                               # visible to the run
    assert store.read_version(spark, root, "t").count() == 2       # not yet to readers
    st.commit()
    assert store.read_version(spark, root, "t").count() == 1
    assert store.read_version(spark, root, "t", version=1).count() == 2
    with pytest.raises(FileNotFoundError):
        store.read_version(spark, root, "missing")


def test_jdbc_partition_options():
    o = partition_options("id", 10, 1, 4)
    assert o == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "11", "numPartitions": "4"}
    with pytest.raises(ValueError):
        partition_options("id", 1, 2, 0)


def test_unreadable_log_is_not_an_empty_store(spark, tmpdir_path):
    root = tmpdir_path + "/broken"
    store.write_version(spark.createDataFrame([(1,)], "k int"), root, "t")
    for part in pathlib.Path(root, "_log").glob("*.parquet"):
        part.write_bytes(b"not a parquet file")
        part.with_name(f".{part.name}.crc").unlink()
    with pytest.raises(Exception, match="(?i)parquet"):
        store.Store(spark, root)


def test_second_writer_of_a_version_fails(spark, tmpdir_path):
    root, df = tmpdir_path + "/race", spark.createDataFrame([(1,)], "k int")
    one, two = store.Store(spark, root), store.Store(spark, root)
    one.write(df, "t")
    two.write(df, "t")
    one.commit()
    with pytest.raises(store.ConcurrentCommit):
        two.commit()
    assert store.versions(spark, root).count() == 1


def test_failed_build_is_tried_again(spark):
    from lakeforge.plans import gold
    w = gold.Warehouse(spark, SF_SMALL)
    calls = []

    def build():
        calls.append(1)
        if len(calls) == 1:
            raise OSError("storage hiccup")
        return "built"

    with pytest.raises(OSError):
        w._memo("x", build)
    assert w._memo("x", build) == "built" and w._memo("x", build) == "built" and len(calls) == 2


def test_orphan_facts_go_around_the_join(spark):
    from lakeforge.operators.merge import scd1_upsert
    schema = "id long, o int, l int, v int, _tf_create_date timestamp_ntz, _tf_update_date timestamp_ntz"
    target = spark.createDataFrame([], schema)
    source = spark.createDataFrame([(1, 1, 5), (None, 1, 6), (None, 2, 7)], "o int, l int, v int")
    for run, total in ((1, 3), (2, 5), (3, 7)):  # orphans are inserted by every run
        target = scd1_upsert(target, source, ["o", "l"], ["v"], "id", f"2024-01-0{run} 00:00:00")
        ids = [r["id"] for r in target.collect()]
        assert len(ids) == total == len(set(ids))


def test_day_two_with_keys_above_any_fixed_shift(spark):
    from lakeforge.sources.fixtures import day2_snapshot
    day1 = spark.sql("""SELECT * FROM VALUES (5, 'a'), (1000005, 'b'), (1000006, 'c') AS t(ProductModelID, Name)""").selectExpr(
        "CAST(ProductModelID AS INT) ProductModelID", "Name", "CAST(NULL AS STRING) CatalogDescription", "Name AS rowguid",
        "TIMESTAMP_NTZ '2024-01-01' AS ModifiedDate")
    ids = [r[0] for r in day2_snapshot(day1, "product_model").select("ProductModelID").collect()]
    assert len(ids) == len(set(ids)) and 5 + 1000006 in ids
