"""What a load leaves on disk: rows stored once, no stage tables and no shuffle
files of steps that are done."""

import pathlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from lakeforge.contracts import ID, VALID_FROM
from lakeforge.operators import checks
from lakeforge.operators.keys import number_and_deal, number_within_groups
from lakeforge.operators.merge import (CHANGED, HASH, by_key, history_columns, number_first, scd2_first, scd2_load, scd2_opened,
                                       scd2_transitions, store_by_key)
from lakeforge.plans import gold, run
from lakeforge.session import cut_lineage, ensure_checkpoint_dir
from lakeforge.sources import snapshot as store
from lakeforge.sources.buckets import BucketedTable

from .conftest import SF_SMALL


def stages(spark):
    return set(pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:")).glob("lakeforge-stage-*"))


def test_a_load_stores_its_rows_once(spark, monkeypatch):
    monkeypatch.setattr(gold, "_WAREHOUSES", {})
    w = gold.warehouse(spark, SF_SMALL)
    before = stages(spark)
    w.bronze("sales_order_detail")
    bronze = stages(spark)
    assert len(bronze - before) == 1  # nothing of its numbering is left
    w.history("sales_order_detail", 1)
    first = stages(spark)
    assert len(first - bronze) == 1
    w.history("sales_order_detail", 2)
    assert len(stages(spark) - first) == 2  # merged rows, and those that got a number


def test_a_stored_table_drops_its_shuffle(spark):
    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toString()
    before = files().count("shuffle_")
    out = cut_lineage(spark.range(1000).repartition(5, "id"))
    assert files().count("shuffle_") <= before and out.count() == 1000


def test_hot_groups_beside_small_ones(spark):
    rows = [(7, i) for i in range(400)] + [(None, i) for i in range(150)] + [(g, i) for g in range(10, 60) for i in range(3)]
    df = spark.createDataFrame(rows, "g int, o int").repartition(5)
    got = sorted((r.g or 0, r.o, r.rn) for r in number_within_groups(df, ["g"], ["o"], "rn", hot=100).collect())
    assert got == sorted((g or 0, o, o + 1) for g, o in rows)
    assert number_within_groups(df, ["g"], ["o"], "rn", hot=1000).agg(F.sum("rn")).first()[0] == sum(o + 1 for _, o in rows)


def test_first_load_finds_a_key_that_occurs_twice(spark):
    schema = "k int, v string"
    nulls = spark.createDataFrame([Row(None, "a"), Row(None, "a"), Row(1, "b")], schema)
    assert sorted(r[ID] for r in scd2_load(None, nulls, ["k"], ["v"], "2024-01-01 00:00:00").collect()) == [1, 2, 3]
    twice = spark.createDataFrame([Row(1, "a"), Row(2, "b"), Row(1, "a")], schema)
    with pytest.raises(PySparkException, match="several rows for one key"):
        scd2_load(None, twice, ["k"], ["v"], "2024-01-01 00:00:00").collect()


def test_hex_ids_survive_a_load(spark):
    ids = ["00ff", "00FF", "", "abc", "zz", None, "é" * 3, "0123456789abcdef" * 2]
    day1 = spark.createDataFrame([Row(i, x) for i, x in enumerate(ids)], "k int, rowguid string")
    day2 = spark.createDataFrame([Row(i, x) for i, x in enumerate(ids[:2] + ["0", "abd"] + ids[4:])], "k int, rowguid string")
    h = scd2_load(None, day1, ["k"], ["rowguid"], "2024-01-01 00:00:00")
    assert {r.k: r.rowguid for r in h.collect()} == dict(enumerate(ids))
    h = scd2_load(h, day2, ["k"], ["rowguid"], "2024-01-02 00:00:00")
    assert sorted((r.k, str(r.rowguid), r._tf_valid_to is None) for r in h.collect()) == sorted(
        [(i, str(x), True) for i, x in enumerate(ids) if i not in (2, 3)] + [(2, "", False), (2, "0", True), (3, "abc", False), (3, "abd", True)])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_first_load_numbers_the_stored_source(spark, monkeypatch):
    monkeypatch.setattr(gold, "_WAREHOUSES", {})
    w = gold.warehouse(spark, SF_SMALL)
    h = w.history("sales_order_detail", 1)
    rows = [tuple(r) for r in h.select("sales_order_id", "sales_order_detail_id", ID).collect()]
    assert sorted(r[2] for r in rows) == list(range(1, len(rows) + 1)) and sorted(rows) == sorted(rows, key=lambda r: r[2])
    files = {f.split("/part-")[0] for f in h.inputFiles()}
    assert files >= {f.split("/part-")[0] for f in w.bronze("sales_order_detail").inputFiles()}  # no copy
    assert "rangepartitioning" not in plan(h) and "hashpartitioning" not in plan(h)


def test_lines_are_dealt_once(spark):
    rows = [(g, o) for g in [None, *range(300)] for o in range(3)]
    df = spark.createDataFrame(rows, "g int, o int").repartition(5)
    out, dealt = number_and_deal(df, ["g"], ["o"], "rn")
    assert dealt and plan(out).count("rangepartitioning") == 1 and "hashpartitioning(g" not in plan(out)
    assert sorted((r.g or -1, r.o, r.rn) for r in out.collect()) == sorted((g or -1, o, o + 1) for g, o in rows)
    assert not number_and_deal(df, ["g"], ["o"], "rn", hot=2)[1]


def test_numbers_of_a_source_stored_by_key(spark):
    schema = "k int, rowguid string"
    rows = [Row(i, f"{i:04x}") for i in range(500)] + [Row(None, "b"), Row(None, "b"), Row(None, "aa")]
    ranged = store_by_key(spark.createDataFrame(rows, schema).repartition(7), ["k"])
    got = by_key(ranged)
    assert sorted((r.k is not None, r.k or 0, r.rowguid) for r in got.collect()) == sorted((k is not None, k or 0, g) for k, g in rows)
    h = scd2_first(got, ["k"], "2024-01-01 00:00:00")
    assert {r.k: r[ID] for r in h.collect() if r.k is not None} == {i: i + 4 for i in range(500)}
    twice = by_key(store_by_key(spark.createDataFrame([Row(1, "a"), Row(2, "b"), Row(1, "a")], schema), ["k"]))
    assert twice.count() == 3  # the source may have them, the load fails
    with pytest.raises(PySparkException, match="several rows for one key"):
        scd2_first(twice, ["k"], "2024-01-01 00:00:00")


def test_rekeyed_looks_at_versions_opened_by_a_closing_load(spark):
    t = ["TIMESTAMP_NTZ '2024-01-01 00:00:00'", "TIMESTAMP_NTZ '2024-01-02 00:00:00'"]
    h = spark.sql(f"""SELECT 1 k, 'a' rowguid, {t[0]} _tf_valid_from, {t[1]} _tf_valid_to UNION ALL
        SELECT 2, 'a', {t[1]}, NULL UNION ALL SELECT 3, 'a', {t[0]}, NULL UNION ALL SELECT 4, 'b', {t[1]}, NULL""")
    out = checks.rekeyed(h, ["k"])
    assert [(r.old_k, r.new_k) for r in out.collect()] == [(1, 2)]
    assert "_lf_closing" in out._jdf.queryExecution().analyzed().toString()


def test_a_first_load_deals_its_own_columns_and_buckets_are_written_where_rows_are(spark):
    source = spark.range(1000).selectExpr("nullif(id, 999) AS k", "id % 7 AS v")
    before = stages(spark)
    numbered = number_first(source, ["k"], ID, 0)
    (stage,) = stages(spark) - before
    assert not {HASH, CHANGED, VALID_FROM} & set(spark.read.parquet(str(stage)).columns)
    st = store.Store(spark, run.new_root(spark, "tasks"))
    table, load_date = BucketedTable(st, "t", 4), "2024-01-01 00:00:00"
    table.apply(scd2_opened(numbered, ["k"], load_date).repartition(3), F.lit(True), ID, history_columns(["k", "v"]))
    folder = pathlib.Path(st.root.removeprefix("file:"), "t")
    assert [len(list(b.glob("*.parquet"))) for b in folder.glob("of=4/v=*/bucket=*")] == [3] * 4  # one of each task, no shuffle
    rows = table.read().collect()
    assert sorted(r[ID] for r in rows) == list(range(1, 1001)) and len({r[HASH] for r in rows}) == 1000
    assert all(r[ID] == (1 if r["k"] is None else r["k"] + 2) for r in rows)
    merged = scd2_transitions(table.read(), source.filter("k IS NOT NULL"), ["k"], ["v"], load_date, buckets=4)
    assert [r["k"] for r in merged.filter(CHANGED).collect()] == [None] and merged.count() == 1000  # files of a bucket meet the source
