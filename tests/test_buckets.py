"""Bucketed tables: what a load writes, how the merge reads them, and what
happens when a load fails."""

import pathlib

import pytest
from pyspark.sql import functions as F

from lakeforge.contracts import FACT_COLUMNS, FACT_COMPARED, FACT_KEYS, ID, SILVER, VALID_TO
from lakeforge.operators.merge import HASH, scd1_merged
from lakeforge.plans import gold, run, silver
from lakeforge.sources import snapshot as store
from lakeforge.sources.buckets import BucketedTable

from .conftest import SF_SMALL

FACT = "gold/fact_sales"


def files(root, table):
    """Data files by bucket, newest version's first."""
    out = {}
    for p in pathlib.Path(root.removeprefix("file:"), table).glob("of=*/v=*/bucket=*/*.parquet"):
        out.setdefault(int(p.parent.name.split("=")[1]), set()).add(str(p))
    return out


@pytest.fixture(scope="module")
def projection(spark):
    return gold.warehouse(spark, SF_SMALL).fact_projection(1).filter("sales_order_id IS NOT NULL").cache()


def test_upsert_of_few_orders_writes_only_their_buckets(spark, projection):
    root = run.new_root(spark, "buckets")
    st = store.Store(spark, root)
    gold.upsert_fact(st, FACT, projection, silver.LOADS[1], buckets=64)
    st.commit()
    before, rows = files(root, FACT), {r[FACT_COLUMNS[0]]: r for r in gold.fact_history(st).collect()}
    assert len(rows) == projection.count() and all(len(f) == 1 for f in before.values())
    n = projection.select("sales_order_id").distinct().count() // 100
    few = [r[0] for r in projection.select("sales_order_id").distinct().orderBy("sales_order_id").limit(n).collect()]
    changed = F.col("sales_order_id").isin(few)
    second = projection.withColumn("sales_order_qty", F.when(changed, F.col("sales_order_qty") + 1).otherwise(F.col("sales_order_qty")).cast("smallint"))
    st = store.Store(spark, root)
    table = BucketedTable(st, FACT)
    assert table.buckets == 64
    wanted = {r[0] for r in table.read().filter(changed).select(table.bucket()).distinct().collect()}
    gold.upsert_fact(st, FACT, second, silver.LOADS[2])
    st.commit()
    after = files(root, FACT)
    assert {b for b in after if after[b] != before.get(b)} == wanted and 0 < len(wanted) < len(before)
    found = gold.fact_history(store.Store(spark, root)).collect()
    assert len(found) == len(rows)
    for r in found:
        old = rows[r[FACT_COLUMNS[0]]]
        bump = old["sales_order_id"] in few
        assert r["sales_order_qty"] == old["sales_order_qty"] + bump and str(r["_tf_update_date"]) == silver.LOADS[2 if bump else 1]


def test_merge_does_not_shuffle_the_table_and_reads_the_source_once(spark, projection):
    st = store.Store(spark, run.new_root(spark, "plan"))
    gold.upsert_fact(st, FACT, projection, silver.LOADS[1])
    source = projection.repartition(4).observe("source", F.count(F.lit(1)).alias("n"))
    table = BucketedTable(st, FACT)
    merged = scd1_merged(table.read(), source, list(FACT_KEYS), [c for c, _ in FACT_COMPARED], FACT_COLUMNS[0], silver.LOADS[2],
                         buckets=table.buckets)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    left = join[:join.index("CollectMetrics")]
    assert "Bucketed: true" in left and "FullOuter" in join
    # one exchange of the source, in buckets; none between the join and the table's scan
    assert left.count("Exchange hashpartitioning(") == 1 and left.index("Bucketed: true") < left.index("Exchange hashpartitioning(")
    assert join.count("CollectMetrics") == 1


def test_silver_keeps_the_files_of_untouched_buckets(spark):
    root = run.new_root(spark, "silver")
    source = gold.warehouse(spark, SF_SMALL).bronze("address")
    st = store.Store(spark, root)
    run.load_silver(st, "address", source, silver.LOADS[1], buckets=32)
    before = files(root, "silver/address/current")
    key = SILVER["address"].source_key
    changed = source.withColumn("City", F.when(F.col(key) == 7, "Elsewhere").otherwise(F.col("City"))).filter(F.col(key) != 8)
    run.load_silver(st, "address", changed, silver.LOADS[2])
    after = files(root, "silver/address/current")
    touched = {b for b in after if after[b] != before[b]}
    assert 1 <= len(touched) <= 2
    history = run.silver_history(st, "address")
    assert history.filter(F.col(VALID_TO).isNotNull()).count() == 2 and history.filter("address_id = 7").count() == 2
    assert history.count() == source.count() + 1 and history.select(ID).distinct().count() == history.count()


def test_empty_first_load_and_bucket_that_loses_its_rows(spark):
    source = gold.warehouse(spark, SF_SMALL).bronze("address")
    st = store.Store(spark, run.new_root(spark, "empty"))
    run.load_silver(st, "address", source.limit(0), silver.LOADS[1])
    assert run.silver_history(st, "address").count() == 0
    few = source.filter("AddressID <= 3")
    run.load_silver(st, "address", few, silver.LOADS[2])
    assert run.silver_current(st, "address").count() == 3
    run.load_silver(st, "address", source.limit(0), silver.LOAD_3)
    assert run.silver_current(st, "address").count() == 0
    assert run.silver_history(st, "address").filter(F.col(VALID_TO) == F.lit(silver.LOAD_3).cast("timestamp_ntz")).count() == 3


def test_null_keys_spread_over_the_buckets(spark, projection):
    st = store.Store(spark, run.new_root(spark, "nulls"))
    orphans = projection.withColumn("sales_order_id", F.lit(None).cast("int"))
    gold.upsert_fact(st, FACT, orphans, silver.LOADS[1], buckets=8)
    table = BucketedTable(st, FACT).read()
    sizes = [r["count"] for r in table.groupBy(F.pmod(F.hash(HASH), F.lit(8))).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
    gold.upsert_fact(st, FACT, orphans.limit(5), silver.LOADS[2])  # they match nothing
    found = gold.fact_history(st)
    assert found.count() == orphans.count() + 5 == found.select(FACT_COLUMNS[0]).distinct().count()


def test_rows_that_break_a_constraint_are_not_committed(spark, projection):
    root = run.new_root(spark, "constraints")
    w = gold.warehouse(spark, SF_SMALL)
    dims = {s.surrogate: w.dim(s, 1) for s in (gold.CUSTOMER, gold.GEOGRAPHY, gold.PRODUCT)}
    st = store.Store(spark, root)
    gold.upsert_fact(st, FACT, projection, silver.LOADS[1], dims=dims)
    st.commit()
    assert st.observed and all(n == 0 for _, _, n in st.observed)
    for column, value in (("_tf_dim_product_id", 10**9), ("_tf_dim_customer_id", None)):
        bad = projection.withColumn(column, F.when(F.col("sales_order_id") == 2, F.lit(value).cast("long")).otherwise(F.col(column)))
        bad = bad.withColumn("sales_order_qty", (F.col("sales_order_qty") + 1).cast("smallint"))
        st = store.Store(spark, root)
        with pytest.raises(store.ConstraintViolation, match=column):
            gold.upsert_fact(st, FACT, bad, silver.LOADS[2], dims=dims)
        assert store.Store(spark, root).version(FACT) == 1
    with pytest.raises(store.ConstraintViolation, match="k is NULL"):
        st.write(spark.createDataFrame([(1,), (None,)], "k int"), "t", checks={"k is NULL": F.col("k").isNull()})
    assert not st.has("t")


def test_failed_run_goes_on_after_the_layers_it_has_finished(spark, monkeypatch):
    whole, broken = run.new_root(spark, "whole"), run.new_root(spark, "broken")
    for day in (1, 2):
        run.run_day(spark, SF_SMALL, whole, day)
    run.run_day(spark, SF_SMALL, broken, 1)
    layers, calls = run.LAYERS, []

    def fail(st, d, day, buckets):
        raise OSError("storage hiccup")

    monkeypatch.setattr(run, "LAYERS", (*layers[:2], ("dimensions", fail)))
    with pytest.raises(OSError):
        run.run_day(spark, SF_SMALL, broken, 2)
    counted = tuple((n, lambda *a, n=n, f=f: (calls.append(n), f(*a))) for n, f in layers)
    monkeypatch.setattr(run, "LAYERS", counted)
    run.run_day(spark, SF_SMALL, broken, 2)
    run.run_day(spark, SF_SMALL, broken, 2)  # a day that is done does nothing
    assert calls == ["dimensions", "fact"]
    one, two = store.Store(spark, whole), store.Store(spark, broken)
    for table in SILVER:
        assert run.content(run.silver_history(one, table), "", "").collect() == run.content(run.silver_history(two, table), "", "").collect()
    assert run.content(gold.fact_history(one), "", "").collect() == run.content(gold.fact_history(two), "", "").collect()
