"""The layered run's split Silver layout (closed parts + current part)
holds exactly the history a single-table SCD2 load produces."""

import pathlib

from lakeforge.contracts import CUSTOMER, GEOGRAPHY, PRODUCT, PRODUCT_CATEGORY, SILVER
from lakeforge.plans import gold, run
from lakeforge.session import ensure_checkpoint_dir
from lakeforge.sources import snapshot as store

from .conftest import SF_SMALL


def test_split_layout_equals_history(spark):
    root = run.new_root(spark, "test")
    base = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = {p.name for p in base.glob("lakeforge-stage-*")}
    for day in (1, 2):
        run.run_day(spark, SF_SMALL, root, day)
    assert {p.name for p in base.glob("lakeforge-stage-*")} == before  # a run leaves no stage table
    st = store.Store(spark, root)
    w = gold.warehouse(spark, SF_SMALL)
    for table in SILVER:
        split, whole = run.silver_history(st, table), w.history(table, 2)
        assert run.content(split.select(*whole.columns), "", table).collect() == run.content(whole, "", table).collect()
    for spec in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT):
        stored = st.read(f"gold/{spec.name}")
        assert run.content(stored, "", spec.name).collect() == run.content(w.dim(spec, 2).select(*stored.columns), "", spec.name).collect()
    stored = gold.fact_history(st)
    assert run.content(stored, "", "f").collect() == run.content(w.fact(2).select(*stored.columns), "", "f").collect()
    assert st.all_versions("gold/fact_sales")[-1][0] == 2


def test_checksum_sees_content_not_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    c = spark.createDataFrame([(2, "x"), (1, None)], "k int, v string")
    rows = [run.content(df, "l", "t").first() for df in (a, b, c)]
    assert rows[0] == rows[1] != rows[2]


def test_names_of_a_store(spark):
    from lakeforge.sources.catalog import publish, withdraw
    before = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    root = run.new_root(spark, "names")
    run.run_day(spark, SF_SMALL, root, 1)
    publish(store.Store(spark, root), "t1_")
    first = spark.table("t1_gold.fact_sales").count()
    assert first == spark.table("t1_silver.sales_order_detail").count() and spark.table("t1_silver.address_closed").count() == 0
    run.run_day(spark, SF_SMALL, root, 2)
    assert spark.table("t1_gold.fact_sales").count() == first  # names move when they are published
    st = store.Store(spark, root)
    publish(st, "t1_")
    assert run.content(spark.table("t1_gold.fact_sales"), "", "").collect() == run.content(gold.fact_history(st), "", "").collect()
    for t in SILVER:
        assert run.content(spark.table(f"t1_silver.{t}"), "", "").collect() == run.content(run.silver_history(st, t), "", "").collect()
        assert spark.table(f"t1_silver.{t}_current").count() == run.silver_current(st, t).count()
    plan = spark.sql("SELECT c.city, s._tf_valid_from FROM t1_silver.address s JOIN t1_bronze.address c ON s.address_id = c.AddressID")
    assert plan.count() > 0
    withdraw(spark, "t1_")
    assert {r[0] for r in spark.sql("SHOW DATABASES").collect()} == before
    assert store.read_version(spark, root, "gold/dim_customer").count() > 0  # files stay
