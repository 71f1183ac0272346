"""Lookups in tables whose files are small and whose rows are many: none is
broadcast, since a broadcast passes through the driver."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeforge.contracts import CUSTOMER, GEOGRAPHY, PRODUCT, PRODUCT_CATEGORY
from lakeforge.operators import star
from lakeforge.plans import checks, gold
from lakeforge.session import cut_lineage

MANY = star.BROADCAST_ROWS + 1
T0 = dt.datetime(2024, 1, 1)
KEYS = "sales_order_id int, sales_order_detail_id int, _tf_dim_calendar_id int, _tf_dim_customer_id long, " \
       "_tf_dim_geography_id long, _tf_dim_product_id long"
ROWS = [(1, 1, 20010506, 5, 6, 7), (1, 2, None, 5, MANY, 7), (2, 1, 19990101, None, -1, -2)]
LOST = {(1, 2, "_tf_dim_calendar_id", None), (1, 2, "_tf_dim_geography_id", MANY), (2, 1, "_tf_dim_calendar_id", 19990101),
        (2, 1, "_tf_dim_customer_id", None), (2, 1, "_tf_dim_geography_id", -1), (2, 1, "_tf_dim_product_id", -2)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def dims(spark):
    """Stored dimensions with keys 0 .. MANY - 1, a natural key being 1000 less."""
    return {s: cut_lineage(spark.range(MANY).select(F.col("id").alias(s.surrogate), (F.col("id") - 1000).cast("int").alias(s.natural_key)))
            for s in (CUSTOMER, GEOGRAPHY, PRODUCT)}


class Stored:
    """A warehouse that holds given tables."""

    def __init__(self, fact, dims):
        self.fact, self.dim = lambda day: fact, lambda spec, day: dims[spec]


@pytest.fixture()
def stored_plans(monkeypatch):
    """Plans of what ``lost_keys`` stores."""
    plans = []
    monkeypatch.setattr(star, "cut_lineage", lambda df: plans.append(plan(df)) or cut_lineage(df))
    return plans


def test_fact_projection_broadcasts_no_large_dimension(spark, dims):
    h = "_tf_valid_from timestamp_ntz, _tf_valid_to timestamp_ntz"
    lines = spark.createDataFrame([(1, 1, 100, 2, 1.0, 0.0, 2.0, T0, None), (1, 2, None, 1, 1.0, 0.0, 1.0, T0, None), (2, 1, MANY, 1, 1.0, 0.0, 1.0, T0, None)],
                                  f"sales_order_id int, sales_order_detail_id int, product_id int, order_qty smallint, unit_price double, unit_price_discount double, line_total double, {h}")
    headers = spark.createDataFrame([(1, T0, 10, 20, T0, None)], f"sales_order_id int, order_date timestamp_ntz, customer_id int, bill_to_address_id int, {h}")
    customers, addresses = (cut_lineage(spark.range(MANY).select(F.col("id").cast("int").alias(c), F.lit(T0).alias("_tf_valid_from"),
                                                                 F.lit(None).cast("timestamp_ntz").alias("_tf_valid_to"))) for c in ("customer_id", "address_id"))
    out = star.fact_sales_projection(lines, headers, customers, addresses, dims[CUSTOMER], dims[GEOGRAPHY], dims[PRODUCT])
    assert "Broadcast" not in plan(out)
    got = {(r[0], r[1]): tuple(r[2:6]) for r in out.collect()}
    assert got == {(1, 1): (20240101, 1010, 1020, 1100), (1, 2): (20240101, 1010, 1020, -9), (None, 1): (None, -9, -9, -9)}


def test_small_lookups_are_left_to_spark(spark, dims):
    few, many = (t.join(star.lookup_side(dims[PRODUCT].filter(c)), PRODUCT.surrogate) for t, c in
                 ((dims[CUSTOMER].withColumnRenamed(CUSTOMER.surrogate, PRODUCT.surrogate), c) for c in (f"{PRODUCT.surrogate} < 50", "true")))
    assert "BroadcastHashJoin" in plan(few) and "Broadcast" not in plan(many)
    assert (few.count(), many.count()) == (50, MANY)


def test_categories_and_products_meet_in_no_broadcast_if_they_are_many(spark, dims):
    products = spark.createDataFrame([(1, 3), (2, None), (3, MANY)], "prod_product_id int, _tf_dim_product_category_id long")
    categories = cut_lineage(spark.range(MANY).selectExpr(
        "id AS _tf_dim_product_category_id", "CAST(id AS string) AS prod_cat_name", "'a' AS prod_cat_level_1_name", "'b' AS prod_cat_level_2_name"))
    out = checks._product_with_category(Stored(None, {PRODUCT: products, PRODUCT_CATEGORY: categories}))
    assert "Broadcast" not in plan(out)
    assert {r.prod_product_id: r.category_name for r in out.collect()} == {1: "3", 2: None, 3: None}


def test_orphan_keys_do_not_pass_the_dimensions_through_the_driver(spark, dims, monkeypatch, stored_plans):
    fact = spark.createDataFrame(ROWS * 2, KEYS)  # rows may come twice
    monkeypatch.setattr(gold, "warehouse", lambda spark, d: Stored(fact, dims))
    out = checks.fact_orphan_keys(spark, "")
    known = {f for d in dims.values() for f in d.inputFiles()}
    assert not known & set(out.inputFiles())  # rows meet lost keys only
    assert len(stored_plans) == 4 and not any("Broadcast" in p for p in stored_plans[1:])
    got = [tuple(r) for r in out.collect()]
    assert set(got) == LOST and len(got) == 2 * len(LOST)


def test_reference_checks_do_not_pass_the_dimensions_through_the_driver(spark, dims, stored_plans):
    rows, found = gold.reference_checks(spark.createDataFrame(ROWS, KEYS), {s.surrogate: dims[s] for s in dims})
    known = {f for d in dims.values() for f in d.inputFiles()}
    assert not known & set(rows.inputFiles())
    assert len(stored_plans) == 3 and not any("Broadcast" in p for p in stored_plans)
    counts = rows.agg(*[F.count_if(c).alias(name) for name, c in found.items()]).first().asDict()
    assert counts == {"_tf_dim_customer_id has no row in its dimension": 0, "_tf_dim_customer_id is NULL": 1,
                      "_tf_dim_geography_id has no row in its dimension": 2, "_tf_dim_geography_id is NULL": 0,
                      "_tf_dim_product_id has no row in its dimension": 1, "_tf_dim_product_id is NULL": 0}
    assert rows.count() == len(ROWS)
