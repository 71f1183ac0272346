"""Gold builders: calendar, hierarchy flattening, SCD1 upsert, star lookup."""

import datetime as dt

from lakeforge.contracts import GEOGRAPHY
from lakeforge.operators.hierarchy import flatten_categories
from lakeforge.operators.merge import scd1_upsert
from lakeforge.operators.star import fact_sales_projection
from lakeforge.plans import gold

T1, T2 = "2024-01-01 06:00:00", "2024-01-02 06:00:00"
NTZ = dt.datetime


def test_calendar_rows_and_attributes(spark):
    cal = gold.dim_calendar_range(spark)
    assert cal.count() == 10959
    rows = {r.cal_date: r for r in cal.filter(
        "cal_date IN (DATE'2000-01-01', DATE'2000-10-03', DATE'2000-10-04', DATE'2024-02-29')").collect()}
    jan1 = rows[dt.date(2000, 1, 1)]  # a Saturday
    assert jan1._tf_dim_calendar_id == 20000101
    assert jan1.cal_day_name == "Saturday" and jan1.cal_week_day == 6
    assert jan1.cal_week_start == dt.date(1999, 12, 27) and jan1.cal_week_end == dt.date(2000, 1, 2)
    assert jan1.cal_date_full == "Saturday January 01 2000"
    assert rows[dt.date(2000, 10, 3)].cal_fiscal_year == 2000
    assert rows[dt.date(2000, 10, 4)].cal_fiscal_year == 2001   # G9: rolls on Oct 4
    leap = rows[dt.date(2024, 2, 29)]
    assert leap.cal_last_day_of_month == dt.date(2024, 2, 29)
    assert leap.cal_first_day_of_month == dt.date(2024, 2, 1) and leap.cal_fiscal_quarter == 1


def test_flatten_two_levels_and_missing_parent(spark):
    cats = spark.createDataFrame(
        [(1, None, "Bikes"), (2, 0, "Parts"), (10, 1, "Road"), (11, 99, "Orphan")],
        "product_category_id int, parent_product_category_id int, name string")
    got = {r.prod_cat_category_id: r for r in flatten_categories(cats).collect()}
    assert (got[1].prod_cat_level_1_id, got[1].prod_cat_level_2_id, got[1].prod_cat_level_2_name) == (1, 0, "N/A")
    assert got[2].prod_cat_level_1_id == 2 and got[2].prod_cat_parent_category_id == 0
    assert (got[10].prod_cat_level_1_id, got[10].prod_cat_level_1_name) == (1, "Bikes")
    assert (got[10].prod_cat_level_2_id, got[10].prod_cat_level_2_name) == (10, "Road")
    assert got[11].prod_cat_level_1_id is None and got[11].prod_cat_level_1_name == "N/A"   # G13


def test_scd1_upsert_keeps_seed_and_target_only_rows(spark):
    seed = gold.seeded_dim(spark, GEOGRAPHY)
    cols = ["geo_address_id"] + GEOGRAPHY.compared
    s1 = spark.createDataFrame([(1, "a", "N/A", "c", "s", "r", "p"), (2, "b", "N/A", "c", "s", "r", "p")], cols)
    d1 = gold.upsert_dim(seed, s1, GEOGRAPHY, T1).cache()
    s2 = spark.createDataFrame([(1, "a2", "N/A", "c", "s", "r", "p"), (3, "x", "N/A", "c", "s", "r", "p")], cols)
    d2 = {r.geo_address_id: r for r in gold.upsert_dim(d1, s2, GEOGRAPHY, T2).collect()}
    assert d2[0]._tf_dim_geography_id == -9                       # seed kept
    assert d2[1]._tf_dim_geography_id == 1 and d2[1].geo_address_line_1 == "a2"
    assert d2[1]._tf_create_date == NTZ(2024, 1, 1, 6) and d2[1]._tf_update_date == NTZ(2024, 1, 2, 6)
    assert d2[2].geo_address_line_1 == "b" and d2[2]._tf_update_date == NTZ(2024, 1, 1, 6)   # G8
    assert d2[3]._tf_dim_geography_id == 3


def test_scd1_fact_null_key_is_inserted_every_run(spark):
    src = spark.createDataFrame([(None, 1, 5), (7, 1, 6)], "a int, b int, v int")
    empty = spark.createDataFrame([], "sk long, a int, b int, v int, _tf_create_date timestamp_ntz, "
                                      "_tf_update_date timestamp_ntz")
    f1 = scd1_upsert(empty, src, ["a", "b"], ["v"], "sk", T1).cache()
    f2 = scd1_upsert(f1, src, ["a", "b"], ["v"], "sk", T2)
    assert f2.filter("a IS NULL").count() == 2 and f2.filter("a = 7").count() == 1   # G7


def _hist(spark, rows, ddl):
    h = "_tf_valid_from timestamp_ntz, _tf_valid_to timestamp_ntz"
    return spark.createDataFrame(rows, f"{ddl}, {h}")


def test_fact_projection_lookups(spark):
    t0, t1 = NTZ(2024, 1, 1), NTZ(2024, 1, 2)
    lines = _hist(spark, [(1, 1, 100, 2, 1.0, 0.0, 2.0, t0, None), (2, 1, 101, 1, 1.0, 0.0, 1.0, t0, None),
                          (1, 2, 100, 1, 1.0, 0.0, 1.0, t0, t1)],
                  "sales_order_id int, sales_order_detail_id int, product_id int, order_qty smallint, "
                  "unit_price double, unit_price_discount double, line_total double")
    headers = _hist(spark, [(1, NTZ(2001, 5, 6), 10, 20, t0, None)],
                    "sales_order_id int, order_date timestamp_ntz, customer_id int, bill_to_address_id int")
    customers = _hist(spark, [(10, t0, t1)], "customer_id int")          # closed customer
    addresses = _hist(spark, [(20, t0, None)], "address_id int")
    dim_c = spark.createDataFrame([(5, 10)], "_tf_dim_customer_id long, cust_customer_id int")
    dim_g = spark.createDataFrame([(6, 20)], "_tf_dim_geography_id long, geo_address_id int")
    dim_p = spark.createDataFrame([(7, 100)], "_tf_dim_product_id long, prod_product_id int")
    out = {(r.sales_order_id, r.sales_order_detail_id): r for r in fact_sales_projection(
        lines, headers, customers, addresses, dim_c, dim_g, dim_p).collect()}
    r = out[(1, 1)]
    assert r._tf_dim_calendar_id == 20010506
    assert r._tf_dim_customer_id == -9          # G6: closed customer
    assert (r._tf_dim_geography_id, r._tf_dim_product_id) == (6, 7)
    orphan = out[(None, 1)]                     # G7: no current header
    assert orphan._tf_dim_calendar_id is None and orphan._tf_dim_product_id == -9
    assert len(out) == 2                        # closed line not projected
    fixed = fact_sales_projection(lines, headers, customers, addresses, dim_c, dim_g, dim_p,
                                  fix_orphans=True)
    assert fixed.filter("sales_order_id = 2").count() == 1
