"""Registered check queries: history checks (Q1–Q6, Q11, S17), star-schema
previews (Q7–Q10), integrity checks (S12) and DML emulation (M6–M8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import (CUSTOMER, FACT_KEYS, GEOGRAPHY, PRODUCT, PRODUCT_CATEGORY, PRODUCT_PREVIEW, SILVER,
                         UNKNOWN_KEY, VALID_TO)
from ..operators import checks
from ..operators.dml import delete_where, insert_values, rekey_where, update_where
from ..operators.keys import check_not_null, check_unique
from ..operators.merge import as_of
from ..operators.star import lookup_side, lost_keys
from . import gold, silver

DETAIL_KEYS = list(SILVER["sales_order_detail"].keys)
AS_OF_TIME = "2024-01-01 12:00:00"  # between the two loads


def _detail_history(spark: SparkSession, d: str) -> DataFrame:
    return gold.warehouse(spark, d).history("sales_order_detail", 2)


def hist_updated_versions(spark, d):
    h = _detail_history(spark, d)
    return checks.versions_of_changed_keys(h, DETAIL_KEYS).select(
        *DETAIL_KEYS, "order_qty", "unit_price", "_tf_valid_from", "_tf_valid_to",
        "_tf_create_date", "_tf_update_date")


def hist_closed_deleted(spark, d):
    h = _detail_history(spark, d)
    return checks.closed_deleted(h, DETAIL_KEYS).select(
        *DETAIL_KEYS, "order_qty", "product_id", "_tf_valid_from", "_tf_valid_to", "_tf_update_date")


def hist_rekeyed(spark, d):
    return checks.rekeyed(_detail_history(spark, d), DETAIL_KEYS)


def hist_version_stats(spark, d):
    return checks.version_stats(_detail_history(spark, d), DETAIL_KEYS, top=20)


def hist_duplicate_active(spark, d):
    return checks.duplicate_current(_detail_history(spark, d), DETAIL_KEYS)


def hist_active_listing(spark, d):
    h = _detail_history(spark, d)
    return (h.filter(F.col(VALID_TO).isNull())
            .select(*DETAIL_KEYS, "order_qty", "product_id", "unit_price", "unit_price_discount",
                    "line_total", "_tf_valid_from", "_tf_create_date")
            .orderBy(*DETAIL_KEYS).limit(50))


def hist_as_of(spark, d):
    """State of Silver address as of a time between the loads (= day 1)."""
    return as_of(gold.warehouse(spark, d).history("address", 2), AS_OF_TIME)


def hist_interval_overlaps(spark, d):
    return checks.overlapping_intervals(_detail_history(spark, d), DETAIL_KEYS)


def source_preview(spark, d):
    """Q11: first and last five order lines of the day-1 source by key."""
    src = silver.silver_source(spark, d, "sales_order_detail", 1).select(
        *DETAIL_KEYS, "order_qty", "product_id", "unit_price")
    first = src.orderBy(*DETAIL_KEYS).limit(5).withColumn("preview", F.lit("first"))
    last = (src.orderBy(*[F.col(k).desc() for k in DETAIL_KEYS]).limit(5)
            .withColumn("preview", F.lit("last")))
    return first.unionByName(last)


def source_preview_city(spark, d):
    """Q11: addresses of the first city and the last addresses by id."""
    src = silver.silver_source(spark, d, "address", 1).select("address_id", "city", "state_province", "postal_code")
    by_city = src.orderBy("city", "address_id").limit(10).withColumn("preview", F.lit("city"))
    last = src.orderBy(F.col("address_id").desc()).limit(10).withColumn("preview", F.lit("last"))
    return by_city.unionByName(last)


# --- star previews (Q7–Q10) ------------------------------------------------------------
def star_category_preview(spark, d):
    dim = gold.warehouse(spark, d).dim(PRODUCT_CATEGORY, 2)
    return dim.select(PRODUCT_CATEGORY.surrogate, PRODUCT_CATEGORY.natural_key,
                      *PRODUCT_CATEGORY.compared).orderBy("prod_cat_category_id").limit(20)


def star_product_preview(spark, d):
    dim = gold.warehouse(spark, d).dim(PRODUCT, 2)
    return dim.select(*PRODUCT_PREVIEW).orderBy("prod_product_id").limit(20)


def _product_with_category(w) -> DataFrame:
    p = w.dim(PRODUCT, 2)
    pc = w.dim(PRODUCT_CATEGORY, 2).select(
        "_tf_dim_product_category_id", F.col("prod_cat_name").alias("category_name"),
        F.col("prod_cat_level_1_name").alias("level_1"), F.col("prod_cat_level_2_name").alias("level_2"))
    return p.join(lookup_side(pc), "_tf_dim_product_category_id", "left")


def star_product_category(spark, d):
    j = _product_with_category(gold.warehouse(spark, d))
    return (j.select("prod_product_id", "prod_name", "prod_list_price", "category_name", "level_1",
                     "level_2").orderBy("prod_product_id").limit(20))


def star_fact_product_category(spark, d):
    w = gold.warehouse(spark, d)
    f = w.fact(2).select(*FACT_KEYS, "sales_order_qty", "sales_line_total", "_tf_dim_product_id")
    pj = _product_with_category(w).select(
        "_tf_dim_product_id", "prod_name", "prod_list_price",
        F.col("level_1").alias("category_level_1"), F.col("level_2").alias("category_level_2"))
    return (f.join(pj, "_tf_dim_product_id", "left").drop("_tf_dim_product_id")
            .orderBy(*FACT_KEYS).limit(20))


# --- integrity (S12) ------------------------------------------------------------------
def fact_orphan_keys(spark, d):
    """Fact rows whose foreign keys resolve in no dimension row: the date key
    against the fixed 2000–2030 calendar (orders before 2000 are orphans,
    G10), the other keys against their dimensions (-9 always resolves)."""
    w = gold.warehouse(spark, d)
    f = w.fact(2).select(*FACT_KEYS, "_tf_dim_calendar_id", "_tf_dim_customer_id",
                         "_tf_dim_geography_id", "_tf_dim_product_id")
    cal = gold.dim_calendar_range(spark).select("_tf_dim_calendar_id")
    dims = [("_tf_dim_calendar_id", cal)] + [(s.surrogate, w.dim(s, 2)) for s in (CUSTOMER, GEOGRAPHY, PRODUCT)]
    # Distinct keys of each column are looked up in their dimension, then each
    # row lists its keys that were not found, in one pass over the fact.
    checked = f
    for key, dim in dims:
        checked = checked.join(lookup_side(lost_keys(f, key, dim)), F.col(key) == F.col(f"_lf_lost_{key}"), "left")
    lost = F.filter(F.array(*[F.struct(F.lit(key).alias("foreign_key"), F.col(key).cast("long").alias("key_value"),
                                       (F.col(key).isNull() | F.col(f"_lf_lost_{key}").isNotNull()).alias("lost")) for key, _ in dims]),
                    lambda x: x["lost"])
    return (checked.select(*FACT_KEYS, F.explode(lost).alias("x"))
            .select(*FACT_KEYS, F.col("x.foreign_key").alias("foreign_key"), F.col("x.key_value").alias("key_value")))


def key_uniqueness(spark, d):
    """Primary-key check per Gold table: rows, distinct keys and NULL keys."""
    w = gold.warehouse(spark, d)
    tables = [(spec.name, w.dim(spec, 2), [spec.surrogate])
              for spec in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT)]
    tables.append(("fact_sales", w.fact(2), ["_tf_fact_sales_id"]))
    out = None
    for name, df, keys in tables:
        k = F.col(keys[0])
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(k).alias("n_keys"),
                     F.sum(k.isNull().cast("long")).alias("n_null_keys"),
                     F.sum((k == UNKNOWN_KEY).cast("long")).alias("n_unknown_members")) \
            .select(F.lit(name).alias("table_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def key_violations(spark, d):
    """Per Gold table the keys that occur more than once and the NULLs in
    columns that must have a value."""
    w = gold.warehouse(spark, d)
    tables = [(s.name, w.dim(s, 2), s.surrogate, s.natural_key) for s in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT)]
    tables.append(("fact_sales", w.fact(2), "_tf_fact_sales_id", "_tf_dim_calendar_id"))
    out = None
    for name, df, key, required in tables:
        twice = check_unique(df, [key]).agg(F.count(F.lit(1)).alias("n_repeated_keys"))
        nulls = check_not_null(df, [key, required]).select(
            F.coalesce(f"null_{key}", F.lit(0)).alias("n_null_keys"), F.coalesce(f"null_{required}", F.lit(0)).alias("n_null_required"))
        row = nulls.select(F.lit(name).alias("table_name"), twice.scalar().alias("n_repeated_keys"), "n_null_keys", "n_null_required")
        out = row if out is None else out.unionByName(row)
    return out


def calendar_orders(spark, d):
    """The calendar from 2000-01-01 to 2030-01-01 with the orders of each day."""
    per_day = (gold.warehouse(spark, d).bronze("sales_order_header").groupBy(F.col("OrderDate").cast("date").alias("day"))
               .agg(F.count(F.lit(1)).alias("n")))
    cal = gold.dim_calendar_range(spark)
    return (cal.join(per_day, cal["cal_date"] == per_day["day"], "left")
            .select(*cal.columns, F.coalesce("n", F.lit(0)).alias("n_orders")))


# --- DML emulation (M6–M9) on the day-1 Silver sources -----------------------------------
def dml_update(spark, d):
    """Discounted lines: quantity + 1, unit price × 1.1."""
    src = silver.silver_source(spark, d, "sales_order_detail", 1)
    return update_where(src, F.col("unit_price_discount") > 0,
                        {"order_qty": F.col("order_qty") + 1,
                         "unit_price": F.col("unit_price") * F.lit(1.1).cast("decimal(2,1)")})


def dml_delete(spark, d):
    """Addresses of one region removed (rows with an unknown predicate stay)."""
    src = silver.silver_source(spark, d, "address", 1)
    return delete_where(src, F.col("state_province") == "EUROPE")


def dml_rekey(spark, d):
    """Lines with a 10% discount move to detail id + 1000000."""
    src = silver.silver_source(spark, d, "sales_order_detail", 1)
    return rekey_where(src, F.col("unit_price_discount") == F.lit(0.1).cast("decimal(19,4)"),
                       "sales_order_detail_id", F.col("sales_order_detail_id") + 1000000)


INSERTED = ((-1, "1 Inserted Road", "Testville"), (-2, "2 Inserted Road", None))


def dml_insert_values(spark, d):
    """M9: two addresses inserted into the day-1 source."""
    src = silver.silver_source(spark, d, "address", 1).select("address_id", "address_line1", "city")
    return insert_values(src, list(INSERTED))


QUERIES = {
    "source_preview_city": source_preview_city,
    "key_violations": key_violations,
    "calendar_orders": calendar_orders,
    "dml_insert_values": dml_insert_values,
    "hist_updated_versions": hist_updated_versions,
    "hist_closed_deleted": hist_closed_deleted,
    "hist_rekeyed": hist_rekeyed,
    "hist_version_stats": hist_version_stats,
    "hist_duplicate_active": hist_duplicate_active,
    "hist_active_listing": hist_active_listing,
    "hist_as_of": hist_as_of,
    "hist_interval_overlaps": hist_interval_overlaps,
    "source_preview": source_preview,
    "star_category_preview": star_category_preview,
    "star_product_preview": star_product_preview,
    "star_product_category": star_product_category,
    "star_fact_product_category": star_fact_product_category,
    "fact_orphan_keys": fact_orphan_keys,
    "key_uniqueness": key_uniqueness,
    "dml_update": dml_update,
    "dml_delete": dml_delete,
    "dml_rekey": dml_rekey,
    "dml_insert_seed": gold.dml_insert_seed,
}
