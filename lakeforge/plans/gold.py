"""Gold layer: calendar (W1), SCD1 dimensions (W2–W5), fact."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import (CREATE_DATE, CUSTOMER, FACT_COLUMNS, FACT_COMPARED, FACT_KEYS, FACT_SURROGATE,
                         GEOGRAPHY, PRODUCT, PRODUCT_CATEGORY, SILVER, UNKNOWN_KEY, UNKNOWN_TEXT,
                         UPDATE_DATE, VALID_TO, DimSpec)
from ..functions.dates import date_key, ts_lit
from ..operators.hierarchy import flatten_categories
from ..operators.keys import AGAIN, PLACE, RANGE
from ..operators.merge import HASH, by_key, number_first, number_new, scd1_merged, scd1_upsert, store_by_key
from ..operators.projection import conform
from ..operators.star import fact_sales_projection, lookup_side, lost_keys
from ..session import cut_lineage, ensure_checkpoint_dir, folder_stamp, last_stage, owned_stages, stored
from ..sources import snapshot as store
from ..sources.buckets import BUCKETS, BucketedTable
from ..sources.fixtures import D1, day2_snapshot, dealt_snapshot
from ..sources.tables import read_table
from . import silver

INIT_TIME = D1  # time the unknown members are seeded
CAL_START, CAL_END = "2000-01-01", "2030-01-01"


# --- calendar ---------------------------------------------------------------------
def calendar_from_dates(days: DataFrame, date_col: str, load_date) -> DataFrame:
    """Calendar attributes for a frame of distinct dates."""
    d = F.col(date_col)
    week_start = F.date_sub(d, F.weekday(d))
    t = ts_lit(load_date)
    return days.select(
        date_key(d).alias("_tf_dim_calendar_id"),
        d.alias("cal_date"),
        F.year(d).alias("cal_year"),
        F.month(d).alias("cal_month"),
        F.dayofmonth(d).alias("calendar_day_of_month"),
        F.date_format(d, "EEEE MMMM dd yyyy").alias("cal_date_full"),
        F.date_format(d, "EEEE").alias("cal_day_name"),
        week_start.alias("cal_week_start"),
        F.date_add(week_start, 6).alias("cal_week_end"),
        (F.weekday(d) + 1).alias("cal_week_day"),
        F.weekofyear(d).alias("cal_week_of_year"),
        F.date_format(d, "MMMM yyyy").alias("cal_month_year"),
        F.date_format(d, "MMMM").alias("cal_month_name"),
        F.trunc(d, "MM").alias("cal_first_day_of_month"),
        F.last_day(d).alias("cal_last_day_of_month"),
        F.quarter(d).alias("cal_fiscal_quarter"),
        F.year(F.date_add(d, 89)).alias("cal_fiscal_year"),
        t.alias(CREATE_DATE), t.alias(UPDATE_DATE))


def dim_calendar_range(spark: SparkSession, start: str = CAL_START, end: str = CAL_END,
                       load_date=INIT_TIME) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (10,959 rows for
    the default range).  Rows are generated by a ranged ``spark.range`` over
    the day offsets, so they are spread over tasks, not exploded in one."""
    n_days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days
    days = spark.range(0, n_days + 1).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("d"))
    return calendar_from_dates(days, "d", load_date)


def dim_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Calendar spanning the order dates of the given data: from 1 January
    of the first order year to the later of 2030-01-01 and the last order."""
    o = read_table(spark, d, "orders", "o_orderdate")
    bounds = o.agg(F.make_date(F.year(F.min("o_orderdate")), F.lit(1), F.lit(1)).alias("s"),
                   F.greatest(F.to_date(F.max("o_orderdate")), F.lit(CAL_END).cast("date")).alias("e"))
    days = bounds.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return calendar_from_dates(days, "d", INIT_TIME)


# --- dimensions ---------------------------------------------------------------------
def seed_row(spec: DimSpec) -> dict:
    """Unknown member: key -9, natural id 0, text 'N/A', numbers 0, FKs -9."""
    row = {spec.surrogate: UNKNOWN_KEY, spec.natural_key: 0}
    for c, _, default in spec.attributes:
        row[c] = default
    return row


def seeded_dim(spark: SparkSession, spec: DimSpec) -> DataFrame:
    """The dimension as initialised: only its unknown-member row."""
    row = seed_row(spec)
    t = ts_lit(INIT_TIME)
    cols = [F.lit(row[spec.surrogate]).cast("long").alias(spec.surrogate),
            F.lit(0).cast("int").alias(spec.natural_key)]
    cols += [F.lit(default).cast(typ).alias(c) for c, typ, default in spec.attributes]
    return spark.range(1).select(*cols, t.alias(CREATE_DATE), t.alias(UPDATE_DATE))


def geography_source(address_history: DataFrame) -> DataFrame:
    cur = address_history.filter(F.col(VALID_TO).isNull())
    return conform(cur, [("address_id", "geo_address_id", "int", None)] + [
        (src, dst, "string", UNKNOWN_TEXT) for src, dst in zip(
            ["address_line1", "address_line2", "city", "state_province", "country_region",
             "postal_code"], GEOGRAPHY.compared)])


def customer_source(customer_history: DataFrame) -> DataFrame:
    cur = customer_history.filter(F.col(VALID_TO).isNull())
    return conform(cur, [("customer_id", "cust_customer_id", "int", None)] + [
        (src, dst, "string", UNKNOWN_TEXT) for src, dst in zip(
            ["title", "first_name", "middle_name", "last_name", "suffix", "company_name",
             "sales_person", "email_address", "phone"], CUSTOMER.compared)])


def category_source(category_history: DataFrame) -> DataFrame:
    return flatten_categories(category_history.filter(F.col(VALID_TO).isNull()))


def product_source(product_history: DataFrame, model_history: DataFrame,
                   dim_category: DataFrame) -> DataFrame:
    p = product_history.filter(F.col(VALID_TO).isNull())
    pm = (model_history.filter(F.col(VALID_TO).isNull())
          .select(F.col("product_model_id").alias("_lf_mid"), F.col("name").alias("_lf_mname"),
                  F.col("catalog_description").alias("_lf_mdesc")))
    cat = dim_category.select(F.col("prod_cat_category_id").alias("_lf_cid"),
                              "_tf_dim_product_category_id")
    j = (p.join(pm, p.product_model_id == pm._lf_mid, "left")
         .join(lookup_side(cat), p.product_category_id == cat._lf_cid, "left"))

    def c(src: str, typ: str, default) -> Column:
        return F.coalesce(F.col(src).try_cast(typ), F.lit(default).cast(typ))

    return j.select(
        F.col("product_id").cast("int").alias("prod_product_id"),
        c("name", "string", UNKNOWN_TEXT).alias("prod_name"),
        c("product_number", "string", UNKNOWN_TEXT).alias("prod_product_number"),
        c("color", "string", UNKNOWN_TEXT).alias("prod_color"),
        c("standard_cost", "decimal(19,4)", 0).alias("prod_standard_cost"),
        c("list_price", "decimal(19,4)", 0).alias("prod_list_price"),
        c("size", "string", UNKNOWN_TEXT).alias("prod_size"),
        c("weight", "decimal(19,4)", 0).alias("prod_weight"),
        c("_tf_dim_product_category_id", "bigint", UNKNOWN_KEY).alias("_tf_dim_product_category_id"),
        c("product_model_id", "int", 0).alias("prod_product_model_id"),
        c("_lf_mname", "string", UNKNOWN_TEXT).alias("prod_product_model_name"),
        c("_lf_mdesc", "string", UNKNOWN_TEXT).alias("prod_product_model_catalog_description"))


def upsert_dim(target: DataFrame, source: DataFrame, spec: DimSpec, load_date,
               start: int | None = None) -> DataFrame:
    return scd1_upsert(target, source, spec.natural_key, spec.compared, spec.surrogate,
                       load_date, start=start)


class Warehouse:
    """Silver histories and Gold tables of the fixture run, computed once
    per (session, data folder) and stored between steps (each step's result
    is checkpointed, as the scheduled run stores its tables)."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d
        self._cache: dict = {}
        self._lock = threading.Lock()
        self.store = store.Store(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakeforge-warehouse-{uuid.uuid4().hex[:12]}")

    def _memo(self, key, fn):
        """Build ``key`` once, also when several threads ask for it."""
        with self._lock:
            fut = self._cache.get(key)
            owner = fut is None
            if owner:
                fut = self._cache[key] = Future()
        if owner:
            try:
                fut.set_result(fn())
            except BaseException as e:  # noqa: BLE001 - handed to every waiter
                with self._lock:
                    self._cache.pop(key, None)  # the next caller tries again
                fut.set_exception(e)
        return fut.result()

    def prefetch(self, *thunks) -> None:
        """Build independent steps concurrently: each is its own Spark job,
        and on a small input a job is mostly latency, so independent loads
        (the Silver tables do not depend on each other) overlap."""
        with ThreadPoolExecutor(max_workers=min(8, len(thunks))) as pool:
            for f in [pool.submit(t) for t in thunks]:
                f.result()

    def bronze(self, table: str, day: int = 1) -> DataFrame:
        """The source snapshot of ``day``: the first one stored, the second one
        a projection of it."""
        if day > 1:
            return day2_snapshot(self.bronze(table), table)
        return by_key(self._source(table)).drop(RANGE, PLACE, AGAIN)

    def _source(self, table: str) -> DataFrame:
        """The day-1 source, stored in ranges of its key: the first load numbers
        these and stores no copy."""
        def build():
            rows, dealt = dealt_snapshot(self.spark, self.d, table)
            return store_by_key(rows, SILVER[table].source_keys, dealt)
        return self._memo(("b", table), lambda: last_stage(self.spark, build))

    def history(self, table: str, day: int) -> DataFrame:
        def build():
            if day == 1:
                return silver.first_load(self._source(table), table, silver.LOADS[day])
            src, prev = silver.silver_source(self.spark, self.d, table, day), self.history(table, day - 1)
            return silver.load(prev, src, table, silver.LOADS[day])  # reads what the load stored
        return self._memo(("h", table, day), build)

    def dim(self, spec: DimSpec, day: int) -> DataFrame:
        def build():
            prev = seeded_dim(self.spark, spec) if day == 1 else self.dim(spec, day - 1)
            if spec is GEOGRAPHY:
                src = geography_source(self.history("address", day))
            elif spec is CUSTOMER:
                src = customer_source(self.history("customer", day))
            elif spec is PRODUCT_CATEGORY:
                src = category_source(self.history("product_category", day))
            else:
                src = product_source(self.history("product", day), self.history("product_model", day),
                                     self.dim(PRODUCT_CATEGORY, day))
            return stored(self.spark, lambda: upsert_dim(prev, src, spec, silver.LOADS[day]))
        return self._memo(("d", spec.name, day), build)

    def _prefetch_fact_inputs(self, day: int) -> None:
        steps = [lambda t=t, d=d: self.history(t, d)
                 for d in range(1, day + 1)
                 for t in ("sales_order_detail", "sales_order_header", "customer", "address",
                           "product", "product_model", "product_category")]
        self.prefetch(*steps)
        self.prefetch(*[lambda s=s: self.dim(s, day) for s in (CUSTOMER, GEOGRAPHY, PRODUCT)])

    def fact_projection(self, day: int) -> DataFrame:
        self._prefetch_fact_inputs(day)
        return fact_sales_projection(
            self.history("sales_order_detail", day), self.history("sales_order_header", day),
            self.history("customer", day), self.history("address", day),
            self.dim(CUSTOMER, day), self.dim(GEOGRAPHY, day), self.dim(PRODUCT, day))

    def fact(self, day: int) -> DataFrame:
        self._prefetch_fact_inputs(day)

        def build():
            if day > 1:
                self.fact(day - 1)
            projection = self.fact_projection(day)
            with owned_stages(self.spark):
                upsert_fact(self.store, "gold/fact_sales", projection, silver.LOADS[day])
            return fact_history(self.store)
        return self._memo(("f", day), build)


def fact_history(st: store.Store, name: str = "gold/fact_sales") -> DataFrame:
    """The fact as the last load left it."""
    return BucketedTable(st, name).read().drop(HASH)


def reference_checks(rows: DataFrame, dims: dict[str, DataFrame]) -> tuple[DataFrame, dict]:
    """``rows`` with a flag for each foreign key whose value no row of its
    dimension has, and the checks of those flags and of missing values."""
    checks, given = {}, rows
    for key, dim in dims.items():
        flag, lost = f"{store.CHECKED}{key}", f"_lf_lost_{key}"
        rows = rows.join(lookup_side(lost_keys(given, key, dim)), F.col(key) == F.col(lost), "left").withColumn(
            flag, F.col(lost).isNotNull()).drop(lost)
        checks[f"{key} has no row in its dimension"] = F.col(flag)
        checks[f"{key} is NULL"] = F.col(key).isNull()
    return rows, checks


def upsert_fact(st: store.Store, name: str, projection: DataFrame, load_date, buckets: int = BUCKETS,
                dims: dict[str, DataFrame] | None = None) -> None:
    """SCD1 upsert of the fact (M5): only the buckets in which a row is new or
    changed are written.  With ``dims``, the keys of the rows that are written
    must be in their dimensions."""
    fact = BucketedTable(st, name, buckets)
    keys, compared = list(FACT_KEYS), [c for c, _ in FACT_COMPARED]
    data_cols = keys + compared
    target, start = fact.read(), st.latest_max_key(name)
    source = number_first(projection.select(*data_cols), keys, FACT_SURROGATE, start) if target is None else projection
    merged = scd1_merged(target, source, keys, compared, FACT_SURROGATE, load_date, buckets=fact.buckets)
    if target is None:
        rows = merged
    else:
        merged = cut_lineage(merged)
        rows = merged.filter(F.col(FACT_SURROGATE).isNotNull()).unionByName(number_new(merged, keys, data_cols, FACT_SURROGATE, start))
    rows, checks = reference_checks(rows, dims or {})
    fact.apply(rows, F.lit(True), FACT_SURROGATE, FACT_COLUMNS, checks)


_WAREHOUSES: dict = {}


def warehouse(spark: SparkSession, d: str) -> Warehouse:
    """The warehouse of this session and data folder, built anew when the
    folder's files change."""
    key, stamp = (spark.sparkContext.applicationId, id(spark), d), folder_stamp(spark, d)
    if key not in _WAREHOUSES or _WAREHOUSES[key][0] != stamp:
        _WAREHOUSES[key] = stamp, Warehouse(spark, d)
    return _WAREHOUSES[key][1]


_DIM_INPUTS = {GEOGRAPHY.name: ("address",), CUSTOMER.name: ("customer",),
               PRODUCT_CATEGORY.name: ("product_category",),
               PRODUCT.name: ("product", "product_model", "product_category")}


def _dim_query(spec: DimSpec):
    def query(spark, d):
        w = warehouse(spark, d)
        w.prefetch(*[lambda t=t, day=day: w.history(t, day)
                     for day in (1, 2) for t in _DIM_INPUTS[spec.name]])
        return w.dim(spec, 2)
    return query


def fact_projection(spark, d):
    return warehouse(spark, d).fact_projection(2)


def fact_upsert(spark, d):
    return warehouse(spark, d).fact(2)


def dml_insert_seed(spark, d):
    """Seeds appended to each dimension as it is initialised (M9): the
    unknown-member rows of the four dimensions after the day-2 upsert."""
    w = warehouse(spark, d)
    parts = []
    for spec in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT):
        parts.append(w.dim(spec, 2).filter(F.col(spec.surrogate) == UNKNOWN_KEY)
                     .select(F.lit(spec.name).alias("dimension"),
                             F.col(spec.surrogate).alias("surrogate_key"),
                             F.col(spec.natural_key).alias("natural_key")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES = {
    "dim_calendar": dim_calendar,
    "dim_geography": _dim_query(GEOGRAPHY),
    "dim_customer": _dim_query(CUSTOMER),
    "dim_product_category": _dim_query(PRODUCT_CATEGORY),
    "dim_product": _dim_query(PRODUCT),
    "fact_projection": fact_projection,
    "fact_upsert": fact_upsert,
}

