"""Layered run (W10): Bronze → Silver → dimensions → fact, stored.

Storage layout under ``root`` (a folder on the shared file system):

* ``bronze/<Table>/v=<n>``          full-refresh snapshot per run (S3/S4)
* ``silver/<table>/current/of=<b>/v=<n>``  buckets of the current versions that run n changed
* ``silver/<table>/closed/v=<n>``   versions closed by run n (append-only)
* ``gold/<dimension>/v=<n>``        dimension after run n
* ``gold/fact_sales/of=<b>/v=<n>``  buckets of the fact that run n changed

Silver history grows without bound while only current rows change, so a
load reads only the current part and writes only the buckets in which a row
changes (:mod:`lakeforge.sources.buckets`); closed history is appended once and
never rewritten (H4).  Every write is a new version recorded in the commit log
after its job succeeded (see :mod:`lakeforge.sources.snapshot`).

A layer's tables and the fact that it is done are logged together, so a run
that fails leaves the layers it has finished, and repeating it goes on after
them (W10).  Constraints are checked while a table is written; rows that break
one keep its layer from being committed (S12).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import CUSTOMER, GEOGRAPHY, ID, PRODUCT, PRODUCT_CATEGORY, SILVER, VALID_TO
from ..operators.merge import HASH, history_columns, number_first, number_new, scd2_opened, scd2_transitions
from ..operators.projection import to_silver
from ..operators.star import fact_sales_projection
from ..session import cut_lineage, ensure_checkpoint_dir, folder_stamp, owned_stages
from ..sources import snapshot as store
from ..sources.buckets import BUCKETS, BucketedTable
from ..sources.catalog import publish, withdraw
from ..sources.files import read_csv, write_csv
from ..sources.fixtures import snapshot as fixture_snapshot
from . import gold, silver


def new_root(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder for a run inside the cluster's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/lakeforge-{name}-{uuid.uuid4().hex[:12]}"


def silver_current(st: store.Store, table: str) -> DataFrame:
    """Current versions of a Silver table."""
    return BucketedTable(st, f"silver/{table}/current").read().drop(HASH)


def silver_history(st: store.Store, table: str) -> DataFrame:
    """Whole Silver history: every closed part plus the current part."""
    cur = silver_current(st, table)
    paths = [p for _, p, n in st.all_versions(f"silver/{table}/closed") if n > 0]
    if not paths:
        return cur
    return st.spark.read.schema(cur.schema).parquet(*paths).unionByName(cur)


def load_silver(st: store.Store, table: str, bronze: DataFrame, load_date, buckets: int = BUCKETS) -> None:
    """SCD2 load into the split layout: newly closed versions are appended,
    the buckets of the current part that hold a change are written anew; closed
    history is not read or rewritten (only its largest id, from the log)."""
    spec = SILVER[table]
    src = to_silver(bronze, spec)
    keys, data_cols, cols = list(spec.keys), list(src.columns), history_columns(list(src.columns))
    current = BucketedTable(st, f"silver/{table}/current", buckets)
    closed_t, target = f"silver/{table}/closed", current.read()
    start = st.max_key(current.table, closed_t)
    if target is None:
        rows = scd2_opened(number_first(src, keys, ID, start), keys, load_date)
    else:
        merged = cut_lineage(scd2_transitions(target, src, keys, list(spec.tracked), load_date, buckets=current.buckets))
        st.write(merged.filter(F.col(VALID_TO).isNotNull()).select(*cols), closed_t, key=ID)
        rows = merged.filter(F.col(ID).isNotNull()).unionByName(number_new(merged, keys, data_cols, ID, start))
    current.apply(rows, F.col(VALID_TO).isNull(), ID, cols)


def _concurrently(steps: list) -> None:
    """Run independent steps (each its own Spark jobs) from several driver
    threads; the scheduler interleaves their tasks."""
    with ThreadPoolExecutor(max_workers=min(8, len(steps))) as pool:
        for f in [pool.submit(copy_context().run, s) for s in steps]:
            f.result()


def run_day(spark: SparkSession, d: str, root: str, day: int, buckets: int = BUCKETS) -> None:
    """One scheduled run for the fixture snapshot of ``day``, layer by layer;
    each layer is committed once all its tables are written, and a layer that an
    earlier attempt has committed is not run again.  Its stage tables go when it
    ends."""
    st = store.Store(spark, root)
    try:
        with owned_stages(spark):
            for layer, load in LAYERS:
                step = f"run/day={day}/{layer}"
                if not st.has(step):
                    load(st, d, day, buckets)
                    st.commit(step)
    finally:
        st.forget()


def load_bronze(st: store.Store, d: str, day: int, buckets: int) -> None:
    """Full refresh; tables are independent, so their jobs overlap."""
    _concurrently([lambda t=t: st.write(fixture_snapshot(st.spark, d, t, day), f"bronze/{t}") for t in SILVER])


def load_silver_layer(st: store.Store, d: str, day: int, buckets: int) -> None:
    """SCD2 loads; tables are independent of each other."""
    _concurrently([lambda t=t: load_silver(st, t, st.read(f"bronze/{t}"), silver.LOADS[day], buckets) for t in SILVER])


def not_null(*columns: str) -> dict:
    """Checks that columns have a value."""
    return {f"{c} is NULL": F.col(c).isNull() for c in columns}


def load_dimensions(st: store.Store, d: str, day: int, buckets: int) -> None:
    """SCD1 upserts; the product dimension waits for the category dimension."""
    def upsert(spec, src):
        name = f"gold/{spec.name}"
        prev = st.read(name) if st.has(name) else gold.seeded_dim(st.spark, spec)
        out = gold.upsert_dim(prev, src, spec, silver.LOADS[day], start=st.latest_max_key(name))
        st.write(out, name, key=spec.surrogate, checks=not_null(spec.surrogate, spec.natural_key))

    _concurrently([
        lambda: upsert(GEOGRAPHY, gold.geography_source(silver_current(st, "address"))),
        lambda: upsert(CUSTOMER, gold.customer_source(silver_current(st, "customer"))),
        lambda: upsert(PRODUCT_CATEGORY, gold.category_source(silver_current(st, "product_category")))])
    upsert(PRODUCT, gold.product_source(silver_current(st, "product"), silver_current(st, "product_model"),
                                        st.read(f"gold/{PRODUCT_CATEGORY.name}")))


def load_fact(st: store.Store, d: str, day: int, buckets: int) -> None:
    dims = {s.surrogate: st.read(f"gold/{s.name}") for s in (CUSTOMER, GEOGRAPHY, PRODUCT)}
    proj = fact_sales_projection(*(silver_current(st, t) for t in ("sales_order_detail", "sales_order_header", "customer", "address")),
                                 *dims.values())
    gold.upsert_fact(st, "gold/fact_sales", proj, silver.LOADS[day], buckets, dims)


#: The layers of a run in their order.
LAYERS = (("bronze", load_bronze), ("silver", load_silver_layer), ("dimensions", load_dimensions), ("fact", load_fact))


def content(df: DataFrame, layer: str, name: str) -> DataFrame:
    """One row: layer, table, row count and a checksum of all values (binary
    columns apart) that does not depend on the order of rows."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c, t in sorted(df.dtypes) if t != "binary"]
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 8), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(digest), F.lit(0)).alias("checksum")).select(
        F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows", "checksum")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_ROOTS: dict = {}


def two_days(spark: SparkSession, d: str) -> str:
    """A store after two scheduled runs (day 1, day 2), run once per session
    and data folder."""
    key, stamp = (spark.sparkContext.applicationId, id(spark), d), folder_stamp(spark, d)
    if _ROOTS.get(key, (None,))[0] != stamp:
        root = new_root(spark)
        for day in (1, 2):
            run_day(spark, d, root, day)
        _ROOTS[key] = stamp, root
    return _ROOTS[key][1]


GOLD = [s.name for s in (GEOGRAPHY, CUSTOMER, PRODUCT_CATEGORY, PRODUCT)] + ["fact_sales"]


def layered_run(spark: SparkSession, d: str) -> DataFrame:
    """Two scheduled runs into a fresh store; rows and checksum of every stored
    table after the second run (Silver: whole history)."""
    st = store.Store(spark, two_days(spark, d))
    parts = [content(st.read(f"bronze/{t}"), "bronze", t) for t in SILVER]
    parts += [content(silver_history(st, t), "silver", t) for t in SILVER]
    parts += [content(st.read(f"gold/{n}"), "gold", n) for n in GOLD[:-1]]
    out = cut_lineage(_union(parts + [content(gold.fact_history(st), "gold", "fact_sales")]))
    st.forget()
    return out


def catalog_tables(spark: SparkSession, d: str) -> DataFrame:
    """The tables of the layered run read by name from the databases of their
    layers (S3, S5, S8): rows and checksum of each.  The names go at the end."""
    prefix = f"lakeforge_{uuid.uuid4().hex[:8]}_"
    try:
        publish(store.Store(spark, two_days(spark, d)), prefix)
        names = [(layer, t) for layer in ("bronze", "silver") for t in SILVER] + [("gold", n) for n in GOLD]
        return cut_lineage(_union([content(spark.table(f"{prefix}{layer}.{t}"), layer, t) for layer, t in names]))
    finally:
        withdraw(spark, prefix)


def write_checks(spark: SparkSession, d: str) -> DataFrame:
    """S12 at load: the rows that were seen to break each constraint while the
    dimensions and the fact of day 1 were written (columns without a value, keys
    without a row in their dimension), and whether the table was committed.
    Orders before 2000 have no day in the fixed calendar (G10), so that
    constraint keeps the fact out."""
    w = gold.warehouse(spark, d)
    st = store.Store(spark, new_root(spark, "checks"))
    specs = (GEOGRAPHY, CUSTOMER, PRODUCT)
    for spec in specs:
        st.write(w.dim(spec, 1), f"gold/{spec.name}", key=spec.surrogate, checks=not_null(spec.surrogate, spec.natural_key))
    dims = {"_tf_dim_calendar_id": gold.dim_calendar_range(spark)} | {s.surrogate: st.read(f"gold/{s.name}") for s in specs}
    try:
        gold.upsert_fact(st, "gold/fact_sales", w.fact_projection(1), silver.LOADS[1], dims=dims)
    except store.ConstraintViolation:
        pass  # shown by `committed`
    st.commit()
    rows = [(t.removeprefix("gold/"), c, n, st.has(t)) for t, c, n in st.observed]  # a row per constraint
    return spark.createDataFrame(rows, "table_name string, constraint string, n_rows long, committed boolean")


def bronze_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Full-refresh copies of the ten source tables (day 1), read back: rows
    and checksum per stored table."""
    root = new_root(spark, "bronze")
    st = store.Store(spark, root)
    for table in SILVER:
        st.write(fixture_snapshot(spark, d, table, 1), f"bronze/{table}")
    st.commit()
    return _union([content(store.read_version(spark, root, f"bronze/{t}"), "bronze", t) for t in SILVER])


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Day-1 address source written as CSV with a header and read back with
    its contract schema (CSV sink S7 + scan S6)."""
    src = fixture_snapshot(spark, d, "address", 1)
    path = new_root(spark, "csv") + "/address_csv"
    write_csv(src, path)
    return read_csv(spark, path, src.schema)


def csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    """Products written as CSV and read back with inferred types."""
    src = gold.warehouse(spark, d).bronze("product").select("ProductID", "Name", "ListPrice", "Size")
    path = new_root(spark, "csv") + "/product_csv"
    write_csv(src, path)
    return read_csv(spark, path)


QUERIES = {
    "bronze_snapshot": bronze_snapshot,
    "catalog_tables": catalog_tables,
    "csv_inferred": csv_inferred,
    "csv_round_trip": csv_round_trip,
    "layered_run": layered_run,
    "write_checks": write_checks,
}
