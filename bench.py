"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}

The BI queries and the two ``scd2`` loads read stored Bronze tables, whose
storing is timed apart as ``bronze_tables``; ``scd2_reload_detail`` times the
day-2 load on top of a stored day-1 history.  The other queries start from a
cold warehouse (no stored intermediate results are reused between them), so
each of their timings includes all the work the query depends on.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeforge.plans import bi, gold, ml, silver  # noqa: E402
from lakeforge.session import cut_lineage, local_session  # noqa: E402


def _cold():
    gold._WAREHOUSES.clear()
    ml._MODELS.clear()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    def run(fn):
        return fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

    # warm-up: JVM start, code generation of the scans
    bi.bi_global_revenue(spark, sf_dir).collect()

    timings: dict[str, float] = {}

    def timed(name, thunk, cold=True):
        if cold:
            _cold()
        t0 = time.perf_counter()
        thunk()
        timings[name] = round(time.perf_counter() - t0, 3)

    # BI reads stored Bronze tables: storing them is timed apart.
    tables = ("product", "product_category", "customer", "address", "sales_order_header", "sales_order_detail")
    timed("bronze_tables", lambda: [gold.warehouse(spark, sf_dir).bronze(t) for t in tables] and
          gold.warehouse(spark, sf_dir).bronze("sales_order_detail", 2))
    for name, fn in bi.QUERIES.items():
        timed(name, lambda fn=fn: run(fn), cold=False)

    def first_load():
        return silver.history(spark, sf_dir, "sales_order_detail", days=1).count()

    timed("scd2_first_load_detail", first_load, cold=False)

    h1 = silver.history(spark, sf_dir, "sales_order_detail", days=1)

    def reload():
        src2 = silver.silver_source(spark, sf_dir, "sales_order_detail", 2)
        out = silver.load(h1, src2, "sales_order_detail", silver.LOADS[2])
        return cut_lineage(out).count()

    timed("scd2_reload_detail", reload, cold=False)
    timed("dim_product", lambda: run(gold.QUERIES["dim_product"]))
    timed("fact_projection", lambda: run(gold.fact_projection))
    timed("fact_upsert", lambda: run(gold.fact_upsert))
    timed("ml_pipeline_fit", lambda: run(ml.ml_tree_predict))

    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_queries_total_sec", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf}))


if __name__ == "__main__":
    main()
