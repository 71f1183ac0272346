"""All registered queries and their SQL oracles."""

from __future__ import annotations

from . import bi, checks, gold, ml, oracle, run, silver


def queries() -> dict:
    out = {}
    out.update(bi.QUERIES)
    out.update(silver.QUERIES)
    out.update(gold.QUERIES)
    out.update(checks.QUERIES)
    out.update(run.QUERIES)
    out.update(ml.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    out.update(oracle.BI_SQL)
    out.update(oracle.SILVER_SQL)
    out.update(oracle.GOLD_SQL)
    out.update(oracle.CHECKS_SQL)
    out.update(oracle.RUN_SQL)
    out.update(oracle.ML_SQL)
    return out
