"""Silver layer: config-driven SCD2 loads of the ten tables (M3) and the
queries that exercise them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import SILVER, VALID_TO
from ..operators.keys import AGAIN, PLACE, RANGE
from ..operators.merge import by_key, scd2_close, scd2_first, scd2_load, scd2_open
from ..operators.projection import rename, to_silver
from ..session import cut_lineage
from ..sources.fixtures import LOAD_1, LOAD_2

LOADS = {1: LOAD_1, 2: LOAD_2}
LOAD_3 = "2024-01-03 06:00:00"


def silver_source(spark: SparkSession, d: str, table: str, day: int) -> DataFrame:
    """Bronze snapshot of ``day`` renamed to Silver names and types."""
    from .gold import warehouse  # gold builds on this module
    return to_silver(warehouse(spark, d).bronze(table, day), SILVER[table])


def load(target: DataFrame | None, source: DataFrame, table: str, load_date,
         null_safe: bool = False) -> DataFrame:
    spec = SILVER[table]
    return scd2_load(target, source, spec.keys, spec.tracked, load_date, null_safe)


def first_load(ranged: DataFrame, table: str, load_date) -> DataFrame:
    """The first load of a source that is stored in ranges of its key."""
    spec = SILVER[table]
    technical = {c: c for c in (RANGE, PLACE, AGAIN)}
    return scd2_first(rename(by_key(ranged), spec.mapping | technical, spec.types), list(spec.keys), load_date)


def history(spark: SparkSession, d: str, table: str, days: int = 2,
            null_safe: bool = False) -> DataFrame:
    """Silver history after loading day 1 .. ``days`` into an empty table.
    A load's result reads the stage tables it has stored, as the scheduled run
    stores the table between loads, so the next load starts from stored data."""
    h = None
    for day in range(1, days + 1):
        src = silver_source(spark, d, table, day)
        h = load(h, src, table, LOADS[day], null_safe)
    return h


def active(spark: SparkSession, d: str, table: str, days: int = 2) -> DataFrame:
    """Current versions (P4) after ``days`` loads."""
    return history(spark, d, table, days).filter(F.col(VALID_TO).isNull())


def scd2_initial_address(spark, d):
    return _stored(spark, d, "address", 1)


def scd2_close_address(spark, d):
    spec = SILVER["address"]
    return scd2_close(history(spark, d, "address", 1), silver_source(spark, d, "address", 2),
                      spec.keys, spec.tracked, LOAD_2)


def scd2_open_address(spark, d):
    spec = SILVER["address"]
    src2 = silver_source(spark, d, "address", 2)
    closed = cut_lineage(scd2_close(history(spark, d, "address", 1), src2, spec.keys,
                                    spec.tracked, LOAD_2))
    return scd2_open(closed, src2, spec.keys, LOAD_2)


def scd2_noop_rerun(spark, d):
    """Loading the day-2 snapshot a second time changes nothing (G4: no NULL keys)."""
    h2 = _stored(spark, d, "address", 2)
    return load(h2, silver_source(spark, d, "address", 2), "address", LOAD_3)


def scd2_null_safe(spark, d):
    """Address history with the NULL-safe change test (NULL→value detected)."""
    return history(spark, d, "address", 2, null_safe=True)


def scd2_null_blind(spark, d):
    """The NULL-blind trap: active versions still NULL where the day-2 source
    has a value, and nothing else changed (G1)."""
    act = active(spark, d, "address", 2)
    src2 = silver_source(spark, d, "address", 2)
    return (act.alias("t").join(src2.alias("s"), "address_id")
            .filter(F.col("t.address_line2").isNull() & F.col("s.address_line2").isNotNull())
            .select("address_id", F.col("s.address_line2").alias("source_address_line2"),
                    F.col("t._tf_id").alias("_tf_id"), F.col("t._tf_valid_from").alias("_tf_valid_from")))


def _stored(spark, d, table, day):
    """The history after ``day`` loads, shared with the Gold builder (built
    once per session and data folder)."""
    from .gold import warehouse  # gold builds on this module
    return warehouse(spark, d).history(table, day)


def _full(table):
    return lambda spark, d: _stored(spark, d, table, 2)


QUERIES = {
    "scd2_initial_address": scd2_initial_address,
    "scd2_close_address": scd2_close_address,
    "scd2_open_address": scd2_open_address,
    **{f"scd2_{t}": _full(t) for t in SILVER},
    "scd2_noop_rerun": scd2_noop_rerun,
    "scd2_null_blind": scd2_null_blind,
    "scd2_null_safe": scd2_null_safe,
}
