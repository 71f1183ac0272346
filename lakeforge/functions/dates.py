"""Date helpers: timestamps, smart date key (W8), calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value) -> Column:
    """A load time as TIMESTAMP_NTZ (string literal or Column)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_key(c: Column) -> Column:
    """Smart date key ``10000*year + 100*month + day`` (INT)."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
