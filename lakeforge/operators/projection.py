"""Projections: renaming (P1) and conforming with defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import SilverTable
from ..functions.predicates import q


def rename(df: DataFrame, mapping: dict[str, str], types: dict[str, str] | None = None) -> DataFrame:
    """Select and rename ``source -> target`` columns, optionally casting to
    the target type; columns not in the mapping are dropped."""
    types = types or {}
    return df.selectExpr(*[
        (f"CAST({q(src)} AS {types[dst]}) AS {q(dst)}" if dst in types else f"{q(src)} AS {q(dst)}")
        for src, dst in mapping.items()])


def to_silver(df: DataFrame, spec: SilverTable) -> DataFrame:
    """Bronze (source names) → Silver column names and types."""
    return rename(df, spec.mapping, spec.types)


def conform(df: DataFrame, columns: list[tuple[str, str, str, object]]) -> DataFrame:
    """``COALESCE(TRY_CAST(src AS type), default) AS name`` per column;
    entries are (source column, name, type, default).  A default of None
    keeps the value as cast (no fallback)."""
    out = []
    for src, name, typ, default in columns:
        c = F.col(src).try_cast(typ)
        if default is not None:
            c = F.coalesce(c, F.lit(default).cast(typ))
        out.append(c.alias(name))
    return df.select(*out)
