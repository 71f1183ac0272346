"""Change predicates of the merges (P7) and key-null tests."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(cols: list[str]) -> Column:
    return functools.reduce(lambda x, y: x | y, [F.col(c).isNull() for c in cols])


def q(name: str) -> str:
    """Backtick-quote a column name for SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def any_changed_sql(pairs: list[tuple[str, str]], null_safe: bool = False) -> str:
    """SQL text of the OR over per-column differences of (left, right) column
    names, never NULL.

    Null-blind (default, as the warehouse's ``a != b`` chain): a NULL on
    either side makes that term unknown, so a change to or from NULL alone is
    not detected.  ``null_safe=True`` uses ``NOT (a <=> b)``.
    """
    if not pairs:
        return "false"
    if null_safe:
        terms = [f"NOT ({q(a)} <=> {q(b)})" for a, b in pairs]
    else:
        terms = [f"{q(a)} != {q(b)}" for a, b in pairs]
    return "coalesce(" + " OR ".join(terms) + ", false)"
