"""DML emulation on DataFrames (M6–M9): a changed copy of the frame, which
the caller stores as the next version of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pred(predicate) -> Column:
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def update_where(df: DataFrame, predicate, assignments: dict) -> DataFrame:
    """``UPDATE df SET col = expr, ... WHERE predicate``; a NULL predicate
    leaves the row unchanged.  Expressions see the *old* row and keep the
    column's type."""
    cond = F.coalesce(_pred(predicate), F.lit(False))
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in assignments:
            e = assignments[c]
            e = F.expr(e) if isinstance(e, str) else e
            out.append(F.when(cond, e.cast(types[c])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """``DELETE FROM df WHERE predicate``: rows with an unknown predicate stay."""
    return df.filter(~F.coalesce(_pred(predicate), F.lit(False)))


def rekey_where(df: DataFrame, predicate, key: str, new_key) -> DataFrame:
    """Change the key of matching rows (M8); downstream this is a delete of
    the old key and an insert of the new one."""
    return update_where(df, predicate, {key: new_key})


def insert_values(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """``INSERT INTO df VALUES ...`` (M9)."""
    return df.unionByName(df.sparkSession.createDataFrame(rows, df.schema))
