"""Tables of embeddings: which rows take part, and their arrays in tasks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, int, int]:
    """(vec_id, vec) of the rows whose vector is not NULL and holds finite
    entries only, their number and their dimension.  A table has one dimension:
    its commonest vector length (the larger one of equally common); vectors of
    another length, and vectors without entries, take no part.  `vec_id` is a
    long and may be NULL or repeat; all other columns stay out."""
    kind = "array<float>" if rows.schema[embedding].dataType.simpleString() == "array<float>" else "array<double>"
    found = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast(kind).alias("vec"))
    found = found.filter(F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))) & (F.size("vec") > 0))
    # One row per length of a vector.
    size = found.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if size is None:
        return found, 0, 0
    return found.filter(F.size("vec") == size["dim"]), int(size["count"]), int(size["dim"])


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
