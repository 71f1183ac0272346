"""Connected components of an edge table by alternating large-star and
small-star steps.  Each step is a grouped minimum and a join, so a hub with
very many edges is spread over tasks; edges are stored after every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, store


def _with_least(edges: DataFrame, least: DataFrame) -> tuple[DataFrame, str]:
    """edges (u, v) with m, the least of each u.  The minima are stored first,
    so that the join has a shuffle of its own, whose hot keys Spark splits."""
    stored, path = store(least, "least")
    return edges.join(stored, "u"), path


def _large_star(edges: DataFrame) -> tuple[DataFrame, str]:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined, path = _with_least(both.filter("v > u"), least)
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), path


def _small_star(edges: DataFrame) -> tuple[DataFrame, str]:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined, path = _with_least(down, down.groupBy("u").agg(F.min("v").alias("m")))
    moved = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return moved.distinct(), path


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected(edges: DataFrame) -> tuple[DataFrame, str]:
    """edges (u, v) to (node, component) with the least node of each
    component, for nodes that aren't the least of theirs; and the folder of
    the stored table that the result reads."""
    spark = edges.sparkSession
    pairs = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v").distinct()
    current, path = store(pairs, "edges")
    before = _state(current)
    while before[0]:
        done = [path]
        for star in (_large_star, _small_star):
            made, least = star(current)
            current, path = store(made, "edges")
            done += [least, path]
        for old in done[:-1]:
            drop_stored(spark, old)
        after = _state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")), path
