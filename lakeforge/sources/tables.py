"""Parquet table scans of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan ``<sf_dir>/<name>.parquet``; naming the columns lets the scan's
    ReadSchema carry only those (Catalyst would prune anyway, this keeps
    intent visible)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register every given table as a temp view (S14) for SQL use."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
