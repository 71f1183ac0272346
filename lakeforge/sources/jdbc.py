"""JDBC sources.

``read_jdbc`` reads a whole table *in parallel*: given a numeric
partition column it issues ``num_partitions`` range queries (bounds taken
from one ``MIN/MAX`` query pushed to the database when not supplied),
instead of one single-connection scan.  ``register_jdbc_catalog`` exposes a
database as a Spark catalog (``catalog.schema.table``) for federated
queries without copying.  Credentials come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def partition_options(column: str, lower: int, upper: int, num_partitions: int) -> dict:
    """Options of a parallel JDBC read: ``num_partitions`` strides between the
    bounds (rows outside them still land in the first/last partition)."""
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    if upper < lower:
        lower, upper = upper, lower
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper + 1),
            "numPartitions": str(num_partitions)}


def key_bounds(spark: SparkSession, url: str, table: str, column: str,
               properties: dict | None = None) -> tuple[int | None, int | None]:
    """MIN and MAX of ``column``, computed by the database (one row back)."""
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    row = spark.read.jdbc(url, q, properties=properties or {}).first()
    return (row[0], row[1]) if row is not None else (None, None)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, *, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Whole-table JDBC scan (S1), parallel over ``partition_column`` in
    ``num_partitions`` ranges, which the caller sizes to the table."""
    if partition_column is not None and num_partitions is None:
        raise ValueError("num_partitions is required with a partition column")
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if lower is None or upper is None:
        lo, hi = key_bounds(spark, url, table, partition_column, props)
        if lo is None:  # empty table
            return spark.read.jdbc(url, table, properties=props)
        lower = lo if lower is None else lower
        upper = hi if upper is None else upper
    opts = partition_options(partition_column, int(lower), int(upper), num_partitions)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in {**props, **opts}.items():
        reader = reader.option(k, v)
    return reader.load()


def register_jdbc_catalog(spark: SparkSession, name: str, url: str, driver: str | None = None,
                          properties: dict | None = None) -> None:
    """Federated scan (S2): ``SELECT * FROM <name>.<schema>.<table>`` reads
    the database through Spark's JDBC table catalog, nothing is copied."""
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    spark.conf.set(f"{prefix}.url", url)
    if driver:
        spark.conf.set(f"{prefix}.driver", driver)
    for k, v in (properties or {}).items():
        spark.conf.set(f"{prefix}.{k}", v)
