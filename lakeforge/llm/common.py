"""Helpers shared by the operators of this subpackage: stored tables in the
shared folder, sizing from the input, and document-id conventions.

Document ids are integers.  A NULL id sorts after every other id and all NULL
ids count as one and the same document; rows are never dropped for it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import read_table

#: Stands for a NULL document id inside tasks (the largest 64-bit integer).
NULL_ID = 2**63 - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the two columns the operators work on, NULL text as
    empty.  All other columns of the input, whatever their names, stay out."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def with_null_ids(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """Turns the stand-in for a NULL id back into NULL."""
    return df.withColumn(name, F.when(F.col(name) != NULL_ID, F.col(name)))


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared checkpoint folder that nothing else uses."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakeforge-llm-{tag}-{uuid.uuid4().hex}"


#: Spark's setting that deletes the shuffle files of a query when it ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Writes ``df`` as a Parquet table in the shared checkpoint folder and
    reads it back: later jobs start there, also after an executor is lost.
    The shuffle files of the write go as soon as the table is complete."""
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, path: str) -> None:
    """Deletes a table that :func:`store` wrote and no later step reads."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def text_size(docs: DataFrame) -> tuple[int, int, int]:
    """(rows, bytes of all texts, bytes of the longest text) in one scan."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"),
                   F.max(F.octet_length("text")).alias("m")).first()
    return int(row["n"] or 0), int(row["b"] or 0), int(row["m"] or 0)


def sample(docs: DataFrame, rows: int, longest: int) -> DataFrame:
    """(text) of at most `rows` documents, those with the smallest hash of
    their id, without texts over `longest` bytes.  The ids are chosen first, so
    that no task hands on more than `rows` of them, and no texts."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    chosen = docs.filter(F.col("doc_id").isin([r["doc_id"] for r in ids]))
    return chosen.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).filter(F.octet_length("text") <= longest).limit(rows)
