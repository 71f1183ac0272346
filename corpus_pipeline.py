"""A corpus pipeline of five operators over the `documents` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the docs of the next stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import bpe, decontam, lines, quality, simhash
from lakeforge.llm.common import documents, drop_stored, store
from lakeforge.llm.queries import tokenizer_file
from lakeforge.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs, single lines included, go from the
    texts; documents stay."""
    return lines.clean(docs, min_lines=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left, and the hash of the text
    decoded from them."""
    out = bpe.encode(docs, tokenizer_file("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("BPE encoding and decoding", tokens)]

#: SQL can express neither the fingerprints (XXH64) nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs, path = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs, new = store(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        if path:
            drop_stored(spark, path)
        path = new
    return STAGES[-1][1](spark, docs, sf_dir)
