"""Registered queries of this subpackage: thin wrappers that run an operator
with production parameters over a whole table and derive the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import bpe, decontam, hnsw, lines, quality, secrets, simhash, substrings, suffix_dedup, token_files, trie, urls, whitening
from .common import documents, new_path

# The rules of the URL query's contract.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def url_rules(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return spark.sql(f"SELECT host, path, verdict FROM VALUES {rows} AS rules(host, path, verdict)")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.deduplicate(documents(spark, sf_dir), min_words=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "longest_repeat")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages", "page_id", "url"), url_rules(spark))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write(documents(spark, sf_dir), path, tokenizer_file("byte_bpe_50k.json"), end=0)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(documents(spark, sf_dir))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(documents(spark, sf_dir))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.deduplicate(documents(spark, sf_dir).select("doc_id", "text"), min_lines=1)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.deduplicate(documents(spark, sf_dir), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=8)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return hnsw.search(rows, rows.filter("vec_id % 20 = 0"), k=20)


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_url_filter, op3_token_files, op4_bpe, op5_quality_rules, op6_secret_scan, op7_line_dedup, op8_decontamination,
                                   op9_simhash, op10_suffix_dedup, op11_embedding_whitening, op12_conversation_trie, op13_nearest_neighbours)}
