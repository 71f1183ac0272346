"""URL filter: a blocked Bloom filter in front of an exact hash join.

Listed URLs are (host, path, verdict) rules.  A rule fits its host and all
subdomains when the URL's path starts with the rule's path; the longest rule
wins.  For each URL the candidate keys are its host suffixes times its path
prefixes of the lengths that occur in the list.  A blocked Bloom filter (one
64-bit block per key, `BITS` bits set in it) keeps the candidates that may be
listed; only those have a key in the exact join, which removes false positives.  URLs
without a fitting rule get the method's own verdict: `allow`, as they are not
listed.

All steps are DataFrame functions.  The filter has `blocks` words, a power of
two near twice the list's length and at most `MAX_BLOCKS` (8 MB); past that
the filter lets more candidates through and the join still decides.

NULL URLs and URLs without `://` have an empty host and path and no rule.
Repeated rows are judged one by one.  Rules with NULL host or path never fit;
of rules with the same host and path, `block` wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 5
MAX_BLOCKS = 2**20
#: Lists up to this length are joined by broadcast, longer ones by a shuffle.
BROADCAST_RULES = 100_000
#: ASCII letters only: the contract lower-cases A-Z and nothing else.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bits_of(key: Column) -> Column:
    """A word with the key's bits: six bits of one hash choose each of them."""
    h = F.xxhash64(key, F.lit(1))
    word = F.lit(0).cast("long")
    for k in range(BITS):
        word = word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"),
                                              F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return word


def filter_words(keys: DataFrame, blocks: int) -> DataFrame:
    """One row: the words of the filter by block, empty blocks as zero."""
    filled = (keys.select(block_of(F.col("key"), blocks).alias("block"), bits_of(F.col("key")).alias("bits"))
              .groupBy("block").agg(F.bit_or("bits").alias("bits")))
    every = keys.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"))
    rows = every.join(filled, "block", "left").select("block", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    ordered = rows.agg(F.array_sort(F.collect_list(F.struct("block", "bits"))).alias("rows"))
    return ordered.select(F.col("rows.bits").alias("words"))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages (page_id, url) and rules (host, path, verdict) to (page_id, host,
    path, rule, verdict), one row per page row."""
    listed = (rules.filter("host IS NOT NULL AND path IS NOT NULL")
              .groupBy("host", "path").agg(F.max(F.struct(F.col("verdict") == "block", "verdict")).alias("v"))
              .select(F.concat_ws("\n", "host", "path").alias("key"), F.concat("host", "path").alias("rule"),
                      F.col("v.verdict").alias("rule_verdict")))
    shape = rules.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("path")).alias("lengths")).first()
    blocks = min(MAX_BLOCKS, 1 << max(4, (2 * int(shape["n"])).bit_length()))
    words = filter_words(listed, blocks).scalar()

    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    parsed = (pages.select(F.col("page_id").alias("page_id"), url.alias("url"))
              .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("path", 1, n).alias("p"))
                                  for n in sorted({0, *(x for x in shape["lengths"] if x is not None)})]),
                        lambda x: F.length(x["p"]) == x["n"])
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat_ws("\n", s, p["p"]))))
    numbered = parsed.withColumn("row", F.monotonically_increasing_id())
    rows = numbered.select("row", "page_id", "host", "path", F.posexplode(keys).alias("at", "key"))
    possible = F.get(words, block_of(F.col("key"), blocks)).bitwiseAND(bits_of(F.col("key"))) == bits_of(F.col("key"))
    # Each URL's first candidate stays without its key, so that every row has a result.
    rows = (rows.withColumn("key", F.when(possible, F.col("key")))
            .filter((F.col("at") == 0) | F.col("key").isNotNull()))
    exact = F.broadcast(listed) if shape["n"] <= BROADCAST_RULES else listed
    joined = rows.join(exact, "key", "left")
    best = joined.groupBy("row", "page_id", "host", "path").agg(
        F.max(F.when(F.col("rule").isNotNull(),
                     F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("rule_verdict")))).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.rule_verdict", F.lit("allow")).alias("verdict"))
