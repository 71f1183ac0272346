import pytest
from pyspark.sql import functions as F

from lakeforge.llm import urls
from lakeforge.llm.queries import op2_url_filter, url_rules

from ..conftest import SF_SMALL
from .fixtures import same

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
URLS = [None, "", "no scheme", "://", "http://", "https://COM/", "https://a.B.Example.COM/en/1?x#y", "http://www.example.com/en/", "http://x.www.example.com/en/z",
        "http://example.com/en", "http://example.com", "http://notexample.com/en/", "ftp://a.net/es/", "http://net/fr/?q", "http://b.net/de/", "http://net./es/", "http://.com/",
        "a://b://c.com/x", "http://com\n/x", "http://É.com/É/", "http://a.com?x=/y", "http://a.com#/", "x" * 3000 + "://a.com/" + "y" * 3000, "http://a..com/"]


def brute(url, rules):
    url = url or ""
    at = url.find("://")
    rest = url[at + 3:] if at >= 0 else ""
    host = rest[: min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])]
    path = rest[len(host):]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, None, "allow")
    return host, path, best[1], best[2]


def test_awkward_urls(spark):
    data = [(i, u) for i, u in enumerate(URLS)] + [(3, "http://a.net/es/"), (None, "http://a.net/es/")] * 2
    pages = spark.createDataFrame([(i, u, "h", 1, "k") for i, u in data], "page_id long, url string, host string, row int, key string").repartition(3)
    same(urls.judge(pages, url_rules(spark)).collect(), [(i, *brute(u, RULES)) for i, u in data])
    assert urls.judge(pages.limit(0), url_rules(spark)).collect() == []


def test_many_rules_ties_and_nulls(spark):
    rules = [(f"h{i % 97}.org", f"/p{i}", "block" if i % 3 else "allow") for i in range(3000)] + [(None, "/", "block"), ("x.org", None, "block"), ("q.org", "", "block")]
    table = spark.createDataFrame(rules + rules[:10], "host string, path string, verdict string")
    data = [(i, f"http://s.h{i % 97}.org/p{i}/x") for i in range(0, 3600, 7)] + [(9999, "http://q.org")]
    found = urls.judge(spark.createDataFrame(data, "page_id long, url string"), table)
    same(found.collect(), [(i, *brute(u, rules)) for i, u in data])
    assert urls.judge(spark.createDataFrame(data, "page_id long, url string"), table.limit(0)).filter("verdict = 'allow'").count() == len(data)


@pytest.mark.parametrize("blocks", [16, 4096])
def test_filter_has_every_key_and_few_others(spark, blocks):
    keys = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"))
    others = spark.range(500, 5000).select(F.concat(F.lit("k"), "id").alias("key"))
    words = urls.filter_words(keys, blocks).scalar()
    hit = F.get(words, urls.block_of(F.col("key"), blocks)).bitwiseAND(urls.bits_of(F.col("key"))) == urls.bits_of(F.col("key"))
    assert keys.filter(hit).count() == 500
    assert blocks == 16 or others.filter(hit).count() < 300


def test_given_pages(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url").collect()]
    found = op2_url_filter(spark, SF_SMALL)
    same(found.collect(), [(i, *brute(u, RULES)) for i, u in pages])
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
