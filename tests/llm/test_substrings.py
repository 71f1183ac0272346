import hashlib

from pyspark.sql import functions as F

from lakeforge.llm import substrings
from lakeforge.llm.queries import op1_substring_dedup

from ..conftest import SF_SMALL
from .fixtures import frame, key, rows, same, words


def brute(data, n=13):
    docs = [(d, words(t)) for d, t in data]
    first, holders = {}, {}
    for d, w in docs:
        for i in range(len(w) - n + 1):
            g = tuple(w[i:i + n])
            first[g] = min(first.get(g, key(d)), key(d))
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < key(d):
                gone.update(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def longest(data, n=13):
    docs = [(key(d), words(t)) for d, t in data]
    out = []
    for d, w in docs:
        best, size = 0, n
        while size <= len(w):
            holders = {}
            for e, x in docs:
                for i in range(len(x) - size + 1):
                    holders.setdefault(tuple(x[i:i + size]), set()).add(e)
            if not any(len(holders[tuple(w[i:i + size])]) > 1 for i in range(len(w) - size + 1)):
                break
            best, size = size, 2 * size
        out.append(best)
    return out


def digest(df):
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()


def test_awkward_rows(spark):
    same(digest(substrings.deduplicate(frame(spark))), brute(rows()))


def test_empty_table_and_no_words(spark):
    assert substrings.deduplicate(frame(spark, [(1, "x")]).limit(0)).collect() == []
    same(digest(substrings.deduplicate(frame(spark, [(1, None), (2, "")]))), brute([(1, None), (2, "")]))


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    same(op1_substring_dedup(spark, SF_SMALL).drop("longest_repeat").collect(), brute(docs))


def test_levels_reach_the_longest_repeat(spark):
    data = [(d, t) for d, t in rows() if t is None or len(t) < 2500]
    found = {(r["doc_id"], r["kept_text"], r["n_words"]): r["longest_repeat"] for r in substrings.deduplicate(frame(spark, data)).collect()}
    wanted = sorted(longest(data))
    assert max(wanted) >= 52 and set(found.values()) == set(wanted)


def test_shorter_windows_and_hot_passage(spark):
    data = [(i, f"start{i} " + "common words that everyone copies again and again " * 2 + f"end{i}") for i in range(300)]
    same(digest(substrings.deduplicate(frame(spark, data), min_words=5)), brute(data, 5))
