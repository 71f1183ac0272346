import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeforge.llm import suffix_dedup
from lakeforge.llm.queries import op10_suffix_dedup

from ..conftest import SF_SMALL
from .fixtures import frame, rows, same


def brute(data, n=200):
    raw = [(d, (t or "").encode()) for d, t in data]
    seen = Counter(t[i:i + n] for _, t in raw for i in range(len(t) - n + 1))
    out = []
    for d, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((d, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def digest(df):
    return df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()


@pytest.mark.parametrize("hot_rows", [suffix_dedup.HOT_ROWS, 1])
def test_awkward_rows(spark, hot_rows):
    same(digest(suffix_dedup.deduplicate(frame(spark), hot_rows=hot_rows)), brute(rows()))


def test_other_lengths_and_hot_passage(spark):
    data = [(i, f"start{i * 7919} " + "common words that everyone copies again and again; " * 2 + f"end{i * 104729} of it") for i in range(200)]
    for length, hot in ((20, 10**6), (20, 30), (33, 10**6)):
        same(digest(suffix_dedup.deduplicate(frame(spark, data), length=length, hot_rows=hot)), brute(data, length))


def test_empty_table_and_empty_texts(spark):
    assert suffix_dedup.deduplicate(frame(spark, [(1, "x")]).limit(0)).collect() == []
    same(digest(suffix_dedup.deduplicate(frame(spark, [(1, None), (2, "")]))), brute([(1, None), (2, "")]))


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    same(op10_suffix_dedup(spark, SF_SMALL).collect(), brute(docs))


def test_windows_of_long_texts_are_listed_once(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 100, n, dtype=np.uint8).tobytes() for n in (5000, 10, 40, 700, 0, 2048)]
    whole = suffix_dedup.anchors(texts, 40, 20)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 512)
    cut = suffix_dedup.anchors(texts, 40, 20)

    def windows(found):
        return sorted((k, a + j, int(key)) for k, a, c, key in zip(*found) for j in range(c))

    assert windows(whole) == windows(cut)
    assert [w[:2] for w in windows(whole)] == [(k, i) for k, t in enumerate(texts) for i in range(len(t) - 39)]
