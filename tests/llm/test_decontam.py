import re

import pytest

from lakeforge.llm import decontam
from lakeforge.llm.queries import op8_decontamination
from lakeforge.sources.tables import read_table

from ..conftest import SF_SMALL
from .fixtures import frame, prose, rows, same


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    return re.findall("[a-z0-9\x80-\U0010ffff]+", low)


def grams(text, k=5):
    w = split(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items, t=0.8):
    out = []
    sizes = {i: min(5, len(split(item))) for i, (_, item) in enumerate(items)}
    for d, text in docs:
        have_at = {k: grams(text, k) for k in set(sizes.values()) if k}
        for at, (i, item) in enumerate(items):
            if not sizes[at]:
                continue
            want, have = grams(item, sizes[at]), have_at[sizes[at]]
            if i is not None and want and len(want & have) * 10 >= 10 * t * len(want) - 1e-6:
                out.append((d, i, len(want), len(want & have)))
    return out


def items():
    out = [(i, prose(50 + i, 6 + 7 * i)) for i in range(10)]
    return out + [(20, "too short item here"), (21, None), (None, prose(1, 60)), (22, ""), (23, prose(1, 60)), (24, "Same same SAME same, same! same")]


def docs():
    out = rows()
    for i, t in items()[:10]:
        w = t.split()
        out.append((900 + i, prose(70 + i, 500) + " " + t.upper().replace(" ", ", ") + ". " + prose(80 + i, 300)))
        out.append((950 + i, prose(70 + i, 90) + "\n" + " ".join(w[: len(w) * 9 // 10]) + "\n" + prose(80 + i, 9)))
        out.append((970 + i, " ".join(w[: len(w) // 2])))
    return out


def test_awkward_rows(spark):
    table = spark.createDataFrame(items(), "item_id long, text string").withColumn("doc_id", decontam.F.lit("x"))
    found = decontam.search(frame(spark, docs()), table)
    same(found.collect(), brute(docs(), items()))
    assert found.count() > 15
    several = decontam.search(frame(spark, docs()), table, largest_filter=64)
    same(several.collect(), brute(docs(), items()))


def test_clean_keeps_the_rest(spark):
    table = spark.createDataFrame(items(), "item_id long, text string")
    hit = {(d, t) for d, t in docs() if brute([(d, t)], items())}
    found = decontam.clean(frame(spark, docs()), table, largest_filter=64)
    assert found.columns == frame(spark).columns
    same([r[:2] for r in found.collect()], [r for r in docs() if r not in hit])


@pytest.mark.parametrize("which", ["docs", "items"])
def test_empty_tables(spark, which):
    table = spark.createDataFrame(items(), "item_id long, text string")
    d = frame(spark)
    assert decontam.search(d.limit(0) if which == "docs" else d, table.limit(0) if which == "items" else table).collect() == []


def test_given_documents(spark):
    d = [tuple(r) for r in read_table(spark, SF_SMALL, "documents", "doc_id", "text").collect()]
    i = [tuple(r) for r in read_table(spark, SF_SMALL, "benchmark", "item_id", "text").collect()]
    same(op8_decontamination(spark, SF_SMALL).collect(), brute(d, i))


def test_clean_drops_holders_of_items_without_id(spark):
    table = spark.createDataFrame([(None, prose(50, 40)), (None, None), (1, prose(51, 40))], "item_id long, text string")
    data = [(1, prose(70, 90) + " " + prose(50, 40)), (2, prose(71, 90)), (None, prose(51, 40)), (3, None)]
    for size in (decontam.LARGEST_FILTER, 1):
        same([r[:2] for r in decontam.clean(frame(spark, data), table, largest_filter=size).collect()], [data[1], data[3]])


def test_short_items(spark):
    short = [(1, "Lazy dog"), (2, "one"), (3, "?!"), (4, "nine small birds sing"), (5, "dog lazy"), (6, "a b c d e")]
    data = [(1, "a LAZY, dog sleeps"), (2, "lazy old dog"), (3, "nine small birds sing here"), (4, "One."), (5, ""), (6, None), (7, "a b c d")]
    table = spark.createDataFrame(short, "item_id long, text string")
    same(decontam.search(frame(spark, data), table).collect(), brute(data, short))
    same(brute(data, short), [(1, 1, 1, 1), (3, 4, 1, 1), (4, 2, 1, 1)])


def test_many_items_in_many_copies(spark):
    """A text that most rows hold, with more items than one chunk, and a
    passage that all items share."""
    shared = "this passage is part of every single item here"
    many = [(i, f"{prose(i, 9)} {shared}") for i in range(150)]
    crowd = " ".join(t for _, t in many)
    data = [(None if i % 3 else i, crowd) for i in range(40)] + [(100 + i, f"{shared} {prose(i, 9)}") for i in range(30)]
    table = spark.createDataFrame(many, "item_id long, text string")
    found = decontam.search(frame(spark, data), table).collect()
    same(found, brute(data, many))
    assert len(found) >= 40 * 150
    assert sorted(r[0] for r in decontam.clean(frame(spark, data), table).collect()) == sorted(
        d for d, t in data if not brute([(d, t)], many))


def test_same_hash_as_the_engine(spark):
    """The filter's words are filled in SQL and read in numpy."""
    keys = [0, 1, -1, 2**63 - 1, -2**63, 123456789123456789, -987654321987654321]
    words = decontam.key_filter(spark.createDataFrame([(k,) for k in keys], "key long"), 2**16)
    assert decontam.may_hold(words, decontam.np.array(keys, decontam.np.int64).view(decontam.np.uint64)).all()
    others = decontam.np.arange(1, 200, dtype=decontam.np.uint64) * decontam.np.uint64(0x9E3779B97F4A7C15)
    assert not decontam.may_hold(words, others).any()
