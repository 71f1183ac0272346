import re
from collections import Counter

from lakeforge.llm import quality
from lakeforge.llm.queries import op5_quality_rules

from ..conftest import SF_SMALL
from .fixtures import frame, prose, rows, same, words


def measures(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines), w


def brute(data):
    out = []
    for d, text in data:
        n, chars, symbols, dup, repeat, lines, w = measures(text)
        base = n < 50 or 100 * repeat > 50 * n
        plain = sum(not any(c.isalpha() for c in x) for x in w)
        bad = 10 * symbols > 3 * n or (lines >= 4 and 2 * dup > lines) or not 2 * n <= chars <= 20 * n or 10 * plain > 4 * n
        out.append((d, n, chars, symbols, dup, repeat, base, not base and not bad))
    return out


def data():
    return rows() + [(700, prose(1, 90) + " # $ % & |" * 9), (701, "\n".join([prose(2, 30)] * 2 + [prose(3, 40)] * 3 + ["", " "])),
                     (702, " ".join(str(i) for i in range(99))), (703, " ".join("w" * 30 + str(i) for i in range(60))), (704, "a b c a b c a")]


def test_awkward_rows(spark):
    same(quality.measure(frame(spark, data())).collect(), brute(data()))


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    same(op5_quality_rules(spark, SF_SMALL).collect(), brute(docs))


def test_no_good_document_of_the_labels_goes(spark):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").filter("quality = 1")
    found = op5_quality_rules(spark, SF_SMALL).join(labels, "doc_id").filter("NOT base_failed")
    assert found.count() > 20 and found.filter("NOT kept").count() == 0


def test_empty_table_and_kept_rows(spark):
    empty = frame(spark).limit(0)
    assert quality.measure(empty).collect() == [] and quality.keep_good(empty).collect() == []
    kept = quality.keep_good(frame(spark, data()))
    assert kept.columns == frame(spark).columns
    good = [r[-1] for r in brute(data())]
    same([r[:2] for r in kept.collect()], [r for r, g in zip(data(), good) if g])


def test_order_is_rejections_per_cost_and_verdicts_do_not_depend_on_it():
    def slow(doc):
        for _ in range(20_000):
            pass
        return "bad" in doc.text

    rules = (quality.Rule("slow", slow), quality.Rule("never", lambda d: False), quality.Rule("fast", lambda d: "bad" in d.text))
    ordered = quality.order_rules(rules, ["bad", "good", "bad"] * 5)
    assert [r.name for r in ordered] == ["fast", "slow", "never"]
    for text in ("bad", "good"):
        assert quality.passes(quality.Doc(text), ordered) == quality.passes(quality.Doc(text), list(rules))
    calls = []
    noted = [quality.Rule(str(i), lambda d, i=i: calls.append(i) or i == 1) for i in range(3)]
    assert not quality.passes(quality.Doc("x"), noted) and calls == [0, 1]
