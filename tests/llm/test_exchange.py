"""Ids that hold a large share of all rows, NULL among them."""

import pytest
from pyspark.sql import functions as F

from lakeforge.llm import exchange, lines, substrings, suffix_dedup
from lakeforge.llm.common import id_and_text

from . import test_lines, test_substrings, test_suffix_dedup
from .fixtures import frame, prose, rows, same


def crowded():
    """A third of the rows under one id, a third without id, many of them equal."""
    shared = prose(1, 30)
    out = rows()
    for i in range(60):
        text = f"{prose(i, 20)}\n{shared}\nline two here\nline three\n{prose(i % 7, 25)}" if i % 3 else shared
        out += [(7, text), (None, text + f"\n{prose(100 + i, 14)}" if i % 2 else text), (-1000 - i, prose(200 + i, 15) + "\n" + text[: 40 * i])]
    return out


@pytest.fixture(autouse=True)
def small_groups(monkeypatch):
    monkeypatch.setattr(exchange, "LARGEST_GROUP", 16_000)
    monkeypatch.setattr(exchange, "GROUP_BYTES", 2_000)


def test_groups_are_bounded_and_in_order(spark):
    texts = id_and_text(frame(spark, crowded()))
    plan = exchange.deal(texts, 0.1)
    found = plan.dealt(texts).withColumn("b", F.octet_length("text")).collect()
    assert sorted(r[1:3] for r in found) == sorted(tuple(r) for r in texts.collect())
    by_group, ids = {}, {}
    for r in found:
        by_group.setdefault(r["grp"], []).append(r)
        ids.setdefault(r["doc_id"], set()).add(r["grp"])
    assert all(len(g) == 1 or sum(r["b"] for r in g) <= exchange.LARGEST_GROUP for g in by_group.values())
    assert {d for d, g in ids.items() if len(g) > 1} == {7, 2**63 - 1}
    ends = [((g[0]["doc_id"], g[0]["text"]), (g[-1]["doc_id"], g[-1]["text"])) for g in
            (sorted(by_group[k], key=lambda r: (r["doc_id"], r["text"])) for k in sorted(by_group))]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    for d, groups in ids.items():
        assert len({int(x) for x in plan.owners(exchange.np.array(sorted(groups)))}) == 1
    cut = [int(plan.owners(exchange.np.array([min(ids[d])]))[0]) for d in sorted(ids) if d in plan.large]
    assert len(set(cut)) == len(plan.large) > 2


def test_substrings_of_crowded_ids(spark):
    same(test_substrings.digest(substrings.deduplicate(frame(spark, crowded()))), test_substrings.brute(crowded()))


@pytest.mark.parametrize("m", [1, 2])
def test_lines_of_crowded_ids(spark, m):
    same(test_lines.digest(lines.deduplicate(frame(spark, crowded()), m)), test_lines.brute(crowded(), m))


def test_other_columns_of_crowded_ids(spark):
    docs = frame(spark, crowded())
    assert lines.clean(docs).schema == docs.schema and lines.clean(docs).count() == len(crowded())


def test_suffixes_of_crowded_ids(spark):
    same(test_suffix_dedup.digest(suffix_dedup.deduplicate(frame(spark, crowded()))), test_suffix_dedup.brute(crowded()))
