import pytest

from lakeforge.llm import lines
from lakeforge.llm.queries import op7_line_dedup

from ..conftest import SF_SMALL
from .fixtures import frame, key, prose, rows, same

STRIP = " \t\n\v\f\r"


def brute(data, m=1):
    docs = sorted(((key(d), t or "") for d, t in data))
    full = [[x.strip(STRIP) for x in t.split("\n") if x.strip(STRIP)] for _, t in docs]
    seen, out = set(), []
    for (d, t), f in zip(docs, full):
        gone = set()
        for i in range(len(f) - m + 1):
            run = tuple(f[i:i + m])
            if run in seen:
                gone.update(range(i, i + m))
            seen.add(run)
        kept, n = [], 0
        for line in t.split("\n"):
            if not line.strip(STRIP):
                kept.append(line)
                continue
            if n not in gone:
                kept.append(line)
            n += 1
        out.append((None if d == key(None) else d, len(f), len(gone), "\n".join(kept)))
    return out


def longest(data):
    docs = [[x.strip(STRIP) for x in (t or "").split("\n") if x.strip(STRIP)] for _, t in data]
    best, n = 0, 1
    while True:
        found = [tuple(f[i:i + n]) for f in docs for i in range(len(f) - n + 1)]
        if len(set(found)) == len(found):
            return best
        best, n = n, 2 * n


def with_lines():
    block = [f"shared line {i} {prose(i, 4)}" for i in range(23)]
    out = rows()
    out += [(500 + i, "\n".join([f"intro {i}", *block[: 5 * i], "", f"  {block[3]}  ", f"outro {i}"])) for i in range(6)]
    out += [(600, "\n".join(["again"] * 9)), (601, "a\nb\na\nb\na\nb\n\n"), (602, "\n\n\n"), (603, "x\n a\nb \ny"), (604, "tail\r\nend\r\n")]
    return out


def digest(df):
    return df.select("doc_id", "n_lines", "n_removed", "kept_text").collect()


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_awkward_rows(spark, m):
    same(digest(lines.deduplicate(frame(spark, with_lines()), m)), brute(with_lines(), m))


def test_levels_reach_the_longest_run(spark):
    found = lines.deduplicate(frame(spark, with_lines())).agg({"longest_repeat": "max"}).first()[0]
    assert found == longest(with_lines())


def test_spans_are_what_is_deleted(spark):
    found = lines.deduplicate(frame(spark, with_lines()), 2).select("doc_id", "spans", "kept_text").collect()
    assert any(r["spans"] for r in found)
    texts = {}
    for d, t in with_lines():
        texts.setdefault(d, []).append((t or "").split("\n"))
    for r in found:
        def rest(t):
            return [x for i, x in enumerate(t) if not x.strip(STRIP) or not any(a <= i < b for a, b in r["spans"])]
        assert any("\n".join(rest(t)) == r["kept_text"] for t in texts[r["doc_id"]])


def test_hot_line_and_hot_run(spark):
    data = [(i, f"only {i}\nhot line\n" + ("hot run\nof lines\n" if i % 2 else "") + f"own end {i * 7}") for i in range(400)]
    same(digest(lines.deduplicate(frame(spark, data))), brute(data))


def test_empty_table(spark):
    assert lines.deduplicate(frame(spark, [(1, "x")]).limit(0)).collect() == []


def test_other_columns_stay(spark):
    docs = frame(spark, with_lines()).withColumn("n_chars", lines.F.lit(-1))
    out = lines.clean(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    same([(r["doc_id"], r["text"], r["n_chars"], r["block"], r["bucket"], r["fp"], r["grp"]) for r in out.collect()],
         [(d, t, len(t), 1, "b", None, "g") for d, *_, t in brute(with_lines())])


def test_given_documents(spark):
    import hashlib
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    same(op7_line_dedup(spark, SF_SMALL).collect(),
         [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in brute(docs)])
