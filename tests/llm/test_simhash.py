import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeforge.llm import simhash
from lakeforge.llm.components import connected
from lakeforge.llm.queries import op9_simhash

from ..conftest import SF_SMALL
from .fixtures import frame, key, rows, same, words


def brute_fp(text, k=4):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")))
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(data, bits=4):
    fps = [(key(d), brute_fp(t)) for d, t in data]
    group = list(range(len(fps)))
    for i, (_, x) in enumerate(fps):
        for j in range(i):
            if (x ^ fps[j][1]).bit_count() <= bits and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: min(d for (d, _), h in zip(fps, group) if h == g) for g in group}
    real = lambda d: None if d == key(None) else d
    return [(real(d), f"{f:016x}", real(least[g])) for (d, f), g in zip(fps, group)]


def digest(df):
    return df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()


def test_awkward_rows(spark):
    same(digest(simhash.near_duplicates(frame(spark))), brute(rows()))


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [(1, "x")]).limit(0)).collect() == []


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    same(op9_simhash(spark, SF_SMALL).collect(), brute(docs))


@pytest.mark.parametrize("shared", [3, 4, 6, 8])
def test_every_link_shares_a_cell_and_large_cells_keep_their_links(shared):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    other = base.copy()
    for _ in range(4):
        other ^= np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)
    a, b = simhash.embed(base), simhash.embed(other)
    assert (np.bitwise_count(a ^ b) <= np.bitwise_count(base ^ other)).all()
    masks = np.array(simhash.grids(4, shared), np.uint64)
    assert len(masks) == simhash.math.comb(4 + shared, 4)
    assert (((a[:, None] ^ b[:, None]) & masks) == 0).any(axis=1).all()


def test_groups_follow_the_number_of_points():
    chosen = [simhash.shared_groups(10**k, 4) for k in range(13)]
    assert chosen == sorted(chosen) and chosen[0] == 3 and chosen[12] > 6
    for k in range(13):  # points of a cell stay few
        assert 10**k * simhash.AXIS_MATCH ** (simhash.SEGMENTS * chosen[k] / (4 + chosen[k])) < 1000
    assert simhash.shared_groups(10**9, 40) == 3


def test_finer_grids_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "shared_groups", lambda n, max_bits: 5)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    same(op9_simhash(spark, SF_SMALL).collect(), brute(docs))


def test_hot_group_of_near_copies(spark):
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 2**63))
    fps = [base ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))) for _ in range(600)]
    fps += [int(x) for x in rng.integers(0, 2**63, 200)]
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    signed = list(dict.fromkeys(signed))
    points = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(simhash.cells(points, 4, 7), 4)
    found = {r["node"]: r["component"] for r in connected(edges)[0].collect()}
    group = list(signed)
    for i, x in enumerate(signed):
        for j, y in enumerate(signed[:i]):
            if ((x ^ y) % 2**64).bit_count() <= 4 and group[i] != group[j]:
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    assert {x: g for x, g in zip(signed, group) if g != x} == found
    assert edges.count() <= 36 * len(signed)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 260)] + [(5, 7), (3, 3)]
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "u long, v long"))[0].collect()}
    assert found == {i: 100 for i in range(101, 141)} | {x: 5 for x in [7, *range(200, 260)]}


def test_one_row_of_each_component_under_repeated_ids(spark):
    from .fixtures import prose

    shared, near = prose(1, 300), prose(1, 300) + " tail"
    assert (brute_fp(shared) ^ brute_fp(near)).bit_count() <= 4
    other, third = prose(21, 300), prose(33, 300)
    data = [(1, shared), (2, near), (2, other), (5, third), (5, third + " tail"), (5, third), (None, None), (None, "")]
    kept = [r[:2] for r in simhash.keep_one(frame(spark, data)).collect()]
    ids = sorted((d is None, d or 0) for d, _ in kept)
    assert ids == [(False, 1), (False, 2), (False, 5), (True, 0)]
    assert (1, shared) in kept and (2, other) in kept
