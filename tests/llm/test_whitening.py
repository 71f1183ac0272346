import math

import numpy as np
import pytest

from lakeforge.llm import whitening
from lakeforge.llm.queries import op11_embedding_whitening

from ..conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, n int, component string, vec string"


def brute(rows, components=8):
    """Exact integers, NumPy's eigenvectors and plain loops."""
    ok = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in ok]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    v = [[n * a - s for a, s in zip(r, sums)] for r in x]
    y = np.array(v, float) / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    return ok, n, [sum(a * a for a in r) for r in v], e, y @ u[:, :components] / np.sqrt(np.maximum(e[:components], 1e-300)), np.trace(cov)


def compare(found, rows, components=8):
    ok, n, deviation, e, white, trace = brute(rows, components)
    k = min(components, int((e > 1e-9 * e[0]).sum()))
    assert len(found) == n * k
    by = {}
    for r in found:
        by.setdefault(r["component"], []).append(r)
    for c in range(1, k + 1):
        got = sorted((str(r["vec_id"]), r["deviation"], r["whitened"]) for r in by[c])
        plus = sorted((str(i), d, w) for (i, _), d, w in zip(ok, deviation, white[:, c - 1]))
        minus = sorted((str(i), d, -w) for (i, _), d, w in zip(ok, deviation, white[:, c - 1]))
        assert any([g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-7)
                   for want in (plus, minus))
        assert all(r["n"] == n and abs(r["explained"] / (e[c - 1] / trace) - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in by[c])


def vectors(n, dim, seed=0):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n, dim)) * np.geomspace(1, 0.01, dim) + r.normal(size=dim)
    return base.astype(np.float32).tolist()


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "v") for i, v in rows], SCHEMA).repartition(3)


def test_awkward_rows(spark):
    rows = list(enumerate(vectors(60, 12))) + [(3, vectors(1, 12, 5)[0]), (None, vectors(1, 12, 6)[0])]
    rows += [rows[5], rows[5], (None, None)]
    bad = [(900, None), (901, [None] * 12), (902, [float("nan")] + [0.0] * 11), (903, [float("inf")] + [0.0] * 11), (904, []), (905, [1.0] * 11), (906, [3e38] * 12)]
    compare(whitening.whiten(table(spark, rows + bad)).collect(), rows)


def test_fewer_components(spark):
    assert whitening.whiten(table(spark, []).limit(0)).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(table(spark, [(i, [0.5, 0.25]) for i in range(9)])).collect() == []  # no variance
    rows = [(i, v) for i, v in enumerate(vectors(4, 20))]  # rank 3
    compare(whitening.whiten(table(spark, rows)).collect(), rows)
    rows = [(i, v) for i, v in enumerate(vectors(50, 3))]
    compare(whitening.whiten(table(spark, rows)).collect(), rows)


def test_exact_integers():
    r = np.random.default_rng(1)
    for top in (3, 2**19, 2**30, 2**52):
        y = r.integers(-top, top, (300, 4))
        want = y.astype(object)
        assert (whitening.products(y) == want.T @ want).all()
        assert (whitening.squares(y) == (want * want).sum(1)).all()
    big = np.full((20000, 2), 2**20 - 1)
    assert whitening.products(big)[0, 1] == 20000 * (2**20 - 1) ** 2


@pytest.mark.parametrize("rank", [1, 5, 16])
def test_cholesky_and_rotations(rank):
    a = np.random.default_rng(rank).normal(size=(16, rank))
    a = a @ a.T
    order, factor = whitening.pivoted_cholesky(a)
    assert factor.shape == (16, rank) and np.allclose(factor @ factor.T, a[np.ix_(order, order)])
    assert np.allclose(np.triu(factor, 1), 0)
    values, components = whitening.eigen(a)
    assert np.allclose(components.T @ components, np.eye(rank)) and np.allclose(a @ components, components * values)


def test_large_values_and_deviation_without_a_long(spark):
    rows = [(i, [float(2**8 * (i % 7)), float(i), float(i * i)]) for i in range(40)]
    compare(whitening.whiten(table(spark, rows)).collect(), rows)
    far = [(i, [float(2**40 * (i % 2)), float(i)]) for i in range(8)]
    assert {r["deviation"] for r in whitening.whiten(table(spark, far)).collect()} == {None}


def test_given_embeddings(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(op11_embedding_whitening(spark, SF_SMALL).collect(), rows)
