"""Whitening against a dense eigen decomposition, and on odd rows."""

import math

import numpy as np
import pytest

import __spark_entry__ as entry
from loadlens.llm import whitening

FOLDER = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, label int, component int, whitened double, n string, x string, ids string"


def vectors(spark, data, ids=None):
    rows = [(i, v, None, 1, 0.5, "n", "x", "ids") for i, v in zip(ids or range(len(data)), data)]
    return spark.createDataFrame(rows, ROWS)


def dense(data):
    x = np.floor(np.array(data, np.float32).astype(float) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums) / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, centred, values[::-1], turned[:, ::-1]


def compared(rows, data, components=8, close=1e-9):
    """Check every returned column; rows in the order of ``data`` by vec_id."""
    x, n, sums, centred, values, turned = dense(data)
    size = min(components, int((values > 1e-12 * values.sum()).sum()))
    rows = sorted(rows, key=lambda r: (r.vec_id, r.component))
    assert len(rows) == len(data) * size
    got = np.array([r.whitened for r in rows]).reshape(len(data), size)
    want = centred @ turned[:, :size] / np.sqrt(values[:size])
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < close
    deviations = [sum(int(d) ** 2 for d in row) for row in n * x - sums]
    for k, r in enumerate(rows):
        assert r.component == k % size + 1 and r.n == n and r.deviation == deviations[k // size]
        assert math.isclose(r.explained, values[k % size] / values.sum(), rel_tol=1e-9) and r.identity_error < 1e-9


def test_query(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    compared(entry.queries()["op11_whitening"](spark, FOLDER).collect(), [r.embedding for r in table])


def test_unequal_variances_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    data = (rng.standard_normal((300, 12)) * 3.0 ** -np.arange(12) * 40).tolist()
    data += [data[0]] * 150
    compared(whitening.whiten(vectors(spark, data)).collect(), data)


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(3)
    flat = [[float(a), float(b), float(a + b)] for a, b in rng.integers(-50, 50, (40, 2)).tolist()]  # two dimensions of three
    compared(whitening.whiten(vectors(spark, flat)).collect(), flat)


def test_equal_eigenvalues(spark):
    data = [[s if i == j else 0.0 for j in range(4)] for i in range(4) for s in (1.0, -1.0)]
    rows = whitening.whiten(vectors(spark, data)).collect()
    assert len(rows) == 8 * 4 and max(r.identity_error for r in rows) < 1e-9
    assert all(math.isclose(r.explained, 0.25, rel_tol=1e-9) for r in rows)


def test_early_end_gives_the_same_components(spark):
    rng = np.random.default_rng(4)
    data = (rng.standard_normal((500, 30)) * 2.0 ** -np.arange(30) * 100).tolist()
    blocks = whitening.pack(whitening.whole_vectors(vectors(spark, data)))
    right, _ = whitening.bidiagonalise(blocks, tolerance=1e-14, wanted=3)
    assert right.shape[1] < 30
    few = whitening.fit(blocks, 3, tolerance=1e-14)
    values = dense(data)[4]
    assert np.allclose(few.eigenvalues, values[:3], rtol=1e-10)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = rng.standard_normal((20, 3)).tolist()
    bad = [None, [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [], [1.0, 2.0]]
    rows = whitening.whiten(vectors(spark, good + bad)).collect()
    compared(rows, good)
    same_id = whitening.whiten(vectors(spark, good, [None, None, 7, 7, *range(16)])).collect()
    assert len(same_id) == 60 and sum(r.vec_id is None for r in same_id) == 6


@pytest.mark.parametrize("data", [[], [[1.0, 2.0]], [[0.5, 0.5]] * 5, [None, []]])
def test_nothing_to_whiten(spark, data):
    out = whitening.whiten(vectors(spark, data))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0
