"""Eigenvectors against double precision and exact spaces; whitening against numpy."""

import math

import numpy as np
import pytest

from pricelake.llm.eigen import clusters, components
from pricelake.llm.whitening import fit, gram, op11_whitening, whitened


def residuals(matrix, values, vectors):
    wide, exact = vectors.astype(np.longdouble), matrix.astype(np.longdouble)
    scale = np.abs(values).max()
    return (float(np.abs(exact @ wide - wide * values).max() / scale),
            float(np.abs(wide.T @ wide - np.eye(len(matrix))).max()))


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41), np.geomspace(1, 1e-12, 30), np.array([5.0] * 10 + [1.0] * 20),
    np.concatenate([1 + np.arange(12) * 1e-9, 2 + np.arange(12) * 1e-7, [9.0]]), np.array([3.0, 0, 0, 0, 0]), np.array([7.0]),
    np.concatenate([np.full(15, 1.0) + np.arange(15) * 1e-13, [0.5, 0.25]])])
def test_eigenvectors_are_of_double_precision(values):
    rng = np.random.default_rng(len(values))
    basis, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    matrix = basis * values @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = components(matrix)
    error, unit = residuals(matrix, found, vectors)
    assert error < 2e-15 and unit < 2e-15
    assert np.allclose(found, np.sort(values)[::-1], atol=1e-14 * values.max())
    single = np.linalg.eigh(matrix.astype(np.float32))[1]
    if len(values) > 5:
        assert residuals(matrix, found, single.astype(np.float64)[:, ::-1])[0] > 100 * error


def test_clusters_and_zero():
    assert [sorted(c.tolist()) for c in clusters(np.array([5.0, 1.0, 1.05, 9.0, 5.01]), 0.1)] == [[1, 2], [0, 4]]
    values, vectors = components(np.zeros((4, 4)))
    assert not values.any() and np.array_equal(vectors, np.eye(4))


def frame(spark, vectors, parts=5, kind="float"):
    rows = [(i, v, "x", 1) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, whitened string, n int").repartition(parts)


def plain(vectors):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors])
    n, sums = len(x), x.sum(0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    y = x - sums / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)
    return deviation, y @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_equals_numpy(spark):
    rng = np.random.default_rng(1)
    clean = (rng.normal(size=(400, 40)) * np.linspace(0.2, 3, 40)).astype(np.float32)
    bad = [None, [], [None] * 40, [math.nan] + [0.0] * 39, [math.inf] + [0.0] * 39, [0.5] * 39, [1.0] + [None] * 39]
    df = frame(spark, [*clean.tolist(), *bad])
    fitted = fit(df)
    assert fitted.sums.n == 400 and fitted.vectors.shape == (40, 32) and fitted.identity_error < 1e-10
    rows = {r.vec_id: r for r in whitened(df, fitted).collect()}
    assert sorted(rows) == list(range(400))
    deviation, want, share = plain(clean)
    assert [int(rows[i].deviation) for i in range(400)] == deviation
    got = np.array([rows[i].whitened for i in range(400)])
    for k in range(32):
        sign = np.sign(got[:, k] @ want[:, k])
        assert np.abs(got[:, k] * sign - want[:, k]).max() < 1e-9
    assert np.allclose(fitted.explained, share[:32], rtol=1e-10)


def test_merging_of_many_partial_matrices(spark, monkeypatch):
    import pricelake.llm.whitening as module

    df = frame(spark, np.random.default_rng(2).normal(size=(60, 5)).tolist(), 9, "double")
    whole = gram(df, "embedding", 5, 5, lambda x: x - 1_000_000.0)
    monkeypatch.setattr(module, "FAN_IN", 2)
    assert np.allclose(gram(df, "embedding", 5, 5, lambda x: x - 1_000_000.0), whole, rtol=1e-12)


def test_flat_few_and_huge_vectors(spark):
    same = frame(spark, [[1.0, 2.0]] * 6)
    fitted = fit(same)
    assert fitted.identity_error == 0 and not fitted.values.any()
    assert all(r.whitened == [0.0, 0.0] and r.deviation == 0 for r in whitened(same, fitted).collect())
    few = frame(spark, [[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 0.0, 3.0]])
    assert (fit(few).values > 0).sum() == 2 and fit(few).identity_error < 1e-10
    huge = frame(spark, [[1e300, 0.0], [0.0, 1.0], [5.0, -1e300]], kind="double")
    rows = whitened(huge, fit(huge)).collect()
    assert len(rows) == 3 and all(np.isfinite(r.whitened).all() for r in rows)
    nothing = frame(spark, [None, [math.nan]])
    assert fit(nothing) is None and whitened(nothing, None).count() == 0


def test_query(spark, tmp_path):
    vectors = np.random.default_rng(4).normal(size=(50, 6)).tolist()
    frame(spark, [*vectors, None]).write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = op11_whitening(spark, str(tmp_path)).collect()
    assert len(rows) == 300 and {r.component for r in rows} == set(range(1, 7)) and {r.n for r in rows} == {50}
    assert sum(r.explained for r in rows) == pytest.approx(50)
    assert {r.deviation for r in rows} == {int(d) for d in plain(np.float32(vectors))[0]}
    frame(spark, []).write.parquet(str(tmp_path / "none" / "embeddings.parquet"))
    assert op11_whitening(spark, str(tmp_path / "none")).count() == 0
