"""Whitening against NumPy's eigenvectors, on vectors with nulls, repeats, flat directions and several lengths."""

import numpy as np
import pytest

from betaloom.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int, n long, x string"


def brute(vectors, components):
    x = np.floor(64 * np.asarray(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    white = (x - sums / n) @ vectors[:, :k] / np.sqrt(values[:k])
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return n, white, values[:k] / values.sum(), deviation


def check(found, ids, vectors, components=16):
    n, white, explained, deviation = brute(vectors, components)
    rows = found[found.vec_id.isin(ids)]
    assert len(rows) == len(ids) * white.shape[1]
    assert (rows.n == n).all() and rows.identity_error.max() < 1e-9
    got = rows.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    signs = np.sign((got * white).sum(axis=0))
    np.testing.assert_allclose(got * signs, white, atol=1e-8)
    np.testing.assert_allclose(rows.groupby("component").explained.first(), explained, rtol=1e-9)
    assert list(rows.groupby("vec_id").deviation.first().loc[ids]) == deviation


@pytest.mark.parametrize("rows,size", [(300, 24), (40, 7), (12, 30)])
def test_whitened_as_numpy(spark, rows, size):
    rng = np.random.default_rng(size)
    vectors = rng.normal(size=(rows, size)) @ rng.normal(size=(size, size))
    vectors[3] = vectors[4]
    frame = spark.createDataFrame([(i, v.tolist(), 1, 2, "y") for i, v in enumerate(vectors)], VECTORS)
    check(whitening.whitened(frame).toPandas(), list(range(rows)), vectors)


def test_equal_variances_are_all_found(spark):
    size = 6
    vectors = np.vstack([np.eye(size), -np.eye(size)]) * 3
    vectors = np.floor(vectors * 64) / 64
    frame = spark.createDataFrame([(i, v.tolist(), 1, 2, "y") for i, v in enumerate(vectors)], VECTORS)
    found = whitening.whitened(frame).toPandas()
    assert set(found.component) == set(range(1, size + 1)) and found.identity_error.max() < 1e-9
    np.testing.assert_allclose(found.explained, 1 / size)


def test_flat_and_repeated_directions_have_no_component(spark):
    rng = np.random.default_rng(1)
    part = rng.normal(size=(50, 3))
    vectors = np.hstack([part, part, np.ones((50, 2))])
    frame = spark.createDataFrame([(i, v.tolist(), 1, 2, "y") for i, v in enumerate(vectors)], VECTORS)
    found = whitening.whitened(frame).toPandas()
    assert set(found.component) == {1, 2, 3}
    check(found, list(range(50)), vectors)


def test_nulls_lengths_repeats_and_nothing(spark):
    rng = np.random.default_rng(2)
    short, long = rng.normal(size=(20, 3)), rng.normal(size=(30, 5))
    rows = [(i, v.tolist(), None, 1, "") for i, v in enumerate(short)] + [(100 + i, v.tolist(), None, 1, "") for i, v in enumerate(long)]
    odd = [(200, None, 1, 1, ""), (201, [1.0, None, 2.0], 1, 1, ""), (202, [float("nan"), 1.0, 2.0], 1, 1, ""), (203, [float("inf"), 1.0, 2.0], 1, 1, ""), (204, [], 1, 1, "")]
    repeats = [(300, short[0].tolist(), 1, 1, ""), (None, short[1].tolist(), 1, 1, "")]
    found = whitening.whitened(spark.createDataFrame([*rows, *odd, *repeats], VECTORS)).toPandas()
    assert not found.vec_id.isin(range(200, 205)).any() and found.vec_id.isna().sum() == 3
    known = found[found.vec_id.notna()].astype({"vec_id": int})
    check(known, list(range(20)), short)
    check(known, [100 + i for i in range(30)], long)
    assert whitening.whitened(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0], 1, 1, "")] * 2, VECTORS)).count() == 0


def test_huge_entries_and_exact_deviations(spark):
    vectors = [[1e30, 0.0], [-1e30, 1.0], [0.5, 2.0], [3.0, -1.0]]
    found = whitening.whitened(spark.createDataFrame([(i, v, 1, 1, "") for i, v in enumerate(vectors)], VECTORS)).toPandas()
    assert len(found) == 4 and found.whitened.notna().all()
    middle = [[20_000_000.0 * i, float(i % 3)] for i in range(40)]
    found = whitening.whitened(spark.createDataFrame([(i, v, 1, 1, "") for i, v in enumerate(middle)], VECTORS)).toPandas()
    deviation = brute(middle, 2)[3]
    got = found.groupby("vec_id").deviation.first()
    for i, want in enumerate(deviation):
        assert (np.isnan(got[i]) and want >= 1 << 63) or abs(got[i] - want) <= want * 1e-15
