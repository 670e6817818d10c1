"""Whitening against numpy's double-precision eigenvectors, and its axes on clustered eigenvalues."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerline.llm import whitening


def with_values(values, seed=0):
    q, _ = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).normal(size=(len(values), len(values))))
    a = (q * values) @ q.T
    return (a + a.T) / 2


SPECTRA = {
    "apart": np.linspace(1, 64, 64),
    "one space": np.r_[np.ones(10), np.linspace(2, 5, 54)],
    "close": np.r_[1 + 1e-9 * np.arange(10), np.linspace(2, 5, 54)],
    "clusters": np.r_[1 + 1e-12 * np.arange(10), 3 + 1e-5 * np.arange(10), np.linspace(4, 5, 44)],
    "no rank": np.r_[np.zeros(30), 10.0 ** -np.arange(20), 1000, 2000],
    "all close": 1 + 1e-8 * np.arange(40),
    "all equal": np.ones(12),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_axes_are_eigenvectors_to_double_precision(name):
    a = with_values(SPECTRA[name])
    values, axes = whitening.principal_axes(a)
    size = np.abs(a).sum(axis=1).max()
    assert np.abs(axes.T @ axes - np.eye(len(a))).max() < 1e-14
    assert np.abs(a @ axes - axes * values).max() < 1e-13 * size
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * size
    assert (np.diff(values) <= 1e-14 * size).all()


def test_close_eigenvalues_are_parted():
    """Single precision sees one eigenvalue of 40; the sub-solves find each of the 40 axes."""
    a = with_values(SPECTRA["all close"])
    axes = whitening.principal_axes(a)[1]
    exact = np.linalg.eigh(a)[1][:, ::-1]
    assert np.abs(np.abs((axes * exact).sum(axis=0)) - 1).max() < 1e-9


@pytest.mark.parametrize("a", [np.zeros((3, 3)), np.eye(4), np.ones((4, 4)), np.array([[2.0]])])
def test_simple_matrices(a):
    values, axes = whitening.principal_axes(a)
    assert np.allclose(axes.T @ axes, np.eye(len(a))) and np.allclose(a @ axes, axes * values)


def brute(vectors):
    x = np.floor(64 * vectors).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return ((n * x - total) ** 2).sum(axis=1), centred @ axes / np.sqrt(values), values / values.sum()


def test_query_on_the_whole_table(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").toPandas()
    deviation, white, explained = brute(np.stack(vectors["embedding"]).astype(np.float64))
    found = entry.queries()["op13_refined_whitening"](spark, small).toPandas().sort_values(["vec_id", "component"])
    assert found["vec_id"].tolist() == vectors["vec_id"].repeat(32).tolist() and set(found["n"]) == {len(vectors)}
    assert found["deviation"].tolist() == deviation.repeat(32).tolist()
    own = found["whitened"].to_numpy().reshape(-1, 32)
    signs = np.sign((own * white[:, :32]).sum(axis=0))
    assert np.abs(own * signs - white[:, :32]).max() < 1e-9
    assert np.abs(found["explained"].to_numpy()[:32] - explained[:32]).max() < 1e-12
    assert np.abs(own.T @ own / len(own) - np.eye(32)).max() < 1e-9 and found["identity_error"].max() < 1e-9


def test_sums_do_not_depend_on_partitions(spark, small):
    vectors = whitening.scaled(spark.read.parquet(f"{small}/embeddings.parquet"))
    one, many = (whitening.covariances(v, whitening.totals(v)) for v in (vectors.coalesce(1), vectors.repartition(13)))
    assert all((one[d] == many[d]).all() for d in one)


def test_odd_vectors_dimensions_and_clashing_columns(spark):
    table = [(1, [0.5, 1.0]), (2, [1.5, -2.0]), (2, [1.5, -2.0]), (None, [0.25, 3.0]), (4, None), (5, []), (6, [1.0, None]), (7, [float("inf"), 0.0])]
    table += [(8, [1e300, 0.0]), (10, [1.0, 2.0, 3.0]), (11, [2.0, 2.0, 3.0])]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>").withColumns({c: F.lit("clash") for c in ("dim", "x", "n", "v", "i")})
    found = whitening.whitened(frame).toPandas()
    flat = found[found["n"] == 4]
    assert sorted(flat["vec_id"].fillna(-1)) == [-1, -1, 1, 1, 2, 2, 2, 2] and set(flat["component"]) == {1, 2}
    solid = found[found["n"] == 2]  # two vectors of three dimensions: one axis
    assert sorted(solid["vec_id"]) == [10, 11] and np.allclose(np.abs(solid["whitened"]), 1.0) and set(solid["explained"]) == {1.0}
    assert len(found) == 10


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whitened(same).collect() == []
    assert whitening.whitened(same.limit(0)).collect() == []


def test_large_numbers_stay_exact():
    a = np.array([[2**30, 1], [2**30 - 1, -(2**30)], [3, 5]], np.int64)
    assert (whitening.exact_product(a) == (a.astype(object).T @ a.astype(object))).all()
    x = np.array([[2**30 + 7, 0], [-(2**30), 2]], np.int64)
    model = whitening.Whitening(2, [int(v) for v in x.sum(axis=0)], np.eye(2), np.ones(2))
    exact = [sum(int(v) ** 2 for v in row) for row in 2 * x.astype(object) - x.astype(object).sum(axis=0)]
    if max(exact) < 2**63:
        assert model.deviations(x).tolist() == exact
    else:
        with pytest.raises(OverflowError):
            model.deviations(x)
    with pytest.raises(OverflowError):
        whitening.Whitening(2**40, [0, 0], np.eye(2), np.ones(2)).deviations(x)
