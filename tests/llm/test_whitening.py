from __future__ import annotations

import numpy as np
import pytest

from armlens.llm import whitening

SF = "/root/testdata/sf0.01"


def dense(x: np.ndarray, k: int = 8):
    """Eigenvalues, whitened rows (either sign) and exact deviations by the plain covariance."""
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    dev = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s, strict=True)) for row in x]
    return values, c @ vectors / np.sqrt(values), dev, np.trace(c.T @ c / n)


def check(out, rows):
    """``rows``: id -> vector, all of which take part."""
    ids = sorted(rows)
    x = np.floor(1024 * np.array([rows[i] for i in ids])).astype(np.int64) + 100_000
    values, z, dev, trace = dense(x)
    assert len(out) == len(ids) * z.shape[1] and set(out["n"]) == {len(ids)}
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((got * z).sum(axis=0))
    assert np.abs(got * sign - z).max() < 1e-7
    assert np.allclose(out.groupby("component")["explained"].first(), values / trace, rtol=1e-10)
    assert out.groupby("vec_id")["deviation"].first().loc[ids].tolist() == dev


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_same_as_dense(spark, parts):
    """Forty partitions need two rounds of stacking."""
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in df.collect()}
    check(whitening.whiten(df.repartition(parts)).toPandas(), rows)


def test_edges(spark):
    rng = np.random.default_rng(2)
    good = {i: [float(x) for x in rng.normal(size=5)] for i in range(30)}
    rows = [(i, v, "x") for i, v in good.items()]
    rows += [(100, None, "x"), (101, [0.1] * 4 + [None], "x"), (102, [float("nan")] * 5, "x"), (103, [float("inf")] * 5, "x"), (104, [1.0] * 3, "x"), (105, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    out = whitening.whiten(df.repartition(3)).toPandas()
    assert set(out["component"]) == {1, 2, 3, 4, 5}
    check(out, good)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id in (100, 105)")).count() == 0


def test_repeated_rows_and_null_ids(spark):
    v = [[1.0, 2.0, 3.0], [2.0, 1.0, 0.5], [0.0, 4.0, 1.0]]
    df = spark.createDataFrame([(1, v[0]), (1, v[0]), (None, v[1]), (2, v[2]), (2, v[1])], "vec_id long, embedding array<double>")
    out = whitening.whiten(df).toPandas()
    assert len(out) == 15 and set(out["n"]) == {5} and out["vec_id"].isna().sum() == 3
    third = out[out["component"] == 3]  # three different points span a plane
    assert third["whitened"].isna().all() and out["identity_error"].max() < 1e-9
    assert np.allclose(out[out["vec_id"] == 1].groupby("component")["deviation"].nunique(), 1)


def test_without_variance(spark):
    df = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(4)], "vec_id long, embedding array<float>")
    out = whitening.whiten(df).toPandas()
    assert len(out) == 8 and set(out["deviation"]) == {0} and out[["whitened", "explained", "identity_error"]].isna().all().all()
    one = whitening.whiten(df.limit(1)).toPandas()
    assert len(one) == 2 and set(one["n"]) == {1}


def test_large_entries(spark):
    """Deviations that fit no long are null; those that do are exact."""
    df = spark.createDataFrame([(0, [1e300]), (1, [-1e300]), (2, [0.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df).collect()}
    assert got == {0: None, 1: None, 2: 0}
    df = spark.createDataFrame([(0, [300000.0]), (1, [0.0])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whitening.whiten(df).collect()} == {(1024 * 300000) ** 2}


@pytest.mark.parametrize("kind", ["plain", "graded", "tied", "low rank", "near ties"])
def test_bidiagonal_values_and_vectors(kind):
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    near = (q * np.sqrt(np.r_[np.ones(5) + 1e-13 * np.arange(5), np.linspace(0.1, 0.5, 25)])) @ np.linalg.qr(rng.normal(size=(30, 30)))[0]
    x = {"plain": rng.normal(size=(90, 24)), "graded": rng.normal(size=(90, 12)) * 10.0 ** -np.arange(12), "tied": np.vstack([np.eye(9), -np.eye(9)]), "low rank": rng.normal(size=(40, 3)) @ rng.normal(size=(3, 16)), "near ties": near}[kind]
    r = np.linalg.qr(x, mode="r")
    a, b, w = whitening.bidiagonal(r)
    values, vectors = whitening.eigenpairs(a, b)
    v, s = w @ vectors, np.linalg.svd(x, compute_uv=False) ** 2
    assert np.abs(values - s).max() < 1e-14 * s[0] * len(s)
    assert np.abs(v.T @ v - np.eye(len(v))).max() < 1e-11 and np.abs(r.T @ r @ v - v * values).max() < 1e-13 * s[0]
