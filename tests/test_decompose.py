"""Singular vectors of sparse rows against numpy."""

import numpy as np

from tallyloom.operators import decompose, features as ft


def sparse_rows(spark, x):
    rows = [(i, [int(j) for j in np.flatnonzero(r)], [float(v) for v in r[np.flatnonzero(r)]], [float(i), 1.0]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, at array<int>, value array<double>, rest array<double>").repartition(5)


def test_vectors_capture_the_energy_of_the_exact_ones(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 60)) * (rng.random((300, 60)) < 0.2) * np.geomspace(4, 0.2, 60)
    x[7] = 0.0
    data = sparse_rows(spark, x)
    vectors, values = decompose.right_vectors(data, 60, 8)
    exact = np.linalg.svd(x, compute_uv=False)[:8]
    assert np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-12)
    assert np.allclose(values, exact, rtol=1e-3) and (values**2).sum() >= (1 - 1e-5) * (exact**2).sum()
    assert (vectors[np.abs(vectors).argmax(axis=0), np.arange(8)] > 0).all()
    found = {r["row_id"]: r["embedding"] for r in decompose.project(data, vectors, rest="rest").collect()}
    assert np.allclose([found[i] for i in range(300)], np.hstack([x @ vectors, np.arange(300)[:, None], np.ones((300, 1))]))


def test_vectors_of_few_terms_and_of_no_rows(spark):
    x = np.array([[1.0, 2.0], [2.0, 4.0], [0.0, 0.0]])
    vectors, values = decompose.right_vectors(sparse_rows(spark, x), 2, 5)
    assert vectors.shape == (2, 2) and np.allclose(values, [5.0, 0.0], atol=1e-6)
    assert np.allclose(vectors[:, 0], np.array([1, 2]) / 5**0.5)
    none, zero = decompose.right_vectors(sparse_rows(spark, x).where("row_id < 0"), 2, 1)
    assert none.shape == (2, 1) and zero.tolist() == [0.0]


def test_text_basis_of_documents(spark):
    texts = ["red apple pie", "red apple", "green pear", "green pear tart", "apple pie", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    terms, values = ft.text_basis(df, "text", rank=2)
    weights = {r["term"]: r["weights"] for r in terms.collect()}
    assert set(weights) == {"red", "apple", "pie", "green", "pear"}
    strongest = sorted(weights, key=lambda t: -abs(weights[t][0]))
    assert strongest[0] == "apple" and set(sorted(weights, key=lambda t: -abs(weights[t][1]))[:2]) == {"green", "pear"}
    found = [r["value"] for r in values.orderBy("component").collect()]
    assert found[0] >= found[1] > 0
