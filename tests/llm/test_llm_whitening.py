import numpy as np
import pytest

from ratewatch.llm import whitening
from ratewatch.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, component string"


def plain(vectors, count=8):
    x = np.floor(np.array(vectors, np.float32).astype(float) * 1024) + 100000
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    values, axes = values[::-1], axes[:, ::-1]
    whole = np.array(x, object).astype(int)
    deviation = ((len(x) * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    return centred @ axes[:, :count] / np.sqrt(values[:count]), values[:count] / values.sum(), deviation


def compared(rows, vectors):
    """Rows of vectors with ids from 0 against the full decomposition."""
    wanted, shares, deviation = plain(vectors)
    rows = sorted(rows, key=lambda r: (r.vec_id, r.component))
    found = np.array([r.whitened for r in rows]).reshape(wanted.shape)
    assert np.abs(found * np.sign((found * wanted).sum(axis=0)) - wanted).max() < 1e-9
    assert np.allclose([r.explained for r in rows[: wanted.shape[1]]], shares, rtol=1e-9, atol=0)
    assert [r.deviation for r in rows[:: wanted.shape[1]]] == deviation.tolist()
    assert {r.n for r in rows} == {len(vectors)} and rows[0].identity_error < 1e-9


def test_against_the_full_decomposition(spark):
    rng = np.random.default_rng(4)
    for spread in (np.ones(40), np.geomspace(1, 1e-3, 40)):
        vectors = (rng.standard_normal((300, 40)) * spread).round(3).tolist()
        frame = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)], SCHEMA)
        compared(whitening.whitened(frame).collect(), vectors)


def test_query(spark, sf):
    given = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in given] == list(range(len(given)))
    compared(QUERIES["op13_whitened_vectors"](spark, sf).collect(), [r.embedding for r in given])


def test_filter_damps_what_is_not_wanted():
    values = np.concatenate([np.linspace(10, 9, 8), np.linspace(1, 0, 30)])
    made = whitening.filtered(lambda q: values[:, None] * q, np.ones((38, 1)), 1.0, 10.0)[:, 0]
    assert abs(made[0] - 1) < 1e-9 and np.abs(made[8:]).max() < 1e-6 < made[7]


def test_vectors_out_of_the_ordinary(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.1]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0])]
    rows += [(7, [inf, 0.0]), (8, []), (9, [-0.3, 0.7]), (10, [0.2, -0.9])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    found = whitening.whitened(frame).collect()
    assert sorted((r.vec_id or -1, r.component) for r in found) == [
        (i, c) for i, n in ((-1, 1), (1, 2), (9, 1), (10, 1)) for c in (1, 2) for _ in range(n)
    ]
    wanted, shares, deviation = plain([[0.5, 0.25], [0.5, 0.25], [0.1, 0.0], [-0.3, 0.7], [0.2, -0.9]])
    first = {r.vec_id: r for r in found if r.component == 1}
    assert np.allclose(abs(first[None].whitened), abs(wanted[2, 0])) and first[None].deviation == deviation[2]
    assert {r.n for r in found} == {5} and abs(first[9].explained - shares[0]) < 1e-12


@pytest.mark.parametrize("rows", [[], [(1, [0.5])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])], [(1, None)]])
def test_without_variance(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert whitening.whitened(frame).collect() == []


def test_fewer_dimensions_with_variance_than_components(spark):
    rows = [(i, [i / 8, 0.5, -i / 8], "x") for i in range(20)]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-12


def test_numbers_beyond_a_long(spark):
    rows = [(i, [v, 1.0], "x") for i, v in enumerate([3e38, -3e38, 1.0, 2.0])]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.deviation is None for r in found if r.vec_id < 2)
    assert found[0].identity_error < 1e-4
