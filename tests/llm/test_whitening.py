"""Whitening against eigenvectors of the covariance, and singular values against plain ones."""

import math
from fractions import Fraction

import numpy as np
import pytest

from revtide.llm import bidiagonal, whitening
from revtide.llm.queries import op13_bidiagonal_whitening

random = np.random.default_rng(5)
TURN = np.linalg.qr(random.normal(size=(24, 24)))[0]
SHAPES = {
    "gauss": random.normal(size=(300, 24)),
    "graded": random.normal(size=(300, 24)) @ np.diag(np.logspace(0, -6, 24)),
    "graded upwards": random.normal(size=(300, 24)) @ np.diag(np.logspace(-6, 0, 24)),
    "equal": np.vstack([np.eye(24) * 3] * 3),
    "clusters": TURN @ np.diag([5.0] * 6 + [3.0] * 8 + [1.0] * 10) @ TURN[::-1],
    "near clusters": TURN @ np.diag(np.array([5.0] * 6 + [3.0] * 18) * (1 + 1e-7 * random.normal(size=24))) @ TURN[::-1],
    "without rank": np.hstack([random.normal(size=(60, 20)), np.zeros((60, 2)), np.ones((60, 2))]),
    "few rows": random.normal(size=(5, 24)),
    "diagonal": np.diag([3.0, 0.0, 5.0, 1.0]),
    "one": np.ones((3, 1)),
    "zero": np.zeros((3, 6)),
}


@pytest.mark.parametrize("name", SHAPES)
def test_right_singular(name):
    rows = SHAPES[name]
    n = rows.shape[1]
    r = np.linalg.qr(np.vstack([rows, np.zeros((n, n))]), mode="r")
    values, vectors = bidiagonal.right_singular(r, n)
    plain = np.linalg.svd(rows, compute_uv=False) ** 2
    rank = int((plain > plain.max() * (n * 3e-16) ** 2).sum()) if plain.max() else 0
    assert abs(len(values) - rank) <= (name == "without rank")
    if len(values):
        assert np.allclose(values, plain[:len(values)], rtol=1e-9, atol=1e-28 * plain.max())
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-11
        assert np.abs(rows.T @ (rows @ vectors.T) - vectors.T * values).max() < 1e-12 * plain.max()


def test_pair_of_near_values():
    q1, e1, q2 = 25.0, 1e-14, 25.0 + 1e-13
    plain = np.linalg.eigvalsh([[q1, math.sqrt(q1 * e1)], [math.sqrt(q1 * e1), q2 + e1]])
    assert np.allclose(sorted(bidiagonal._pair(q1, e1, q2)), plain, rtol=1e-14, atol=0)


def test_bidiagonalised():
    a = random.normal(size=(12, 12))
    diagonal, above, w = bidiagonal.bidiagonalised(a)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(w.T @ a.T @ a @ w, b.T @ b) and np.allclose(w.T @ w, np.eye(12))


def plain(vectors, components=16):
    """{component: ...} by numpy's eigenvectors of the covariance, whole numbers exact."""
    xs = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, xs))), dtype=object)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    mean = [Fraction(s, n) for s in sums]
    centred = np.array([[float(a - m) for a, m in zip(row, mean)] for row in fit])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:components], directions[:, ::-1].T[:components]
    white = np.array([[float(a - m) for a, m in zip(row, mean)] for row in xs]) @ directions.T / np.sqrt(values)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in xs]
    return n, deviation, white, values / (centred ** 2).sum() * n


def test_query_equals_plain(spark, sf_dir):
    table = [r for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    n, deviation, white, explained = plain([r["embedding"] for r in table])
    found = op13_bidiagonal_whitening(spark, sf_dir).collect()
    assert len(found) == 16 * len(table)
    place = {r["vec_id"]: i for i, r in enumerate(table)}
    mine = np.zeros((len(table), 16))
    for r in found:
        i, k = place[r["vec_id"]], r["component"] - 1
        mine[i, k] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[i] and r["identity_error"] <= 1e-10
        assert abs(r["explained"] / explained[k] - 1) < 1e-9
    assert np.allclose(mine * np.sign((mine * white).sum(axis=0)), white, atol=1e-7)


SCHEMA = "vec_id long, embedding array<float>, component string, n int, row string, x string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "c", 1, "r", "x") for i, v in enumerate(vectors)], SCHEMA)


def run(rows, **options):
    ready = whitening.prepared(rows)
    model = whitening.fitted(ready, **options)
    return model, whitening.whitened(ready, model).collect()


def test_awkward_rows(spark):
    vectors = [[1.0, 2.0, 0.5], [1.0, 2.0, 0.5], [0.0, -2.0, 1.0], [4.0, 0.0, 0.0], [3.0, 3.0, -1.0], None, [],
               [None, 1.0, 2.0], [math.nan, 0.0, 0.0], [math.inf, 0.0, 0.0], [1e30, 0.0, 0.0], [1.0, 2.0], [0.0, 0.0, 0.0]]
    rows = frame(spark, vectors)
    rows = rows.unionByName(rows.filter("vec_id = 2")).unionByName(
        spark.createDataFrame([(None, [2.0, 2.0, 2.0], None, None, None, None)], SCHEMA))
    kept = [v for v in vectors if v and len(v) == 3 and all(c is not None and abs(c) < 1e20 for c in v)]
    kept += [vectors[2], [2.0, 2.0, 2.0]]
    model, found = run(rows)
    n, deviation, white, explained = plain(kept)
    assert model.n == n == 6 and len(found) == 3 * len(kept)
    assert sorted(int(r["deviation"]) for r in found if r["component"] == 1) == sorted(deviation)
    assert found[0]["row"].asDict().keys() == set(rows.columns)
    for k in range(3):
        mine = sorted(abs(r["whitened"]) for r in found if r["component"] == k + 1)
        assert np.allclose(mine, sorted(np.abs(white[:, k])), atol=1e-9)


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[]]])
def test_nothing_to_whiten(spark, vectors):
    assert run(frame(spark, vectors))[1] == []


def test_merging_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    vectors = random.normal(size=(200, 6)).astype("float32").tolist()
    model, _ = run(frame(spark, vectors).repartition(13))
    n, _, white, explained = plain(vectors)
    assert np.allclose(model.variances / model.trace, explained[:6]) and model.identity_error < 1e-12


def test_exact_beyond_64_bits():
    model = whitening.Model(2 ** 40, [2 ** 60, 3], np.zeros((0, 2)), np.zeros(0), 0.0)
    x = np.array([[2 ** 45, -2 ** 45], [5, 7]])
    assert model.deviation(model.centred(x)) == [
        sum((2 ** 40 * int(a) - s) ** 2 for a, s in zip(row, model.sums)) for row in x
    ]
