from __future__ import annotations

import math

import numpy as np
import pytest

from quayside.llm.queries import op13_embedding_whitening
from quayside.llm.tridiagonal import above, leading_pairs, tridiagonalised
from quayside.llm.whitening import whitened


def spectrum(values, seed=1):
    rng = np.random.default_rng(seed)
    turned = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return turned @ np.diag(np.array(values, float)) @ turned.T


MATRICES = {
    "random": lambda: np.cov(np.random.default_rng(0).standard_normal((200, 40)).T),
    "clusters": lambda: spectrum([5] * 10 + [3] * 10 + [1] * 20),
    "nearly equal": lambda: spectrum([2 + 1e-9 * i for i in range(30)]),
    "diagonal": lambda: np.diag(np.arange(20.0)),
    "identity": lambda: np.eye(18),
    "one direction": lambda: np.outer(np.arange(25.0), np.arange(25.0)),
    "zero": lambda: np.zeros((6, 6)),
    "one": lambda: np.array([[3.0]]),
    "two": lambda: np.array([[2.0, 1.0], [1.0, 2.0]]),
    "large numbers": lambda: spectrum([1e200, 1e199, 1e150, 1.0]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_pairs(name):
    matrix = MATRICES[name]()
    values, vectors = leading_pairs(matrix, 16)
    wanted = np.sort(np.linalg.eigvalsh(matrix))[::-1][:16]
    size = np.abs(wanted).max() or 1.0
    assert np.abs(values - wanted).max() <= 1e-13 * size
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-12 * size


def test_sturm_counts_agree_with_the_eigenvalues():
    matrix = MATRICES["random"]()
    diagonal, off, _ = tridiagonalised(matrix)
    values = np.linalg.eigvalsh(matrix)
    shifts = np.linspace(values[0] - 1, values[-1] + 1, 57)
    assert above(diagonal, off, shifts).tolist() == [int((values > s).sum()) for s in shifts]


def brute(rows, k=16):
    """{(id, component): (n, deviation, |whitened|, explained)} with numpy's own decomposition."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in kept]
    fit = sorted({tuple(x) for _, x in whole})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    apart = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], dtype=float) / n
    values, vectors = np.linalg.eigh(apart.T @ apart / n)
    values, vectors = values[::-1], vectors[:, ::-1].T
    out = {}
    for i, x in whole:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        d = np.array([n * a - s for a, s in zip(x, sums)], dtype=float) / n
        for c in range(min(k, int((values > 1e-9 * values.sum()).sum()))):
            out.setdefault((i, c + 1), []).append((n, deviation, abs(float(vectors[c] @ d) / math.sqrt(values[c])), values[c] / values.sum()))
    return out


def check(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    stored = [(r["vec_id"], r["embedding"]) for r in frame.collect()]  # as floats
    wanted = brute(stored)
    found: dict = {}
    for r in whitened(frame).collect():
        found.setdefault((r["vec_id"], r["component"]), []).append(r)
        assert r["identity_error"] <= 1e-9
    assert found.keys() == wanted.keys()
    for key, expected in wanted.items():
        got = sorted(found[key], key=lambda r: r["deviation"])
        for r, (n, deviation, size, explained) in zip(got, sorted(expected), strict=True):
            assert (r["n"], int(r["deviation"])) == (n, deviation)
            assert r["whitened"] ** 2 == pytest.approx(size**2, rel=1e-7, abs=1e-9)
            assert r["explained"] == pytest.approx(explained, rel=1e-9)


def sample(n, dims, seed=4):
    rng = np.random.default_rng(seed)
    spread = np.linspace(3, 0.5, dims)
    return [(i, [float(c) for c in rng.standard_normal(dims) * spread]) for i in range(n)]


def test_equals_numpy(spark):
    check(spark, sample(400, 24))


def test_repeats_nulls_and_odd_vectors(spark):
    rows = sample(90, 5)
    rows += [rows[3]] * 200 + [(1000, rows[3][1]), (None, rows[7][1])]
    rows += [(2000, None), (2001, [1.0, None, 2.0, 3.0, 4.0]), (2002, [math.nan] * 5), (2003, [math.inf] * 5)]
    check(spark, rows)


def test_fewer_dimensions_than_components(spark):
    rows = [(i, [c[0], c[0], 1.0, c[1]]) for i, c in sample(60, 2)]
    check(spark, rows, "double")


def test_large_numbers_keep_exact_deviations(spark):
    check(spark, [(i, [1e11 * c for c in v]) for i, v in sample(70, 4)], "double")


def test_other_lengths_and_numbers_without_a_whole_form_take_no_part(spark):
    rows = sample(50, 3)
    odd = [(900, [1.0, 2.0]), (901, []), (902, [1e300, 0.0, 0.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    assert {r["vec_id"] for r in whitened(frame).collect()} == {i for i, _ in rows}


def test_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitened(empty).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitened(same).collect() == []


def test_clashing_columns(spark):
    rows = [(i, v, "x", "y", 1) for i, v in sample(30, 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, x string, n int")
    assert whitened(frame).count() == 90


def test_query_over_its_table(spark):
    path = "/root/testdata/sf0.001"
    found = op13_embedding_whitening(spark, path).toPandas()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    wanted = brute(rows)
    assert len(found) == sum(map(len, wanted.values()))
    for r in found.itertuples():
        n, deviation, size, explained = wanted[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(size, rel=1e-6, abs=1e-8)
        assert r.explained == pytest.approx(explained, rel=1e-9) and r.identity_error < 1e-9
