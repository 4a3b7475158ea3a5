"""Whitening: the solver against numpy's, rows against a plain version, edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import bidiagonal
from fleetgauge.llm.embedding_whitening import WhiteningSettings, triangle, usable, whiten

FOLDER = "/root/testdata/sf0.001"
ROWS = "vec_id BIGINT, embedding ARRAY<FLOAT>, n STRING, whitened STRING, component STRING"


def matrices():
    rng = np.random.default_rng(5)
    left, right = (np.linalg.qr(rng.normal(size=(20, 20)))[0] for _ in range(2))
    yield "random", rng.normal(size=(64, 64))
    yield "equal values", np.diag([3.0, 3, 3, 2, 2, 1, 0, 0])
    yield "near values", left @ np.diag([5.0] * 6 + [4.999999999] * 6 + [1.0] * 8) @ right
    yield "graded", left @ np.diag(10.0 ** -np.arange(20)) @ right
    yield "rank three", np.vstack([rng.normal(size=(3, 12)), np.zeros((9, 12))])
    yield "zero", np.zeros((5, 5))
    yield "one", np.array([[-2.0]])
    yield "wilkinson", np.diag(np.abs(np.arange(21.0) - 10)) + np.diag(np.ones(20), 1)


@pytest.mark.parametrize("name,matrix", list(matrices()), ids=lambda x: x if isinstance(x, str) else "")
def test_solver(name, matrix):
    a, b, v = bidiagonal.bidiagonal(matrix)
    values, inner = bidiagonal.right_vectors(a, b, 8)
    vectors, square = v @ inner, matrix.T @ matrix
    wanted = np.linalg.eigvalsh(square)[::-1][:8]
    scale = max(wanted[0], 1e-300)
    assert np.abs(values - wanted).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-11
    assert np.abs(square @ vectors - vectors * values).max() <= 1e-13 * scale


def test_small_values_keep_their_accuracy():
    a, b = 10.0 ** -np.arange(12), 0.5 * 10.0 ** -np.arange(11)
    values = bidiagonal.squared_singular_values(a, b)
    assert math.isclose(math.prod(np.sqrt(values)), math.prod(a), rel_tol=1e-12)  # the determinant


def plain(vectors, most=8):
    """Columns of each vector by numpy's symmetric solver."""
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, centred @ directions / np.sqrt(values), values / (centred ** 2).sum() * n


def test_equals_numpy(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").repartition(23)
    found = whiten(rows, WhiteningSettings(block=16, fan=3)).toPandas()
    given = rows.orderBy("vec_id").toPandas()
    n, deviation, whitened, explained = plain(np.stack(given["embedding"]))
    assert len(found) == 8 * n and set(found["n"]) == {n}
    assert 0 <= found["identity_error"].iloc[0] < 1e-10 and found["identity_error"].nunique() == 1
    for k in range(8):
        part = found[found["component"] == k + 1].sort_values("vec_id")
        assert part["deviation"].tolist() == deviation
        got = part["whitened"].to_numpy()
        sign = np.sign(got @ whitened[:, k])
        assert np.abs(got * sign - whitened[:, k]).max() < 1e-9
        assert np.allclose(part["explained"], explained[k], rtol=1e-12)


def test_triangle_is_that_of_all_rows(spark):
    rows = usable(spark.read.parquet(f"{FOLDER}/embeddings.parquet").repartition(9))
    x = np.floor(1024 * np.stack(rows.toPandas()["embedding"]).astype(float)).astype(np.int64) + 100_000
    r = triangle(rows, len(x), tuple(x.sum(axis=0).tolist()), WhiteningSettings(fan=2, block=10))
    centred = x - x.sum(axis=0) / len(x)
    assert np.allclose(r.T @ r, centred.T @ centred, rtol=1e-10)


def test_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 0.25]), (2, [0.5, -0.25]), (None, [-0.5, 0.0]), (3, [0.125, 3e4]), (3, [0.125, 3e4])]
    bad = [(4, None), (5, []), (6, [None, 0.5]), (7, [nan, 0.5]), (8, [0.5, inf]), (9, [0.5, -inf]),
           (10, [0.5]), (11, [0.5, 1.0, 2.0]), (12, [3e38, 0.5])]
    found = whiten(frame(ROWS, [(i, v, "a", "b", "c") for i, v in good + bad]))
    rows = found.orderBy("component", F.asc_nulls_last("vec_id")).collect()
    n, deviation, _, explained = plain([v for _, v in good])
    order = [0, 1, 3, 4, 2]
    assert [(r.vec_id, r.component, r.n) for r in rows] == [
        (good[i][0], c, 5) for c in (1, 2) for i in order]
    assert [r.deviation for r in rows] == [deviation[i] for i in order] * 2
    assert rows[0].identity_error < 1e-9
    assert np.allclose([rows[0].explained, rows[5].explained], explained, rtol=1e-9)


def test_no_variance_no_rows(frame):
    columns = whiten(frame(ROWS, [])).columns
    for rows in ([], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]):
        found = whiten(frame(ROWS, [(i, v, "a", "b", "c") for i, v in rows]))
        assert found.columns == columns and found.count() == 0


def test_rank_below_dimension(frame):
    found = whiten(frame(ROWS, [(i, [i / 8, i / 4, 0.0], "a", "b", "c") for i in range(9)]))
    assert {r.component for r in found.collect()} == {1}


def test_long_deviation(frame):
    rows = [(i, [(-1) ** i * 2e6, 0.0], "a", "b", "c") for i in range(4)]
    found = whiten(frame(ROWS, rows)).collect()
    assert [r.deviation for r in found] == [None if d >= 1 << 63 else d for d in plain(
        [v for _, v, *_ in rows], 1)[1]]
