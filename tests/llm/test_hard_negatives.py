"""Hard negatives against all inner products; bounds of scores; edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from compare import duck, duck_rows, spark_rows
from pyspark.sql import functions as F

from fleetgauge.llm import hard_negatives, oracle, queries
from fleetgauge.llm.hard_negatives import (
    MiningSettings, _Rows, angles_to, mine_negatives, score_bounds)

ROWS = "vec_id BIGINT, label INT, embedding ARRAY<FLOAT>, x STRING, score STRING, anchors STRING"
SMALL = MiningSettings(directions=3, block_bytes=200, anchor_bytes=100, group=2)


def plain(rows, is_anchor, positives=5, negatives=10):
    """All inner products, in whole numbers."""
    points = {}
    for vec_id, label, vector in sorted(rows, key=lambda r: (r[1], r[2])):
        points.setdefault(vec_id, (label, [math.floor(256 * c) for c in vector]))
    out = []
    for a, (label, x) in points.items():
        if not is_anchor(a):
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y, strict=True)), i, other)
                         for i, (other, y) in points.items() if i != a))
        for score, positive, other in [s for s in scored if s[2] == label][:positives]:
            fits = [(-s, i) for s, i, o in scored if o != label and -30 * score <= -100 * s <= -90 * score]
            out += [(a, positive, rank, i, -score, s)
                    for rank, (s, i) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_query_equals_sql(spark, folder):
    folder = f"/root/testdata/{folder}"
    got = spark_rows(queries.op13_hard_negatives(spark, folder))
    assert got == duck_rows(duck(folder), oracle.expected()["op13_hard_negatives"])


@pytest.mark.parametrize("kind", ["clusters", "ties", "norms", "no directions", "large"])
def test_equals_all_products(frame, kind):
    rng = np.random.default_rng(len(kind))
    n, d = 160, 6
    centres = rng.normal(size=(4, d))
    x = centres[rng.integers(0, 4, n)] + 0.2 * rng.normal(size=(n, d))
    if kind == "ties":
        x = rng.integers(-1, 2, size=(n, 3)).astype(float)  # zero vectors and many equal ones
    if kind == "norms":
        x = x * 10.0 ** rng.integers(-3, 4, (n, 1))
    if kind == "large":
        x = x * 1e5
    settings = SMALL if kind != "no directions" else MiningSettings(directions=0, sample=0, block_bytes=99)
    rows = [(i, int(rng.integers(0, 3)), np.float32(v).tolist()) for i, v in enumerate(x)]
    got = mine_negatives(frame(ROWS, [(*r, "a", "b", "c") for r in rows]), F.col("vec_id") % 4 == 0,
                         settings)
    assert found(got) == plain(rows, lambda i: i % 4 == 0) != []


def test_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    good = [(i, i % 2, np.float32(rng.normal(size=3) + 1).tolist()) for i in range(40)]
    good += [(2, 1, [0.5, 0.5, 0.5]), (2, 0, [1.0, 1.0, 1.0]), good[5], good[5]]  # repeated ids
    bad = [(None, 1, [1.0, 1.0, 1.0]), (50, None, [1.0, 1.0, 1.0]), (51, 1, None), (52, 1, []),
           (53, 1, [nan, 1.0, 1.0]), (54, 1, [inf, 1.0, 1.0]), (55, 0, [None, 1.0, 1.0]),
           (56, 0, [1.0, 1.0]), (57, 1, [3e38, 1.0, 1.0]), (58, 7, [1.0, 1.0, 1.0])]
    got = mine_negatives(frame(ROWS, [(*r, "a", "b", "c") for r in good + bad]), F.col("vec_id") % 2 == 0,
                         SMALL)
    assert found(got) == plain(good + bad[-1:], lambda i: i % 2 == 0) != []


def test_few_rows(frame):
    for rows in ([], [(0, 1, [1.0])], [(0, 1, [1.0]), (1, 1, [1.0])], [(1, 1, [1.0]), (2, 2, [1.0])]):
        got = mine_negatives(frame(ROWS, [(*r, "a", "b", "c") for r in rows]), F.col("vec_id") == 0)
        assert found(got) == [] and len(got.columns) == 6


def test_one_label_has_most_rows(frame):
    rng = np.random.default_rng(8)
    rows = [(i, int(i % 10 == 0), np.float32(rng.normal(size=4)).tolist()) for i in range(300)]
    got = mine_negatives(frame(ROWS, [(*r, "a", "b", "c") for r in rows]), F.col("vec_id") % 5 == 0, SMALL)
    assert found(got) == plain(rows, lambda i: i % 5 == 0)


def test_bounds_hold_and_exclude():
    """No score leaves its bounds, and on clustered rows the filter spares most products."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    groups = [np.floor(256 * (c + 0.03 * rng.normal(size=(50, 16)))).astype(np.int32) for c in centres]
    asked, held = np.concatenate(groups)[::9], 0

    def packed(x):
        angles = angles_to(x, centres).astype(np.float32)
        return _Rows(np.arange(len(x)).tobytes(), [0] * len(x), x.tobytes(), angles.tobytes(), len(x))

    anchors = packed(asked)
    for group in groups:
        rows = packed(group)
        lower, upper = score_bounds(anchors.angles, anchors.norms, rows, slice(None))
        scores = asked.astype(np.int64) @ group.astype(np.int64).T
        assert (lower <= scores.min(axis=1)).all() and (scores.max(axis=1) <= upper).all()
        held += int((upper >= 0.8 * 65536).sum())
    assert held < 0.3 * len(asked) * len(groups)


def test_filter_spares_rows(spark, monkeypatch):
    """Fewer products are taken than there are pairs, with the same result."""
    taken = []
    scores = _Rows.scores
    monkeypatch.setattr(_Rows, "scores", lambda self, x, a, b: taken.append(len(x) * (b - a)) or scores(
        self, x, a, b))
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    x = np.floor(256 * np.repeat(centres, 40, axis=0) + 5 * rng.normal(size=(240, 12))).astype(np.int32)
    angles = angles_to(x, centres / np.linalg.norm(centres, axis=1, keepdims=True)).astype(np.float32)
    rows = _Rows(np.arange(240).tobytes(), [0] * 240, x.tobytes(), angles.tobytes(), 240)
    least = (x.astype(float) ** 2).sum(axis=1) * 0.8
    hits = {(int(i), start + int(j)) for start, _, able, s in hard_negatives._stretches(
        rows, rows, True, lambda: (least, np.inf)) for k, i in enumerate(able)
        for j in np.flatnonzero(s[k] >= least[i])}
    every = x.astype(np.int64) @ x.astype(np.int64).T
    assert hits == {(int(i), int(j)) for i, j in zip(*np.nonzero(every >= least[:, None]), strict=True)}
    assert sum(taken) < 0.5 * 240 * 240
