"""Operator 11 against brute force: bounds, ties, nulls, repeated ids, widths of numbers, many blocks."""

import math
import random

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from labelsmith.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, anchor string, id int"


def _brute(rows, positives=5, negatives=3, low=50, high=95):
    kept = []
    for r in rows:
        i, v, label = r[:3]
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(x * x for x in q) < 1 << 56:
            kept.append((i, q, label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for n, (i, q, label) in enumerate(kept):
        if i is None or i % 50:
            continue
        same = sorted(((dot(q, x), j) for m, (j, x, y) in enumerate(kept) if y == label and m != n), key=order)
        other = sorted(((dot(q, x), j) for j, x, y in kept if y != label), key=order)
        for p, j in same[:positives]:
            found = [s for s in other if low * p <= 100 * s[0] <= high * p][:negatives]
            out += [(i, j, k + 1, s[1], p, s[0]) for k, s in enumerate(found)]
    return sorted(out, key=repr)


def _run(spark, rows):
    df = spark.createDataFrame([(*r, "own", 7) for r in rows], SCHEMA)
    got = hn.hard_negatives(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()), key=repr)


def _rows(seed, n, dim, scale, labels=3):
    rnd = random.Random(seed)
    heads = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    return [(rnd.randrange(0, 10 * n), [scale * (x + rnd.gauss(0, 0.4)) for x in rnd.choice(heads)], rnd.randrange(labels)) for _ in range(n)]


@pytest.mark.parametrize("scale", [0.02, 1.0, 3e3, 1e5])
def test_against_brute_force_in_many_blocks(spark, monkeypatch, scale):
    for name, value in {"WINDOW": 8, "BLOCK": 20, "SPAN": 2, "ANCHOR_BLOCKS": 3, "ANCHOR_SETS": 2, "SAMPLE": 64, "DIRECTIONS": 5}.items():
        monkeypatch.setattr(hn, name, value)
    rows = _rows(3, 260, 6, scale)
    rows += [(50 * k, v, y) for k, (_, v, y) in enumerate(rows[:12])]  # anchors, some of them copies
    assert _run(spark, rows) == _brute(rows)


def test_nulls_lengths_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = _rows(5, 80, 4, 1.0, 2) + [
        (0, [0.5, 0.5], 1), (0, [0.5, 0.5], 1), (0, [0.5, 0.5, 0.1, 0.0, 0.9], 0), (100, [], 1), (150, [0.0, 0.0, 0.0, 0.0], 0),
        (200, None, 1), (250, [1.0, None], 1), (300, [nan], 1), (350, [inf, 1.0], 0), (400, [1.0, 1.0], None), (None, [0.9, 0.9, 0.9, 0.9], 0),
        (None, [0.9, 0.9, 0.9, 0.9], 1), (450, [1e30, 1.0], 1), (500, [-0.7, -0.7, -0.7, -0.7], 1), (550, [0.9, 0.9, 0.9, 0.9], 0), (-50, [0.9, 0.8, 0.9, 0.9], 1)]
    got = _run(spark, rows)
    assert got == _brute(rows)
    assert any(None in (r[1], r[3]) for r in got) and {r[0] for r in got} >= {0, 550, -50}


def test_empty_and_no_anchor(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    assert _run(spark, [(50, [1.0], 0)]) == []
    assert _run(spark, [(None, None, None)]) == []


def test_bounds_hold_every_score():
    rnd = np.random.default_rng(1)
    for scale in (1e-2, 1.0, 1e4):
        q = np.floor(256 * scale * rnd.normal(size=(300, 5)) * rnd.random((300, 1)))
        q[:3] = 0
        q[3:6] = q[9:12]
        q[6:9] = -q[9:12]
        norms = np.sqrt((q * q).sum(1))
        angles = hn._angles(q, norms, hn.fit_directions((q[:50] / 256).tolist(), 4))
        z = np.zeros(len(q), np.int64)
        b = hn.Block(z, z, z, z, norms, angles.astype("<f4").astype(float), q.astype("<i4"))
        w = hn.Windows([(b, b.vecs)])
        low, high = w.bounds(b)
        exact = q.astype(object) @ q.astype(object).T
        for j, (_, i) in enumerate(w.at):
            s = exact[:, i:i + hn.WINDOW]
            assert (s.min(1) >= low[:, j]).all() and (s.max(1) <= high[:, j]).all()


def test_windows_are_skipped_where_directions_part():
    """Rows around far apart directions: an anchor's bounds leave most windows out."""
    rnd = np.random.default_rng(2)
    heads = np.linalg.qr(rnd.normal(size=(32, 32)))[0][:8]
    x = np.repeat(heads, hn.WINDOW, axis=0) + 0.01 * rnd.normal(size=(8 * hn.WINDOW, 32))
    q = np.floor(256 * x)
    norms = np.sqrt((q * q).sum(1))
    angles = hn._angles(q, norms, hn.fit_directions(x[::40].tolist(), 8))
    z = np.zeros(len(q), np.int64)
    w = hn.Windows([(hn.Block(z, z, z, z, norms, angles, q.astype("<i4")), q)])
    anchor = hn.Block(z[:1], z[:1], z[:1], z[:1], norms[:1], angles[:1], q[:1].astype("<i4"))
    _, high = w.bounds(anchor)
    assert (high[0] >= 0.9 * norms[0] ** 2).sum() == 1


def test_query_rows(spark):
    got = hn.op11_hard_negatives(spark, SF_SMALL)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
