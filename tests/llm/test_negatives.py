"""Hard negatives against scores of all pairs, and bounds against exact scores."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from textsignal.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, v string, anchor string, means string"


def plain(rows, every=100):
    good = [(i, l, [int(np.floor(256 * x)) for x in v]) for i, v, l in rows
            if i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a in {(i, l, tuple(v)) for i, l, v in good if i % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a[2], v)), i, l) for i, l, v in good if i != a[0] and len(v) == len(a[2]))
        for p, i, _ in [s for s in scored if s[2] == a[1]][:5]:
            hard = [s for s in scored if s[2] != a[1] and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(a[0], i, rank, j, -p, -s) for rank, (s, j, _) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, every=100):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return sorted(map(tuple, negatives.mine(negatives.whole_numbers(df), F.col("vec_id") % every == 0).collect()))


@pytest.mark.parametrize("size", [1, 3, 16, 37, 64])
def test_bounds_hold(size):
    rng = np.random.default_rng(size)
    rows, anchors = (np.floor(256 * rng.normal(size=(n, size))) for n in (200, 30))
    scores = rows @ anchors.T
    sides = [negatives.levels(*negatives.summarise(m), size) for m in (rows, anchors)]
    widths = []
    for level in negatives.LEVELS:
        under, over = negatives.bounds(*sides, level)
        assert (under <= scores).all() and (scores <= over).all()
        widths.append((over - under).mean())
        direct = negatives.bounds(*[{level: (lambda m, d: (m * np.sqrt(np.diff(negatives.edges(size, level))), d))(*negatives.summarise(m, level))} for m in (rows, anchors)], level)
        assert np.allclose(direct[0], under) and np.allclose(direct[1], over)
    assert all(a >= b - 1e-6 for a, b in zip(widths, widths[1:]))


@pytest.mark.parametrize("block, pairs", [(2048, 1_000_000), (3, 50)])
def test_odd_rows(spark, monkeypatch, block, pairs):
    """Nulls, non-finite components, several lengths, repeated and tied rows, labels of one row, negative scores."""
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", block)
    monkeypatch.setattr(negatives, "PAIRS", pairs)
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=20) + rng.integers(0, 3)).tolist(), int(i % 4)) for i in range(400)]
    rows += [(1000 + i, [float(rng.integers(0, 2)), 1.0, 0.0], int(i % 2)) for i in range(120)]
    rows += rows[:3] + [rows[5]] * 9 + rows[100:102] + [(200, rng.normal(size=20).tolist(), 1), (300, [1.0] * 20, 77)]
    rows += [(None, [1.0] * 20, 1), (500, None, 1), (600, [None] + [1.0] * 19, 1), (700, [float("nan")] * 20, 1), (800, [float("inf")] * 20, 1), (900, [1.0] * 20, None), (901, [], 2)]
    want = plain(rows)
    assert want and mined(spark, rows) == want


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
