"""Areas of layers of boxes against a raster of all their coordinates."""

import random

import pytest

from loamgrid.operators import overlay

DDL = "id long, x0 double, y0 double, x1 double, y1 double"


def shares(boxes, others, min_n):
    """For each box its area, and the area on which at least min_n of others lie, by all cells between all coordinates."""
    every = boxes + others
    xs, ys = (sorted({b[k] for b in every for k in pair}) for pair in ((1, 3), (2, 4)))
    out = {b[0]: [0.0, 0.0] for b in boxes}
    for xa, xb in zip(xs, xs[1:], strict=False):
        for ya, yb in zip(ys, ys[1:], strict=False):
            over = lambda b: b[1] <= xa and b[3] >= xb and b[2] <= ya and b[4] >= yb  # noqa: B023, E731
            n = sum(map(over, others))
            for b in boxes:
                if over(b):
                    out[b[0]][0] += (xb - xa) * (yb - ya)
                    out[b[0]][1] += (xb - xa) * (yb - ya) if n >= min_n else 0
    return out


def random_boxes(rng, n, first=0, step=0.5, top=40):
    out = []
    for k in range(n):
        x, y = rng.randrange(-top, top) * step, rng.randrange(-top, top) * step
        out.append((first + k, x, y, x + rng.randrange(0, top) * step, y + rng.randrange(0, top) * step))
    return out


@pytest.mark.parametrize("seed, most", [(0, 128), (1, 3), (2, 1)])
def test_coverage_equals_raster(spark, monkeypatch, seed, most):
    monkeypatch.setattr(overlay, "MOST_IN_CELL", most)
    monkeypatch.setattr(overlay, "MOST_CUTS", 3)
    rng = random.Random(seed)
    a, b = random_boxes(rng, 25), random_boxes(rng, 20, 100)
    a += [(50, 1.0, 1.0, 5.0, 5.0), (51, 1.0, 1.0, 5.0, 5.0), (52, 3.0, 3.0, 3.0, 9.0)]  # equal ones, an empty one
    left, right = spark.createDataFrame(a, DDL), spark.createDataFrame(b, DDL)
    for others, n, want in ((None, 2, shares(a, a, 2)), (right, 1, shares(a, b, 1))):
        got = {r.id: (r.area, r.covered) for r in overlay.coverage(left, others, cell=8).collect()}
        assert set(got) == {r[0] for r in a}, n
        for k, (area, covered) in want.items():
            assert got[k] == pytest.approx((area, covered), abs=1e-9), (k, n)
    got = overlay.overlay_areas(left, right, cell=8).first()
    everything = [(0, -100.0, -100.0, 100.0, 100.0)]
    l, r, u = (shares(everything, x, 1)[0][1] for x in (a, b, a + b))
    assert (got.left_area, got.right_area, got.union_area, got.both_area, got.left_only, got.right_only) == pytest.approx((l, r, u, l + r - u, u - r, u - l))


def test_two_halves_cover_a_box(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 20.0, 0.0, 30.0, 10.0)], DDL)
    right = spark.createDataFrame([(7, 0.0, 0.0, 5.0, 10.0), (8, 5.0, 0.0, 10.0, 10.0), (9, 20.0, 0.0, 25.0, 10.0)], DDL)
    assert {r.id: r.covered for r in overlay.coverage(left, right).collect()} == {1: 100.0, 2: 50.0}
    assert [(r.id, r.share) for r in overlay.left_over(left, right, 0.4).collect()] == [(2, 0.5)]


def test_many_equal_boxes_are_one_with_a_weight(spark):
    rows = [(k, 0.0, 0.0, 8.0, 8.0) for k in range(3000)] + [(5000, 4.0, 0.0, 12.0, 8.0), (5001, 100.0, 0.0, 108.0, 8.0)]
    df = spark.createDataFrame(rows, DDL).repartition(4)
    ends = overlay._swept(overlay._rects(overlay._cells(overlay._as_layer(df, "own"), 16), ["own"]), ["own"])
    assert ends.count() < 20
    got = {r.id: r.covered for r in overlay.coverage(df, cell=16).collect()}
    assert len(got) == 3002 and got[0] == got[2999] == 64 and got[5000] == 32 and got[5001] == 0


def test_nothing_and_nulls(spark):
    none = spark.createDataFrame([], DDL)
    assert overlay.coverage(none).count() == 0 and overlay.overlay_areas(none, none).count() == 0
    some = spark.createDataFrame([(1, None, 0.0, 1.0, 1.0), (2, 0.0, 0.0, 1.0, 1.0)], DDL)
    assert {r.id: r.covered for r in overlay.coverage(some).collect()} == {1: 0.0, 2: 0.0}
