"""Corners, candidates and neighbours in expressions against walks round single regions; rectangles against numpy."""

import numpy as np
import pytest

from loamgrid.operators import boundaries
from loamgrid.operators import regions as R
from loamgrid.sources import shared

KEYS = ["tile_id"]


def fields():
    rng = np.random.default_rng(5)
    out = [rng.integers(0, 2, (9, 9)), rng.integers(0, 3, (12, 7)), np.zeros((5, 6), int)]
    ring = np.zeros((8, 8), int)
    ring[1:7, 1:7], ring[2:4, 2:4], ring[4:6, 4:6] = 1, 2, 3  # holes that touch at a corner
    return [*out, ring]


def labelled(spark, all_fields, edge_dm=10):
    rows = [(t, int(r), int(c), int(f[r, c]), edge_dm) for t, f in enumerate(all_fields) for r, c in np.ndindex(*f.shape)]
    return R.polygonize(spark.createDataFrame(rows, "tile_id long, r int, c int, v int, px_dm int").repartition(3), "v")


def masks(f):
    labels = R.label4(f)
    for i in np.unique(labels).tolist():
        y, x = divmod(i, f.shape[1])
        yield y * 65536 + x, labels == i, labels


def test_outer_corners_equal_walks(spark):
    px = labelled(spark, fields())
    got = {}
    for r in boundaries.outer_corners(boundaries.arms(boundaries.sides(px, KEYS), KEYS), KEYS).collect():
        got.setdefault((r.tile_id, r.region), []).append((r.before, r.after, r.convex))
    want = {(t, name): sorted(R.corners(R.outline(mask))) for t, f in enumerate(fields()) for name, mask, _ in masks(f)}
    assert {k: sorted(v) for k, v in got.items()} == want


@pytest.mark.parametrize("least", [0.5, 3.0])
def test_candidates_equal_walks(spark, least):
    px = labelled(spark, fields())
    got = {(r.tile_id, r.region): (r.convex, r.perimeter_m) for r in boundaries.candidates(px, KEYS, most_perimeter=30, least_fill=0.5, least_product=least).collect()}
    want = {}
    for t, f in enumerate(fields()):
        around = R.perimeter(R.label4(f))
        for name, mask, labels in masks(f):
            y, x = np.nonzero(mask)
            box = (np.ptp(y) + 1) * (np.ptp(x) + 1)
            convex = sum(c for a, b, c in R.corners(R.outline(mask)) if a * b > least)
            n = around[int(labels[mask][0])]
            if 0 < convex < 5 and n < 30 and mask.sum() / box > 0.5:
                want[t, name] = (convex, float(n))
    assert got == want


def test_neighbours_equal_walks(spark):
    """Of regions without holes, where the whole boundary is the outer ring."""
    px = labelled(spark, fields())
    got = {(r.tile_id, r.region, r.neighbour): (r.angles, r.shared_px) for r in boundaries.neighbours(px, KEYS, least_product=0.5).collect()}
    checked = 0
    for t, f in enumerate(fields()):
        for name, mask, labels in masks(f):
            edges = R.outline(mask)
            if len(edges) != R.perimeter(labels)[int(labels[mask][0])]:
                continue
            right = R.right_labels(edges, np.pad(labels, 1, constant_values=-1))
            for j in set(right) - {-1}:
                y, x = divmod(j, f.shape[1])
                assert got[t, name, y * 65536 + x] == R.shared_right_angles(edges, [k == j for k in right], 1.0, 0.5)
                checked += 1
    assert checked > 50


def test_best_neighbour_by_angles_then_length_then_label(spark):
    f = np.array([[1, 1, 1, 1, 1], [1, 9, 9, 2, 1], [1, 9, 9, 2, 1], [1, 1, 1, 1, 1]])
    px = labelled(spark, [f])
    best = {r.region: (r.neighbour, r.angles, r.shared_px) for r in boundaries.best_neighbours(px, KEYS, least_product=1.5).collect()}
    # the square's right side is its neighbour 2's, its left corners are inside of region 1
    assert best[65536 + 1] == (0, 2, 6)
    assert best[65536 + 3] == (0, 2, 4)


def test_rectangles_equal_numpy(spark):
    px = labelled(spark, fields(), 20)
    got = {(r.tile_id, r.region): r for r in R.rectangles(px, ["tile_id", "region"]).collect()}
    n = 0
    for t, f in enumerate(fields()):
        for name, mask, _ in masks(f):
            y, x = np.nonzero(mask)
            points = np.concatenate([np.stack([x + a, y + b], 1) for a in (0, 1) for b in (0, 1)])
            long, short = R.rotated_rectangle(points)
            r = got[t, name]
            assert (r.long_axis, r.short_axis, r.axis_ratio, r.rectangularity) == pytest.approx((2 * long, 2 * short, short / long, mask.sum() / (long * short)), abs=1e-8)
            n += 1
    assert n == len(got)


def test_outer_corners_need_no_joins_and_no_tables_in_between(spark):
    written = list(shared._folders)
    found = boundaries.outer_corners(boundaries.arms(boundaries.sides(labelled(spark, fields()), KEYS), KEYS), KEYS)
    assert shared._folders == written
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() > 0


def test_candidates_need_no_joins_and_no_tables_in_between(spark):
    written = list(shared._folders)
    found = boundaries.candidates(labelled(spark, fields()), KEYS, most_perimeter=30, least_fill=0.5, least_product=0.5)
    assert shared._folders == written
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() > 0
