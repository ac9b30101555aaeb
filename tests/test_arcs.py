"""Shared outlines: exact without tolerance, and fitting together with it."""

import numpy as np
import pytest

from loamgrid.operators import arcs
from loamgrid.operators import regions as R
from loamgrid.sources import shared

from .test_boundaries import fields, labelled, masks


def area(ring):
    return sum(a[1] * b[0] - a[0] * b[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


def points(rings):
    return [[(p["x"], p["y"]) for p in ring] for ring in rings]


def inside(rings, x, y):
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            n += (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay)
    return n % 2 == 1


@pytest.mark.parametrize("tolerance", [0.0, 0.8])
def test_outlines_fit_together(spark, tolerance):
    rng = np.random.default_rng(9)
    blobs = (np.add.outer(np.arange(14), np.arange(16)) // 5 + (rng.random((14, 16)) < 0.1)).astype(int)
    every = [*fields(), blobs]
    got = {}
    for r in arcs.shared_outlines(labelled(spark, every), ["tile_id"], tolerance).collect():
        got[r.tile_id, r.region] = (points(r.rings), r.area_px)
    for t, f in enumerate(every):
        names = dict((name, mask) for name, mask, _ in masks(f))
        assert {k[1] for k in got if k[0] == t} == set(names)
        assert sum(v for k, (_, v) in got.items() if k[0] == t) == pytest.approx(f.size)
        # each stretch of a border is there as often in either direction, but for the raster's own outline; once without
        # tolerance, while simplified arcs of a thin region may come to lie on each other
        steps = [step for k, (rings, _) in got.items() if k[0] == t for ring in rings for step in zip(ring, ring[1:], strict=False)]
        h, w = f.shape
        for a, b in steps:
            outer = a[0] == b[0] in (0, w) or a[1] == b[1] in (0, h)
            n = steps.count((a, b))
            assert outer or (n == steps.count((b, a)) and (n == 1 or tolerance))
        for name, mask in names.items():
            rings, size = got[t, name]
            assert size == pytest.approx(sum(map(area, rings))) and area(rings[0]) >= 0
            if not tolerance:
                assert size == mask.sum()
                assert all(inside(rings, c + 0.5, r + 0.5) == mask[r, c] for r, c in np.ndindex(*f.shape))
                edges = R.outline(mask)
                outer = [(x, y) for k, (x, y, dx, dy) in enumerate(edges) if (dx, dy) != edges[k - 1][2:]]
                assert set(outer) <= set(rings[0])


def test_simplified_outlines_have_fewer_points(spark):
    f = (np.add.outer(np.arange(20), np.arange(20)) > 19).astype(int)
    px = labelled(spark, [f])
    n = [sum(len(r) for row in arcs.shared_outlines(px, ["tile_id"], t).collect() for r in row.rings) for t in (0.0, 1.0)]
    assert n[0] > 70 and n[1] < 20


def test_chains_are_ranked(spark):
    rows = [(k, None if k % 10 == 0 else k - 1) for k in range(57)]
    assert {r.node: r.rank for r in arcs.ranked(spark.createDataFrame(rows, "node long, before long")).collect()} == {k: k % 10 for k in range(57)}


def test_rings_are_ordered_within_their_tile():
    following = np.array([3, 4, 2, 0, 6, 1, 5])
    head, rank = arcs.ring_order(following, np.array([5, 6, 0, 2, 1, 3, 4]))
    assert head.tolist() == [3, 4, 2, 3, 4, 4, 4]
    assert rank.tolist() == [1, 3, 0, 0, 0, 2, 1]


def test_outlines_need_no_joins_and_no_tables_in_between(spark):
    written = list(shared._folders)
    found = arcs.shared_outlines(labelled(spark, fields()), ["tile_id"], 0.5)
    assert shared._folders == written
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() > 0
