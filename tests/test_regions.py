"""Region kernels against brute force and hand-made tiles."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
import pytest

from loamgrid.operators import regions as R


def flood(cls):
    h, w = cls.shape
    out = np.full((h, w), -1)
    for y in range(h):
        for x in range(w):
            if out[y, x] < 0:
                todo, label = [(y, x)], y * w + x
                while todo:
                    a, b = todo.pop()
                    if out[a, b] < 0:
                        out[a, b] = label
                        todo += [(p, q) for p, q in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)) if 0 <= p < h and 0 <= q < w and cls[p, q] == cls[y, x]]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_labels_equal_flood_fill(seed):
    cls = np.random.default_rng(seed).integers(0, 3, (17, 23))
    assert (R.label4(cls) == flood(cls)).all()


def test_outline_and_corners():
    square = np.ones((3, 3), bool)
    assert len(R.outline(square)) == 12
    assert [c[2] for c in R.corners(R.outline(square))] == [True] * 4
    ell = np.array([[1, 0], [1, 1]], bool)
    found = R.corners(R.outline(ell))
    assert sorted(c[2] for c in found) == [False] + [True] * 5
    assert sum(a for a, _, _ in found) == len(R.outline(ell)) == 8


def test_diagonal_pixels_are_two_regions():
    cls = np.array([[1, 0], [0, 1]])
    assert len(np.unique(R.label4(cls))) == 4
    ring = np.array([[1, 1, 1], [1, 0, 1], [1, 1, 1]], bool)
    assert len(R.outline(ring)) == 12  # the hole isn't on the outer ring


def test_right_angles_need_long_arms():
    m = np.ones((10, 10), bool)
    assert R.right_angles(m, 1.0) == (4, 4, 4)
    assert R.right_angles(m, 0.5) == (4, 0, 0)


def test_notch_takes_the_class_it_was_cut_from():
    cls = np.full((40, 40), 8)
    cls[10:22, 10:22] = 3
    assert (R.correct_array(cls, 1.0) == 8).all()  # its whole outline is shared with 8
    cls[:, 30:] = 5
    assert (R.correct_array(cls, 1.0, most_perimeter=10) == cls).all()  # too long an outline to be an artefact


def test_longer_shared_boundary_wins_a_tie():
    cls = np.full((30, 30), 1)
    cls[:, 15:] = 2
    cls[5:20, 8:24] = 9  # two corners with either neighbour; more boundary with 2
    out = R.correct_array(cls, 1.0)
    assert out[10, 12] == 2 and out[10, 2] == 1


def test_missing_neighbours_are_no_data(spark):
    own = pd.DataFrame([(1, 0, 0, r, c, 8) for r in range(4) for c in range(4)], columns=["tile_id", "dr", "dc", "r", "c", "cls"])
    got = R.post_process(spark.createDataFrame(own, "tile_id long, dr int, dc int, r int, c int, cls int"), "combined", edge=4).toPandas()
    assert len(got) == 16 and set(got.cls) == {2}


def test_rotated_rectangle():
    assert R.rotated_rectangle(np.array([(0, 0), (4, 0), (4, 2), (0, 2)])) == (4.0, 2.0)
    long, short = R.rotated_rectangle(np.array([(0, 1), (1, 0), (4, 3), (3, 4)]))
    assert abs(long - 18**0.5) < 1e-9 and abs(short - 2**0.5) < 1e-9


def test_small_regions_merge(spark):
    px = pd.DataFrame([(0, r, c, 7 if (r, c) == (1, 1) else 4) for r in range(3) for c in range(3)], columns=["tile_id", "r", "c", "v"])
    got = R.merge_small(spark.createDataFrame(px), "v", 2).toPandas()
    assert set(got.merged) == {4}


def test_simplify():
    assert R.simplify([(0, 0), (1, 0.01), (2, 0)], 0.1) == [(0, 0), (2, 0)]
    assert R.simplify([(0, 0), (1, 1), (2, 0)], 0.1) == [(0, 0), (1, 1), (2, 0)]


def test_correction_within_a_box_equals_correction_of_all():
    rng = np.random.default_rng(4)
    for noise, edge in ((0.3, 5.0), (0.05, 2.0), (0.1, 10.0)):
        blocks = rng.integers(0, 18, (12, 12)).repeat(8, 0).repeat(8, 1)
        cls = np.where(rng.random(blocks.shape) < noise, rng.integers(-1, 18, blocks.shape), blocks)
        part = R.correct_array(cls, edge, within=(32, 64, 32, 64))
        assert (part[32:64, 32:64] == R.correct_array(cls, edge)[32:64, 32:64]).all()


@pytest.mark.parametrize("mode", ["mc", "soil", "combined"])
def test_tiles_in_bulk_equal_pixels_with_missing_neighbours(spark, mode):
    """A 3 x 3 raster of tiles of noisy blocks without one of them: pixel rows and byte rows give the same."""
    from loamgrid.sources import files

    rng = np.random.default_rng(7)
    blocks = rng.integers(1, 18, (6, 6)).repeat(8, 0).repeat(8, 1)
    cls = np.where(rng.random(blocks.shape) < 0.1, rng.integers(1, 18, blocks.shape), blocks)
    there = [(y, x) for y in range(3) for x in range(3) if (y, x) != (2, 0)]
    px = [(3 * y + x, r, c, int(cls[16 * y + r, 16 * x + c])) for y, x in there for r in range(16) for c in range(16)]
    near = [(3 * y + x, dr, dc, 3 * (y + dr) + x + dc) for y, x in there for dr in (-1, 0, 1) for dc in (-1, 0, 1) if (y + dr, x + dc) in there]
    pixels = spark.createDataFrame(px, "tile_id long, r int, c int, cls int")
    halo = spark.createDataFrame(near, "tile_id long, dr int, dc int, neighbour_id long")
    rows = halo.join(pixels.withColumnRenamed("tile_id", "neighbour_id"), "neighbour_id").drop("neighbour_id")
    want = {tuple(r) for r in R.post_process(rows, mode, 16, 2.0).collect()}
    got = {tuple(r) for r in R.post_process_tiles(files.encode_tiles(pixels, "cls", 16, empty=255), halo, mode, 16, 2.0).collect()}
    assert got == want and len(got) == 8 * 256


def slanted(spark, width, height, c1, c2, px_dm, conf):
    """A slanted band of changed pixels: its box is large, its smallest rectangle is not."""
    px = [(1, k + w, 2 * k + w, c1, c2, px_dm, conf, conf) for k in range(height) for w in range(width)]
    return spark.createDataFrame(sorted({(1, r, c + d, *rest) for _, r, c, *rest in px for d in (0, 1)}), "tile_id long, r int, c int, y1 int, y2 int, px_dm int, conf1_milli int, conf2_milli int").withColumn("region", F.lit(0))


@pytest.mark.parametrize(("c1", "c2", "height", "px_dm", "want"), [(8, 1, 14, 10, 23), (8, 2, 6, 10, 25), (9, 2, 40, 5, 40)])
def test_tags_of_slanted_regions(spark, c1, c2, height, px_dm, want):
    from loamgrid.operators import changes

    px = slanted(spark, 1, height, c1, c2, px_dm, 500)
    s = changes.region_stats(px, ["tile_id", "region", "y1", "y2"]).first()
    r = R.rectangles(px, ["tile_id", "region"]).first()
    assert r.axis_ratio < 0.3 < s.short_axis / s.long_axis  # the box isn't thin
    df = spark.range(1).select(changes.tag(F.lit(c1), F.lit(c2), F.lit(s.area_m2), F.lit(0.5), F.lit(r.axis_ratio), F.lit(r.rectangularity), F.lit(r.short_axis), F.lit(s.fill)).alias("tag"))
    assert df.first().tag == want


def test_outlines_are_simplified(spark):
    px = spark.createDataFrame([(0, r, c) for r in range(8) for c in range(12) if (r, c) not in ((0, 11), (7, 0))], "tile_id long, r int, c int").withColumn("region", F.lit(1).cast("long"))
    whole, less = (R.outlines(px, ["tile_id", "region"], t).first() for t in (0.0, 1.5))
    assert whole.corners == 8 and len(whole.ring) == 9 and len(less.ring) < 9
    assert whole.ring[0] == whole.ring[-1] and less.ring[0] == less.ring[-1]


def test_outlines_of_many_regions_are_made_in_batches(spark):
    f = np.random.default_rng(3).integers(0, 3, (20, 20))
    labels = R.label4(f)
    px = spark.createDataFrame([(7, int(labels[r, c]), int(r), int(c)) for r, c in np.ndindex(*f.shape)], "tile_id long, region long, r int, c int")
    found = R.outlines(px, ["tile_id", "region"])
    assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r.region: (r.corners, [(p.x, p.y) for p in r.ring]) for r in found.collect()}
    assert set(got) == set(np.unique(labels).tolist())
    for i, (n, ring) in got.items():
        edges = R.outline(labels == i)
        want = [(x, y) for k, (x, y, dx, dy) in enumerate(edges) if (dx, dy) != edges[k - 1][2:]]
        assert n == len(want) and ring == [*want, want[0]]
