"""Files that a Morton store opens, and zone means, against plain passes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamgrid.operators import zonal
from loamgrid.sources import tile_store


def interleaved(x, y):
    return sum((x >> k & 1) << 2 * k | (y >> k & 1) << 2 * k + 1 for k in range(tile_store.BITS))


def test_morton_codes_and_ranges(spark):
    rng = random.Random(1)
    cells = [(rng.randrange(1 << 24), rng.randrange(1 << 24)) for _ in range(50)] + [(0, 0), ((1 << 24) - 1, (1 << 24) - 1)]
    got = spark.createDataFrame(cells, "x long, y long").select("x", "y", tile_store.morton(F.col("x"), F.col("y")).alias("code")).collect()
    assert all(r.code == interleaved(r.x, r.y) for r in got)
    for most in (1, 8, 1000):
        for _ in range(20):
            x0, y0 = rng.randrange(60), rng.randrange(60)
            x1, y1 = x0 + rng.randrange(20), y0 + rng.randrange(20)
            found = tile_store.ranges(x0, y0, x1, y1, most)
            assert all(a[1] + 1 < b[0] for a, b in zip(found, found[1:], strict=False))
            codes = {interleaved(x, y) for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)}
            assert all(any(a <= c <= b for a, b in found) for c in codes)
            if most == 1000:
                assert sum(b - a + 1 for a, b in found) == len(codes)


def test_store_opens_few_files(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, float(x := rng.randrange(-500, 500)), float(y := rng.randrange(-500, 500)), x + rng.random() * 9, y + rng.random() * 9) for k in range(4000)]
    df = spark.createDataFrame([*rows, (9000, None, 1.0, 2.0, 2.0)], "id int, x0 double, y0 double, x1 double, y1 double")
    path = str(tmp_path / "store")
    tile_store.write_store(df, path, 4, 40)
    assert tile_store.read_store(spark, path).count() == 4000
    n = len(spark.read.parquet(path).inputFiles())
    for within in ((0, 0, 30, 30), (-490, 400, -470, 410), (495, 495, 600, 600), (-600, -600, -590, -590)):
        found = tile_store.read_store(spark, path, within)
        assert sorted(r.id for r in found.collect()) == sorted(r[0] for r in rows if r[1] <= within[2] and r[3] >= within[0] and r[2] <= within[3] and r[4] >= within[1])
        assert len(found.inputFiles()) <= n / 5
    pushed = tile_store.read_store(spark, path, (0, 0, 30, 30))._jdf.queryExecution().executedPlan().toString()
    assert "And(LessThanOrEqual(_cod" in pushed.partition("PushedFilters")[2]


def test_store_of_nothing(spark, tmp_path):
    path = str(tmp_path / "empty")
    tile_store.write_store(spark.createDataFrame([], "id int, x0 double, y0 double, x1 double, y1 double"), path, 4, 4)
    assert tile_store.read_store(spark, path, (0, 0, 1, 1)).count() == 0


@pytest.mark.parametrize("block", [4, 16])
def test_zone_means_equal_passes_over_pixels(spark, block):
    rng = np.random.default_rng(3)
    grid = rng.integers(0, 100, (30, 41))
    there = rng.random(grid.shape) < 0.9
    rows = [(int(r), int(c), None if grid[r, c] == 7 else int(grid[r, c])) for r, c in zip(*np.nonzero(there), strict=True)]
    px = spark.createDataFrame(rows, "r int, c int, v int").repartition(3)
    zones = [(k, int(x), int(y), int(x + w), int(y + h)) for k, (x, y, w, h) in enumerate(zip(rng.integers(-5, 45, 80), rng.integers(-5, 35, 80), rng.integers(0, 30, 80), rng.integers(0, 30, 80), strict=True))]
    got = {r.id: (r.n, r.v) for r in zonal.box_means(spark.createDataFrame(zones, "id int, x0 int, y0 int, x1 int, y1 int"), zonal.summed_areas(px, ["v"], block), ["v"], block).collect()}
    want = {}
    for k, x0, y0, x1, y1 in zones:
        own = [v for r, c, v in rows if y0 <= r < y1 and x0 <= c < x1]
        some = [v for v in own if v is not None]
        if own:
            want[k] = (len(own), pytest.approx(sum(some) / len(some)) if some else None)
    assert got == want
