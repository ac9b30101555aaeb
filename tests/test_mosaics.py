"""Regions across tiles against a flood fill of the whole mosaic."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamgrid.operators import mosaics
from loamgrid.sources import shared


def flooded(field):
    """Row and column of the first pixel of each pixel's 4-connected region, one pixel after the other."""
    out = np.full(field.shape, -1, np.int64)
    for r, c in np.ndindex(*field.shape):
        if out[r, c] >= 0:
            continue
        todo, out[r, c] = [(r, c)], (r << 31) | c
        while todo:
            y, x = todo.pop()
            for a, b in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                if 0 <= a < field.shape[0] and 0 <= b < field.shape[1] and out[a, b] < 0 and field[a, b] == field[r, c]:
                    out[a, b] = out[r, c]
                    todo.append((a, b))
    return out


def spiral(n):
    """A path of ones, one pixel wide, that winds inwards from a corner over the whole field."""
    f = np.zeros((n, n), int)
    top, left, bottom, right = 0, 0, n - 1, n - 1
    r = c = 0
    f[0, 0] = 1
    while left <= right and top <= bottom:
        while c < right:
            c += 1
            f[r, c] = 1
        while r < bottom:
            r += 1
            f[r, c] = 1
        while c > left:
            c -= 1
            f[r, c] = 1
        while r > top + 2:
            r -= 1
            f[r, c] = 1
        top, left, bottom, right = top + 2, left + 2, bottom - 2, right - 2
        if left <= right and top <= bottom and r == top and c < left:
            f[r, c + 1] = 1
            c += 1
    return f


def as_tiles(spark, field, edge):
    rows = [(int(r // edge * 100 + c // edge), int(r % edge), int(c % edge), int(field[r, c]), 10) for r, c in np.ndindex(*field.shape)]
    px = spark.createDataFrame(rows, "tile_id long, r int, c int, v int, px_dm int").repartition(5)
    tiles = px.select("tile_id").distinct().selectExpr("tile_id", "CAST(tile_id div 100 AS INT) AS grow", "CAST(tile_id % 100 AS INT) AS gcol")
    return px, tiles


@pytest.mark.parametrize("field, edge", [(spiral(40), 8), (np.random.default_rng(1).integers(0, 2, (23, 31)), 8), (np.ones((20, 20), int), 4), (np.random.default_rng(2).integers(0, 3, (9, 14)), 1)], ids=["spiral", "noise cut off", "one", "single pixels"])
def test_regions_of_a_mosaic_equal_a_flood_fill(spark, field, edge):
    px, tiles = as_tiles(spark, field, edge)
    found = mosaics.mosaic_regions(px, "v", tiles, edge)
    got = {(r.gr, r.gc): r.region for r in found.collect()}
    want = flooded(field)
    assert got == {(r, c): int(want[r, c]) for r, c in np.ndindex(*field.shape)}
    sizes = {r.region: (r.n_px, r.area_m2) for r in mosaics.mosaic_stats(found).collect()}
    names, n = np.unique(want, return_counts=True)
    assert sizes == {int(a): (int(b), float(b)) for a, b in zip(names, n, strict=True)}


def test_spiral_is_one_region_over_all_tiles(spark):
    field = spiral(40)
    px, tiles = as_tiles(spark, field, 8)
    found = mosaics.mosaic_regions(px, "v", tiles, 8).where("v = 1")
    row = found.agg(F.countDistinct("region").alias("n"), F.countDistinct("tile_id").alias("tiles"), F.min("region").alias("first")).first()
    assert (row.n, row.tiles, row["first"]) == (1, 25, 0)


def test_missing_tiles_and_nulls_join_nothing(spark):
    px = spark.createDataFrame([(0, 0, 1, 5), (2, 0, 0, 5), (3, 0, 1, None), (4, 0, 0, None), (5, 0, 0, 7)], "tile_id long, r int, c int, v int")
    tiles = spark.createDataFrame([(0, 0, 0), (2, 0, 2), (3, 1, 0), (4, 1, 1), (5, 0, 3)], "tile_id long, grow int, gcol int")
    found = mosaics.mosaic_regions(px, "v", tiles, 2)
    assert found.select("region").distinct().count() == 5
    assert mosaics.mosaic_regions(px.limit(0), "v", tiles, 2).count() == 0


def test_scratch_deletes_all_but_what_is_kept(spark):
    before = len(shared._folders)
    with shared.scratch(spark) as kept:
        a, b = shared.cut(spark.range(3)), shared.cut(spark.range(4))
        kept.append(b)
    assert len(shared._folders) == before + 1 and b.count() == 4
    with pytest.raises(Exception):  # noqa: B017  the files are gone
        a.count()
    shared.drop_cuts(spark)
    assert not shared._folders
