"""Raster files: round trips, windows, and which strips are read."""

import os

import numpy as np
import pytest

from loamgrid.sources import rasters

RNG = np.random.default_rng(1)
FILES = {"a.tif": RNG.integers(0, 256, (40, 33), np.uint8), "b.tiff": RNG.integers(0, 256, (7, 5), np.uint8), "c.tif": np.zeros((1, 1), np.uint8)}


def write(spark, path, **k):
    rows = [(name, g.shape[1], g.shape[0], g.tobytes()) for name, g in FILES.items()]
    rasters.write_rasters(spark.createDataFrame(rows, "name string, width int, height int, data binary").repartition(2), path, **k)


@pytest.mark.parametrize("deflate, strip", [(True, 16), (False, 3), (True, 100)])
def test_round_trip_and_windows(spark, tmp_path, deflate, strip):
    path = str(tmp_path / "r")
    write(spark, path, rows_per_strip=strip, deflate=deflate)
    assert sorted(os.listdir(path)) == sorted(FILES)
    for window in (None, (5, 20, 2, 9), (38, 90, 30, 99), (60, 70, 0, 1)):
        r0, r1, c0, c1 = window or (0, 99, 0, 99)
        want = sorted((n, r, c, int(g[r, c])) for n, g in FILES.items() for r, c in np.ndindex(*g.shape) if r0 <= r < r1 and c0 <= c < c1)
        assert sorted(map(tuple, rasters.read_rasters(spark, path, window).collect())) == want
    n = sum((r >= 5) & (r < 20) & (c > 3) for g in FILES.values() for r, c in np.ndindex(*g.shape))
    for push in ("false", "true"):
        spark.conf.set("spark.sql.python.filterPushdown.enabled", push)
        assert rasters.read_rasters(spark, path).where("r >= 5 AND r < 20 AND c > 3").count() == n
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_only_the_windows_strips_are_read(spark, tmp_path):
    path = str(tmp_path / "r")
    write(spark, path, rows_per_strip=4)
    strips = lambda reader: sum(p.last - p.first for p in reader.partitions())
    assert strips(rasters.Reader(path, {})) == 10 + 2 + 1
    assert strips(rasters.Reader(path, {"r0": "8", "r1": "16"})) == 2
    pushed = rasters.PushedReader(path, {})
    list(pushed.pushFilters([rasters.GreaterThan(("r",), 11), rasters.LessThanOrEqual(("r",), 19), rasters.LessThan(("c",), 3)]))
    assert strips(pushed) == 2 and pushed.rows == [12, 20] and pushed.columns == [0, 3]


def test_odd_files_are_refused(spark, tmp_path):
    (tmp_path / "x.tif").write_bytes(b"II\x00\x00not a raster")
    with pytest.raises(ValueError, match="not a TIFF"):
        rasters.Reader(str(tmp_path), {}).partitions()
    with pytest.raises(ValueError, match="mounted"):
        rasters.local("hdfs://x/y")


def test_small_files_share_a_partition(tmp_path):
    for k in range(600):
        (tmp_path / f"{k}.tif").write_bytes(rasters.encode(bytes(64), 8, 8, 4, rasters.PLAIN))
    parts = rasters.Reader(str(tmp_path), {"r0": "4"}).partitions()
    assert len(parts) < 5 and sum(p.last - p.first for p in parts) == 600
    runs = [run for p in parts for run in p.runs]
    assert len(set(runs)) == 600 and {(a, b) for _, a, b in runs} == {(1, 2)}
    assert sum(b.num_rows for p in parts for b in rasters.Reader(str(tmp_path), {"r0": "4"}).read(p)) == 600 * 32
