"""Queries that run on whole tables against DuckDB and brute force, on tables larger than any cut of the SQL'd ones."""

import os
from collections import Counter

import duckdb
import pytest

from loamgrid.plans import grid_queries, registry  # noqa: F401  registers the queries
from loamgrid.sources.fixtures import boxes, pixels

from .test_queries import rows

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def equal_sql(spark, db, name):
    got, want = rows(registry.QUERIES[name](spark, SF).toPandas()), rows(db.execute(registry.SQL[name]).df())
    assert got == want


TILES = ["rs11_region_labels", "rs21_component_stats", "ag15_zonal_conf", "rs12_region_sizes_back", "jn6_touching_regions", "wn1_so4_best_neighbour", "fl8_candidates", "rs22_monitor_tags", "ag12_change_histogram"]


@pytest.mark.parametrize("name", TILES)
def test_all_tiles_equal_sql(spark, db, name):
    assert "tile_id <" not in registry.SQL[name]
    equal_sql(spark, db, name)


@pytest.mark.parametrize("name", ["rs11_region_labels", "rs22_monitor_tags", "rs17_rs19_corrected", "rs21_rotated_rectangles"])
def test_no_tile_is_left_out(spark, name):
    tiles = lambda df: {r.tile_id for r in df.select("tile_id").distinct().collect()}
    want = tiles(pixels(spark, SF))
    assert len(want) > 12 and tiles(registry.QUERIES[name](spark, SF)) == want


@pytest.mark.parametrize("name", ["rs10_rasterized", "tg8_matrix_tiles", "tg8b_same_aspect"])
def test_all_boxes_equal_sql(spark, db, name):
    assert not any(cut in registry.SQL[name] for cut in ("id <", "id %", "40000"))
    equal_sql(spark, db, name)


def test_all_contiguous_boxes_equal_brute_force(spark):
    b = [(r.id, r.x0 // 2, r.y0 // 2) for r in boxes(spark, SF).collect()]
    root = {k: k for k, _, _ in b}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, x, y in b:
        for m, u, v in b:
            if m < k and abs(x - u) <= 2 and abs(y - v) <= 2:
                p, q = sorted((find(k), find(m)))
                root[q] = p
    top = {k: find(k) for k in root}
    members = Counter(top.values())
    got = {(r.id, r.root, r.members) for r in registry.QUERIES["jn12_vg6_contiguous"](spark, SF).collect()}
    assert len(got) == len(b) > 1600 and got == {(k, r, members[r]) for k, r in top.items()}


@pytest.mark.parametrize("name", ["jn7_contains_join", "jn9_intersects_mask", "jn10_jn16_clipped_pairs", "fl13_st5_coverage"])
def test_all_pairs_of_boxes_equal_sql(spark, db, name):
    assert "id %" not in registry.SQL[name].split("FROM part)")[1]
    equal_sql(spark, db, name)
