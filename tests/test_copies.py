"""Tables in which many rows are equal but for their ids: the same results as SQL, with each different row worked on once."""

import re

import duckdb
import pytest

from loamgrid.operators import copies, polygons
from loamgrid.plans import grid_queries, polygon_queries, range_join, registry  # noqa: F401  registers the queries
from loamgrid.sources.fixtures import boxes

from .test_polygons import RINGS, inside
from .test_queries import rows

BOXES = ["jn7_contains_join", "jn9_intersects_mask", "jn10_jn16_clipped_pairs", "jn11_vg2_box_iou_pairs", "jn12_vg6_contiguous", "sc18_clip_dissolve"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """150 boxes, every third of which is there nine times, and one that touches no other."""
    path = tmp_path_factory.mktemp("copies")
    duckdb.sql(f"COPY (SELECT CAST(k + 400 * i AS BIGINT) AS p_partkey, CAST(1 + k * 7 % 50 AS INT) AS p_size FROM range(1, 151) a(k), range(9) b(i) WHERE i = 0 OR k % 3 = 0) TO '{path}/part.parquet'")
    duckdb.sql(f"COPY (SELECT * FROM read_parquet('/root/testdata/sf0.001/nation.parquet')) TO '{path}/nation.parquet'")
    return str(path)


def sql(folder, name):
    c = duckdb.connect()
    for t in ("part", "nation"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return rows(c.execute(registry.SQL[name]).df())


@pytest.mark.parametrize("name", BOXES)
def test_equal_boxes_meet_once(spark, folder, monkeypatch, name):
    monkeypatch.setattr(copies, "MOST_IDS", 4)
    met = []

    def spy(f):
        def run(left, right, cell, on=None, *rest, **more):
            # each box once, or once for each list of its ids
            most = 1 + (9 - 1) // copies.MOST_IDS if "ids" in left.columns else 1
            met.append(left.groupBy(*(on or []), "x0", "y0", "x1", "y1").count().where(f"count > {most}").count())
            return f(left, right, cell, on, *rest, **more)

        return run

    monkeypatch.setattr(grid_queries, "box_join", spy(range_join.box_join))
    monkeypatch.setattr(range_join, "_met", spy(range_join._met), raising=False)
    got = registry.QUERIES[name](spark, folder)
    if name == "jn12_vg6_contiguous":
        assert got.count() == boxes(spark, folder).count()
    else:
        assert rows(got.toPandas()) == sql(folder, name)
    assert met == [0] * len(met) and (met or name == "jn9_intersects_mask")


def test_a_neighbour_is_looked_for_and_not_all_of_them(spark, folder):
    plan = registry.QUERIES["jn9_intersects_mask"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan


@pytest.mark.parametrize("name", ["jn7_points_in_polygons", "jn7_contains_join", "jn10_jn16_clipped_pairs", "jn11_vg2_box_iou_pairs", "rs10_polygons_burnt", "rs10_rasterized"])
def test_copies_in_cells_are_not_broadcast(spark, folder, name):
    got = registry.QUERIES[name](spark, folder)
    assert "Broadcast" not in got._jdf.queryExecution().sparkPlan().toString()
    assert rows(got.toPandas()) == sql(folder, name)


@pytest.fixture
def plain_plans(spark):
    """Plans that show what is in generated code before they have run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def held_together(df):
    """The lists that are unfolded in one piece of generated code with a join, or with each other."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    parts = {}
    for line in plan:
        if part := re.search(r"\*\((\d+)\) (SortMergeJoin|Generate explode\(\w*s#)", line):
            parts.setdefault(part[1], []).append(part[2])
    return [p for p in parts.values() if len(p) > 1 and any(k.startswith("Generate") for k in p)]


@pytest.mark.parametrize("name", ["jn10_jn16_clipped_pairs", "jn11_vg2_box_iou_pairs", "jn7_contains_join"])
def test_copies_of_all_partners_are_not_held_together(spark, folder, plain_plans, name):
    assert held_together(registry.QUERIES[name](spark, folder)) == []


def test_lists_are_unfolded_in_full(spark):
    rows_ = spark.createDataFrame([([1, 2, 3], [7, 8], "a"), ([4], [9], "b"), ([], [1], "c"), ([5], [], "d")], "ids array<long>, r_ids array<long>, v string")
    got = sorted((r.id, r.r_id, r.v) for r in copies.unfolded(rows_, "id", "r_id").collect())
    assert got == [(1, 7, "a"), (1, 8, "a"), (2, 7, "a"), (2, 8, "a"), (3, 7, "a"), (3, 8, "a"), (4, 9, "b")]


def test_copies_of_a_polygon_are_not_held_together(spark, folder, plain_plans):
    assert held_together(registry.QUERIES["jn7_points_in_polygons"](spark, folder)) == []


def test_pairs_of_points_and_polygons_are_dealt_by_number(spark, folder):
    got = registry.QUERIES["jn7_points_in_polygons"](spark, folder)
    assert got._jdf.queryExecution().toRdd().getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_rings_are_not_sorted(spark, folder):
    plan = registry.QUERIES["jn7_points_in_polygons"](spark, folder)._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 4 and not any("geometry" in line for line in windows)


def test_shapes_of_the_same_corners_are_told_apart(spark):
    a, b, shifted = [(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)], [(2, 2), (6, 2), (6, 6), (2, 6), (2, 2)], [(4, 4), (12, 4), (12, 12), (4, 12), (4, 4)]
    shapes = [[a, b], [a + b], [b, a], [a], None, [], [shifted]]
    features = [(10 * k + i, None if s is None else [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in s]) for k, s in enumerate(shapes) for i in range(3)]
    points = [(1000 + k, x / 2 + 0.25, y / 2 + 0.25) for k, (x, y) in enumerate([(x, y) for x in range(24) for y in range(24)] * 2)]
    found = polygons.points_in(spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(features, f"key int, geometry {RINGS}").repartition(3), "key", 1.0, 2)
    want = sorted((p, 10 * k + i) for p, x, y in points for k, s in enumerate(shapes) if s and inside(s, x, y) for i in range(3))
    assert sorted((r.id, r.key) for r in found.collect()) == want
