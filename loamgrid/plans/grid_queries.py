"""Queries of boxes, grids, splits and regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes as B
from ..operators import arcs, boundaries, changes, grid, mosaics, overlay, regions, tiles, zonal
from ..sources import files, tile_store, vectors
from ..sources.fixtures import BX_SQL, GRID_SQL, PX_SQL, boxes, pixels, tile_grid
from ..sources.shared import cut, new_folder
from .range_join import box_join, copies_join, halo, prefixed, with_neighbour, without_pair
from .registry import query

X = f"WITH {BX_SQL} "
INTER = "greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0)"
AREA = "({0}.x1 - {0}.x0) * ({0}.y1 - {0}.y0)"
TOUCH = "a.x0 <= b.x1 AND a.x1 >= b.x0 AND a.y0 <= b.y1 AND a.y1 >= b.y0"
CELL = 64
#: Cells for pairs of different boxes: half a box, so that crowded places are dealt to many tasks.
PAIR_CELL = 16

# boxes


@query("sc8_bbox_filter", X + "SELECT id, x0, y0, x1, y1 FROM bx WHERE x0 <= 150 AND x1 >= 100 AND y0 <= 250 AND y1 >= 200")
def bbox_filter(spark, d):
    return boxes(spark, d).where(B.intersects(B.box(), tuple(map(F.lit, (100, 200, 150, 250))))).select("id", "x0", "y0", "x1", "y1")


@query("sc8_morton_store", X + "SELECT id, grp, x0, y0, x1, y1 FROM bx WHERE x0 <= 150 AND x1 >= 100 AND y0 <= 250 AND y1 >= 200")
def morton_store(spark, d):
    """The same box from a store along a Morton curve, of which only some files are opened."""
    path = new_folder(spark, "store")
    tile_store.write_store(boxes(spark, d), path, 16, 32)
    return tile_store.read_store(spark, path, (100, 200, 150, 250))


@query("vg3_vg4_vg5_buffers", X + "SELECT id, x0 - 5 AS gx0, y0 - 5 AS gy0, x1 + 5 AS gx1, y1 + 5 AS gy1, x0 + 2 AS sx0, y0 + 2 AS sy0, x1 - 2 AS sx1, y1 - 2 AS sy1, (x1 - x0) * (y1 - y0) AS area FROM bx")
def buffers(spark, d):
    g, s = B.grown(B.box(), F.lit(5)), B.grown(B.box(), F.lit(-2))
    return boxes(spark, d).select("id", *(e.alias(f"{p}{n}") for p, b in (("g", g), ("s", s)) for e, n in zip(b, B.BOX, strict=True)), B.area(B.box()).alias("area"))


@query("vg1_angles", X + "SELECT id, round(degrees(acos(greatest(least((CAST((x1 - x0) AS DOUBLE) * (y0 + 1) + (y1 - y0) * (x0 + 1)) / sqrt((CAST((x1 - x0) AS DOUBLE) * (x1 - x0) + (y1 - y0) * (y1 - y0)) * (CAST((y0 + 1) AS DOUBLE) * (y0 + 1) + (x0 + 1) * (x0 + 1))), 1), -1))), 5) AS angle, (x1 - x0) * (x0 + 1) - (y1 - y0) * (y0 + 1) > 0 AS convex FROM bx")
def angles(spark, d):
    ax, ay, bx, by = (e.cast("double") for e in (F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.col("y0") + 1, F.col("x0") + 1))
    return boxes(spark, d).select("id", F.round(B.angle(ax, ay, bx, by), 5).alias("angle"), (B.cross(ax, ay, bx, by) > 0).alias("convex"))


@query("jn11_vg2_box_iou_pairs", X + f"SELECT a.id, b.id AS r_id, round(CAST({INTER} AS DOUBLE) / ({AREA.format('a')} + {AREA.format('b')} - {INTER}), 6) AS iou FROM bx a JOIN bx b ON a.grp = b.grp AND a.id > b.id AND {TOUCH} WHERE 2 * {INTER} > {AREA.format('a')} + {AREA.format('b')} - {INTER}")
def box_iou_pairs(spark, d):
    b = boxes(spark, d)
    l, r = B.box(), B.box("r_")
    large = 2 * B.overlap(l, r) > B.area(l) + B.area(r) - B.overlap(l, r)
    return copies_join(b, prefixed(b), PAIR_CELL, on=["grp"], where=large, residual=F.col("id") > F.col("r_id"), keep={"iou": F.round(B.iou(l, r), 6)})


@query("jn7_contains_join", X + ", p AS (SELECT id, x0 + 3 AS x0, y0 + 3 AS y0, x1 - 3 AS x1, y1 - 3 AS y1 FROM bx WHERE x1 - x0 > 6 AND y1 - y0 > 6), g AS (SELECT * FROM bx) SELECT a.id, coalesce(b.id, -1) AS inner_id FROM g a LEFT JOIN p b ON a.x0 <= b.x0 AND a.y0 <= b.y0 AND a.x1 >= b.x1 AND a.y1 >= b.y1 AND a.id <> b.id")
def contains_join(spark, d):
    b = boxes(spark, d)
    s = B.grown(B.box(), F.lit(-3))
    p = b.where("x1 - x0 > 6 AND y1 - y0 > 6").select("id", *(e.alias(n) for e, n in zip(s, B.BOX, strict=True)))
    holds = B.contains(B.box(), B.box("r_"))
    pairs = copies_join(b, prefixed(p), PAIR_CELL, where=holds, residual=F.col("id") != F.col("r_id"))
    none = without_pair(b.select("id", *B.BOX), prefixed(p), PAIR_CELL, holds)
    return pairs.select("id", F.col("r_id").alias("inner_id")).unionByName(none.select("id", F.lit(-1).cast("long").alias("inner_id")))


@query("jn8_within_join", X + ", z AS (SELECT CAST(range AS INT) AS zone, CAST(range % 5 * 100 AS INT) AS x0, CAST(range // 5 * 100 AS INT) AS y0, CAST(range % 5 * 100 + 100 AS INT) AS x1, CAST(range // 5 * 100 + 100 AS INT) AS y1 FROM range(25)) SELECT a.id, coalesce(zone, -1) AS zone FROM bx a LEFT JOIN z b ON b.x0 <= a.x0 AND b.y0 <= a.y0 AND b.x1 >= a.x1 AND b.y1 >= a.y1")
def within_join(spark, d):
    k = F.col("id")
    z = spark.range(25).select(k.cast("int").alias("r_zone"), (k % 5 * 100).cast("int").alias("r_x0"), (F.floor(k / 5) * 100).cast("int").alias("r_y0"), (k % 5 * 100 + 100).cast("int").alias("r_x1"), (F.floor(k / 5) * 100 + 100).cast("int").alias("r_y1"))
    return box_join(boxes(spark, d), z, 100, how="left", residual=B.contains(B.box("r_"), B.box())).select("id", F.coalesce("r_zone", F.lit(-1)).alias("zone"))


@query("jn9_intersects_mask", X + f"SELECT a.id FROM bx a WHERE EXISTS (SELECT 1 FROM bx b WHERE b.id <> a.id AND {TOUCH})")
def intersects_mask(spark, d):
    return with_neighbour(boxes(spark, d).select("id", *B.BOX), CELL).select("id")


@query("jn10_jn16_clipped_pairs", X + f"SELECT a.id, b.id AS r_id, greatest(a.x0, b.x0) AS x0, greatest(a.y0, b.y0) AS y0, least(a.x1, b.x1) AS x1, least(a.y1, b.y1) AS y1 FROM bx a JOIN bx b ON {TOUCH} WHERE a.id <> b.id AND {INTER} > 0")
def clipped_pairs(spark, d):
    b = boxes(spark, d)
    both = dict(zip(B.BOX, B.intersection(B.box(), B.box("r_")), strict=True))
    return copies_join(b, prefixed(b), PAIR_CELL, where=B.overlap(B.box(), B.box("r_")) > 0, residual=F.col("id") != F.col("r_id"), keep=both)


#: Whole-numbered boxes as unit squares, with how many boxes lie on each.
UNITS = X.rstrip() + ", u AS (SELECT id, grp, CAST(i AS INT) AS ux, CAST(j AS INT) AS uy FROM bx, range(x0, x1) a(i), range(y0, y1) b(j)), n AS (SELECT ux, uy, count(*) AS n, count(*) FILTER (WHERE grp < 4) AS l, count(*) FILTER (WHERE grp >= 4) AS r FROM u GROUP BY ux, uy)"


@query("fl13_st5_coverage", UNITS + " SELECT id, round(1 - CAST(count(*) FILTER (WHERE n.n > 1) AS DOUBLE) / count(*), 9) AS share FROM u JOIN n USING (ux, uy) GROUP BY id HAVING 1 - CAST(count(*) FILTER (WHERE n.n > 1) AS DOUBLE) / count(*) > 0.05")
def coverage(spark, d):
    """Boxes of which more than a twentieth is left after the difference with all other boxes."""
    return overlay.left_over(boxes(spark, d), least_share=0.05, cell=CELL).select("id", F.round("share", 9).alias("share"))


@query("fl13_covered_by_layer", UNITS + " SELECT id, CAST(count(*) AS DOUBLE) AS area, CAST(count(*) FILTER (WHERE n.r > 0) AS DOUBLE) AS covered FROM u JOIN n USING (ux, uy) WHERE grp < 4 GROUP BY id")
def covered_by_layer(spark, d):
    """What the boxes of one half of the groups cover of each box of the other half."""
    b = boxes(spark, d)
    return overlay.coverage(b.where("grp < 4"), b.where("grp >= 4"), CELL)


@query("st5_overlay_areas", UNITS + " SELECT CAST(count(*) FILTER (WHERE l > 0) AS DOUBLE) AS left_area, CAST(count(*) FILTER (WHERE r > 0) AS DOUBLE) AS right_area, CAST(count(*) AS DOUBLE) AS union_area, CAST(count(*) FILTER (WHERE l > 0 AND r > 0) AS DOUBLE) AS both_area, CAST(count(*) FILTER (WHERE l > 0 AND r = 0) AS DOUBLE) AS left_only, CAST(count(*) FILTER (WHERE l = 0 AND r > 0) AS DOUBLE) AS right_only FROM n")
def overlay_areas(spark, d):
    """Areas of union, intersection and both differences of the two halves of the groups."""
    b = boxes(spark, d)
    return overlay.overlay_areas(b.where("grp < 4"), b.where("grp >= 4"), CELL)


#: No SQL: the closure of all boxes is quadratic.
@query("jn12_vg6_contiguous")
def contiguous(spark, d):
    from ..operators.graphs import components

    n = boxes(spark, d).selectExpr("id", "x0 div 2 AS x0", "y0 div 2 AS y0", "x0 div 2 + 2 AS x1", "y0 div 2 + 2 AS y1")
    # boxes of one place are contiguous with the same others: a place is a node, by its smallest id
    places = cut(n.groupBy(*B.BOX).agg(F.min("id").alias("node"), F.count("*").alias("n")))
    e = box_join(places, prefixed(places), 16).select(F.col("node").alias("u"), F.col("r_node").alias("v"))
    c = cut(places.join(components(places.select("node"), e), "node"))
    sizes = c.groupBy("root").agg(F.sum("n").alias("members"))
    return n.join(c.select(*B.BOX, "root").hint("merge"), list(B.BOX)).join(sizes, "root").select("id", "root", "members")


@query("ag16_dissolved_lists", X + "SELECT grp, count(*) AS n, list_aggregate(list_sort(list(id)), 'string_agg', ',') AS ids, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM bx GROUP BY grp")
def dissolved(spark, d):
    return boxes(spark, d).groupBy("grp").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("id")).cast("array<string>"), ",").alias("ids"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


@query("rs10_rasterized", X + f", s AS (SELECT * FROM bx), g AS (SELECT CAST(range // w AS INT) AS r, CAST(range % w AS INT) AS c FROM (SELECT max(x1) AS w, max(y1) AS h FROM bx) e, range(e.w * e.h)), h AS (SELECT r, c, max_by(grp + 1, id) AS v FROM g JOIN s ON c + 0.5 > x0 AND c + 0.5 < x1 AND r + 0.5 > y0 AND r + 0.5 < y1 GROUP BY r, c) SELECT r, c, coalesce(v, 0) AS v FROM g LEFT JOIN h USING (r, c)")
def rasterized(spark, d):
    b = boxes(spark, d)
    w, h = b.agg(F.coalesce(F.max("x1"), F.lit(0)), F.coalesce(F.max("y1"), F.lit(0))).first()
    g = spark.range(w * h).select(F.floor(F.col("id") / w).cast("int").alias("r"), (F.col("id") % w).cast("int").alias("c"))
    return tiles.rasterize(b.withColumn("v", F.col("grp") + 1), "v", "id", g)


@query("rs25_snapped", "SELECT p_partkey AS id, round(round(p_retailprice / 7, 1) - p_retailprice / 7, 6) AS shift, round(p_retailprice / 7, 1) AS x FROM part")
def snapped(spark, d):
    x = F.col("p_retailprice") / 7
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.round(F.round(x, 1) - x, 6).alias("shift"), F.round(x, 1).alias("x"))


# vector tables and labels in files


@query("sc7_sk2_vector_round_trip", X + "SELECT id, grp, x0, y0, x1, y1, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area, 'wkb' AS form FROM bx WHERE x0 <= 300 AND x1 >= 50 AND y0 <= 300 AND y1 >= 50 UNION ALL SELECT id, grp, x0, y0, x1, y1, CAST((x1 - x0) * (y1 - y0) AS DOUBLE), 'geojson' FROM bx WHERE x0 <= 300 AND x1 >= 50 AND y0 <= 300 AND y1 >= 50")
def vector_round_trip(spark, d):
    rows = boxes(spark, d).withColumn("geometry", vectors.box_ring(*B.box()))
    read = []
    for form in ("wkb", "geojson"):
        path = new_folder(spark, "vectors")
        vectors.write_vectors(rows, path, form)
        found = vectors.read_vectors(spark, path, form, "id bigint, grp int, x0 int, y0 int, x1 int, y1 int", box=(50.0, 50.0, 300.0, 300.0))
        read.append(found.select(*rows.drop("geometry").columns, vectors.area(F.col("geometry")).alias("area"), F.lit(form).alias("form")))
    return read[0].unionByName(read[1])


CLIP = (100, 100, 180, 180)
CLIPPED = X.rstrip() + ", k AS (SELECT id, grp, greatest(x0, 100) AS x0, greatest(y0, 100) AS y0, least(x1, 180) AS x1, least(y1, 180) AS y1 FROM bx WHERE x0 < 180 AND x1 > 100 AND y0 < 180 AND y1 > 100)"


@query("sc18_clip_dissolve", CLIPPED + f", e AS (SELECT a.id AS u, b.id AS v FROM k a JOIN k b ON a.grp = b.grp AND {TOUCH}), w AS (WITH RECURSIVE reach(u, v) AS (SELECT u, v FROM e UNION SELECT reach.u, e.v FROM reach JOIN e ON reach.v = e.u) SELECT u, min(v) AS part FROM reach GROUP BY u) SELECT grp, part, count(*) AS n, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM w JOIN k ON u = id GROUP BY grp, part")
def clip_dissolve(spark, d):
    """Features clipped to bounds, dissolved by an attribute, and what is contiguous of each value as a part."""
    from ..operators.graphs import components

    b = boxes(spark, d)
    bounds = tuple(map(F.lit, CLIP))
    inner = b.where((F.col("x0") < CLIP[2]) & (F.col("x1") > CLIP[0]) & (F.col("y0") < CLIP[3]) & (F.col("y1") > CLIP[1]))
    clipped = inner.select("id", "grp", *(e.alias(n) for e, n in zip(B.intersection(B.box(), bounds), B.BOX, strict=True)))
    # boxes that are equal once clipped are one part in any case
    k = cut(clipped.groupBy("grp", *B.BOX).agg(F.min("id").alias("id"), F.count("*").alias("n")))
    e = box_join(k, prefixed(k), 16, on=["grp"]).select(F.col("id").alias("u"), F.col("r_id").alias("v"))
    c = components(k.select(F.col("id").alias("node")), e).select(F.col("node").alias("id"), F.col("root").alias("part"))
    return k.join(c, "id").groupBy("grp", "part").agg(F.sum("n").alias("n"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


@query("sk6_matched_pairs", f"WITH {PX_SQL}, t AS (SELECT tile_id, sum(pred) AS image, sum(y1) AS mask FROM px GROUP BY tile_id) SELECT CASE WHEN tile_id % 10 < 7 THEN 'train' WHEN tile_id % 10 < 9 THEN 'val' ELSE 'test' END AS split, tile_id, CAST(image AS BIGINT) AS image, CAST(mask AS BIGINT) AS mask FROM t WHERE tile_id % 4 <> 3")
def matched_pairs(spark, d):
    """Images and masks of one name in a folder for each split; every fourth tile has no mask here. Sums of pixels come back."""
    px = pixels(spark, d)
    path = new_folder(spark, "pairs")
    ids = px.select(F.col("tile_id").alias("id")).distinct()
    splits = ids.select("id", F.when(F.col("id") % 10 < 7, "train").when(F.col("id") % 10 < 9, "val").otherwise("test").alias("split"))
    masks = files.encode_tiles(px, "y1", 32).where("tile_id % 4 <> 3")
    files.write_pairs(files.encode_tiles(px, "pred", 32), masks, splits, path)
    total = lambda c: F.expr(f"aggregate(sequence(1, length({c})), 0L, (s, i) -> s + conv(hex(substring({c}, i, 1)), 16, 10))").alias(c)
    return files.read_pairs(spark, path).select("split", "tile_id", total("image"), total("mask"))


# grids


@query("tg1_quadtree_cells", "WITH RECURSIVE q(cell, depth, path, x0, y0, x1, y1) AS (SELECT r_regionkey, 0, '', r_regionkey * 1000.0::DOUBLE, 0.0::DOUBLE, r_regionkey * 1000.0::DOUBLE + 800, 800.0::DOUBLE FROM region UNION ALL SELECT cell, depth + 1, concat(path, k), CASE WHEN k % 2 = 0 THEN x0 ELSE (x0 + x1) / 2 END, CASE WHEN k < 2 THEN y0 ELSE (y0 + y1) / 2 END, CASE WHEN k % 2 = 0 THEN (x0 + x1) / 2 ELSE x1 END, CASE WHEN k < 2 THEN (y0 + y1) / 2 ELSE y1 END FROM q, range(4) t(k) WHERE depth < 3) SELECT cell, depth, path, x0, y0, x1, y1, CAST(row_number() OVER (PARTITION BY cell ORDER BY rpad(path, 4, '4')) AS INT) AS place FROM q")
def quadtree_cells(spark, d):
    k = F.col("r_regionkey")
    r = spark.read.parquet(f"{d}/region.parquet").select(k.alias("cell"), (k * 1000.0).alias("x0"), F.lit(0.0).alias("y0"), (k * 1000.0 + 800).alias("x1"), F.lit(800.0).alias("y1"))
    return grid.quadtree(r, 3)


@query("tg2_fl11_grid_cells", "WITH a AS (SELECT r_regionkey AS area, r_regionkey * 500.0::DOUBLE AS x0, 10.0::DOUBLE AS y0, r_regionkey * 500.0::DOUBLE + 130 + r_regionkey * 17 AS x1, 10.0::DOUBLE + 90 + r_regionkey * 9 AS y1 FROM region), c AS (SELECT area, CAST(i AS INT) AS row, CAST(j AS INT) AS col, round(x0 + j * 20.3, 1) AS cx0, round(y0 + i * 20.3, 1) AS cy0, round(x0 + (j + 1) * 20.3, 1) AS cx1, round(y0 + (i + 1) * 20.3, 1) AS cy1, x1, y1 FROM a, range(20) t(i), range(20) u(j) WHERE i < ceil((y1 - y0) / 20.3) AND j < ceil((x1 - x0) / 20.3)), k AS (SELECT * FROM c WHERE cx1 <= x1 + 1e-3 AND cy1 <= y1 + 1e-3) SELECT area, row, col, CAST(row_number() OVER (ORDER BY area, row, col) - 1 AS BIGINT) AS unique_id, concat(dense_rank() OVER (ORDER BY area) - 1, '-', row, '-', col) AS str_id, cx0 AS x0, cy0 AS y0, cx1 AS x1, cy1 AS y1 FROM k")
def grid_cells(spark, d):
    k = F.col("r_regionkey")
    a = spark.read.parquet(f"{d}/region.parquet").select(k.alias("area"), (k * 500.0).alias("x0"), F.lit(10.0).alias("y0"), (k * 500.0 + 130 + k * 17).alias("x1"), (F.lit(100.0) + k * 9).alias("y1"))
    return grid.grid_cells(a, 20.3)


TILES = f"WITH {GRID_SQL}, b AS (SELECT tile_id, gcol * 2000 AS x0, -(grow + 1) * 2000 AS y0, (gcol + 1) * 2000 AS x1, -grow * 2000 AS y1 FROM tg)"
OVER = ", c AS (SELECT tile_id, x0 + j * 462 AS minx, y1 - i * 462 AS maxy FROM b, range(5) t(i), range(5) u(j) WHERE i < ceil((y1 - y0 - 50) / 462.0) AND j < ceil((x1 - x0 - 50) / 462.0)), m AS (SELECT *, ((minx % 1848) + 1848) % 1848 AS rx, ((-maxy % 1848) + 1848) % 1848 AS ry FROM c), o AS (SELECT tile_id, CAST(minx AS INT) AS minx, CAST(maxy AS INT) AS maxy, CAST(rx // 462 AS INT) AS col, CAST(ry // 462 AS INT) AS row, CAST(minx - rx AS INT) AS region_x, CAST(maxy + ry AS INT) AS region_y FROM m)"


def big_tiles(spark, d):
    t = tile_grid(spark, d)
    return t.select("tile_id", (F.col("gcol") * 2000).alias("x0"), (-(F.col("grow") + 1) * 2000).alias("y0"), ((F.col("gcol") + 1) * 2000).alias("x1"), (-F.col("grow") * 2000).alias("y1"))


@query("tg3_grid_size", TILES + " SELECT tile_id, CAST(ceil((x1 - x0 - 50) / (512.0 - 50)) AS INT) AS cols, CAST(ceil((y1 - y0 - 50) / (512.0 - 50)) AS INT) AS rows FROM b")
def grid_size(spark, d):
    return big_tiles(spark, d).select("tile_id", grid.grid_size(F.col("x1") - F.col("x0"), F.lit(512), F.lit(50)).alias("cols"), grid.grid_size(F.col("y1") - F.col("y0"), F.lit(512), F.lit(50)).alias("rows"))


@query("tg4_overlap_grid", TILES + OVER + " SELECT *, concat(region_x, '_', region_y, '_', row, '_', col, '.tif') AS file_name FROM o")
def overlap_grid(spark, d):
    return grid.overlapping_grid(big_tiles(spark, d), 512, 50, 1848)


@query("tg5_delimitation", TILES + " SELECT tile_id, x0, y0, x1, y1, x1 - x0 AS width, y1 - y0 AS height, CAST((x1 - x0 + y1 - y0) / 2 AS INT) AS scale FROM b")
def delimitation(spark, d):
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return big_tiles(spark, d).select("tile_id", *B.BOX, w.alias("width"), h.alias("height"), ((w + h) / 2).cast("int").alias("scale"))


@query("tg6_padding", TILES + " SELECT tile_id, 'top' AS side, x0, y1 AS y0, x1 + 50 AS x1, y1 + 50 AS y1 FROM b UNION ALL SELECT tile_id, 'right', x1, y0, x1 + 50, y1 FROM b")
def padding(spark, d):
    p = lambda side, *b: F.struct(F.lit(side).alias("side"), *(e.alias(n) for e, n in zip(b, B.BOX, strict=True)))
    x0, y0, x1, y1 = B.box()
    return big_tiles(spark, d).select("tile_id", F.explode(F.array(p("top", x0, y1, x1 + 50, y1 + 50), p("right", x1, y0, x1 + 50, y1))).alias("p")).select("tile_id", "p.*")


@query("tg7_tg10_clipped_subtiles", TILES + OVER + " SELECT o.tile_id, row, col, greatest(minx, x0) AS x0, greatest(maxy - 512, y0) AS y0, least(minx + 512, x1) AS x1, least(maxy, y1) AS y1 FROM o JOIN b USING (tile_id)")
def clipped_subtiles(spark, d):
    t = big_tiles(spark, d)
    cells = grid.overlapping_grid(t, 512, 50, 1848).join(prefixed(t), F.col("tile_id") == F.col("r_tile_id"))
    own = (F.col("minx"), F.col("maxy") - 512, F.col("minx") + 512, F.col("maxy"))
    return cells.select("tile_id", "row", "col", *(e.alias(n) for e, n in zip(B.intersection(own, B.box("r_")), B.BOX, strict=True)))


@query("tg8_matrix_tiles", X + ", s AS (SELECT * FROM bx) SELECT id, CAST(i AS INT) AS tile_col, CAST(j AS INT) AS tile_row, concat('https://tiles.example/', i, '/', j, '.png') AS url FROM s, range(-5, 60) t(i), range(-5, 60) u(j) WHERE i BETWEEN floor(x0 / 25.6) AND ceil(x1 / 25.6) AND j BETWEEN floor((500 - y1) / 25.6) AND ceil((500 - y0) / 25.6)")
def matrix_tiles(spark, d):
    return grid.matrix_tiles(boxes(spark, d), 0.0, 500.0, 25.6, "https://tiles.example/{TileCol}/{TileRow}.png")


@query("jn17_best_scale", "WITH s AS (SELECT CAST(range AS INT) AS place, 100.0 / 2 ** range AS size FROM range(9)), w AS (SELECT p_partkey AS id, p_size / 10.0 AS wanted FROM part), p AS (SELECT id, CAST(coalesce(min(place) FILTER (WHERE size <= wanted), max(place)) AS INT) AS place FROM w, s GROUP BY id) SELECT id, place, CAST(size AS DOUBLE) AS size FROM p JOIN s USING (place)")
def best_scale(spark, d):
    s = spark.range(9).select(F.col("id").cast("int").alias("place"), (100.0 / F.pow(F.lit(2.0), "id")).alias("size"))
    return grid.best_scale(spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), (F.col("p_size") / 10).alias("wanted")), s)


@query("sc17_web_tiles", "WITH p AS (SELECT c_custkey AS id, c_custkey % 340 - 170 + 0.37 AS lon, c_custkey % 160 - 80 + 0.21 AS lat FROM customer), z AS (SELECT range AS z FROM range(15, 22)) SELECT id, CAST(z AS INT) AS zoom, CAST(floor((lon + 180) / 360 * 2.0 ** z) AS BIGINT) AS x, CAST(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 2.0 ** z) AS BIGINT) AS y FROM p, z")
def web_tiles(spark, d):
    k = F.col("c_custkey")
    p = spark.read.parquet(f"{d}/customer.parquet").select(k.alias("id"), (k % 340 - 170 + 0.37).alias("lon"), (k % 160 - 80 + 0.21).alias("lat"), F.explode(F.sequence(F.lit(15), F.lit(21))).alias("zoom"))
    x, y = grid.web_tile(F.col("lon"), F.col("lat"), F.col("zoom"))
    return p.select("id", "zoom", x.alias("x"), y.alias("y"))


@query("tg8b_same_aspect", X + "SELECT id, x1 - x0 AS width, y1 - y0 AS height FROM bx")
def same_aspect(spark, d):
    b = boxes(spark, d).withColumns({"width": F.col("x1") - F.col("x0"), "height": F.col("y1") - F.col("y0")})
    w, h = F.col("width"), F.col("height")
    return grid.same_aspect(b, w, h, w * 4, h * 4).select("id", "width", "height")


# splits

HASH = "(CAST({k} AS BIGINT) * 48271 + 7) % 2147483647"
SPLIT = ", s AS (SELECT *, n_train + CAST(floor((n - n_train) / 2) AS BIGINT) AS n_val FROM (SELECT *, CAST(floor(n * 0.7) AS BIGINT) AS n_train FROM h)), t AS (SELECT id, grp, CASE WHEN place < n_train THEN 'train' WHEN place < n_val THEN 'val' ELSE 'test' END AS split FROM s)"
BY_GROUP = "WITH h AS (SELECT c_custkey AS id, c_nationkey AS grp, row_number() OVER (PARTITION BY c_nationkey ORDER BY " + HASH.format(k="c_custkey") + ", c_custkey) - 1 AS place, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)" + SPLIT


@query("wn2_hash_split", "WITH h AS (SELECT s_suppkey AS id, 0 AS grp, row_number() OVER (ORDER BY " + HASH.format(k="s_suppkey") + ", s_suppkey) - 1 AS place, count(*) OVER () AS n FROM supplier)" + SPLIT + " SELECT id, split FROM t")
def hash_split(spark, d):
    return grid.split(spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("id")), "id", 7)


def customers(spark, d):
    return grid.split(spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("grp")), "id", 7, ["grp"])


@query("wn3_group_split", BY_GROUP + " SELECT id, grp, split FROM t")
def group_split(spark, d):
    return customers(spark, d).select("id", "grp", "split")


@query("wn4_val_to_test", BY_GROUP + ", v AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY id) AS k, count(*) OVER (PARTITION BY split) AS m FROM t) SELECT id, CASE WHEN split = 'val' AND k <= m // 2 + 1 THEN 'test' ELSE split END AS split FROM v")
def val_to_test(spark, d):
    return grid.val_to_test(customers(spark, d), "id").select("id", "split")


@query("wn5_first_of_each", "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def first_of_each(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))


@query("st1b_tagged_union", BY_GROUP + " SELECT split, 'gt' AS kind, grp, count(*) AS n FROM t GROUP BY split, grp UNION ALL SELECT split, 'all', -1, count(*) FROM t GROUP BY split")
def tagged_union(spark, d):
    c = customers(spark, d)
    return c.groupBy("split", "grp").agg(F.count("*").alias("n")).select("split", F.lit("gt").alias("kind"), "grp", "n").unionByName(c.groupBy("split").agg(F.count("*").alias("n")).select("split", F.lit("all").alias("kind"), F.lit(-1).alias("grp"), "n"))


@query("so1_split_map", BY_GROUP + " SELECT split, list_aggregate(list_sort(list(id)), 'string_agg', ',') AS ids FROM t GROUP BY split")
def split_map(spark, d):
    return customers(spark, d).groupBy("split").agg(F.array_join(F.sort_array(F.collect_list("id")).cast("array<string>"), ",").alias("ids"))


# regions

REGIONS = f"""WITH RECURSIVE {PX_SQL}, v AS (SELECT *, CASE WHEN tile_id % 2 = 0 THEN CAST((y1 - 1) * 17 + y2 AS INT) ELSE y1 END AS code FROM px),
reach(tile_id, r, c, r0, c0, code) AS (SELECT tile_id, r, c, r, c, code FROM v UNION SELECT v.tile_id, v.r, v.c, reach.r0, reach.c0, v.code FROM reach JOIN v ON v.tile_id = reach.tile_id AND v.code = reach.code AND abs(v.r - reach.r) + abs(v.c - reach.c) = 1),
lab AS (SELECT tile_id, r, c, code, min(r0 * 65536 + c0) AS region FROM reach GROUP BY ALL), q AS (SELECT lab.*, v.y1, v.y2, v.px_dm, v.conf1_milli, v.conf2_milli FROM lab JOIN v USING (tile_id, r, c))"""


def labelled(spark, d):
    px = pixels(spark, d).withColumn("code", F.when(F.col("tile_id") % 2 == 0, (F.col("y1") - 1) * 17 + F.col("y2")).otherwise(F.col("y1")).cast("int"))
    return regions.polygonize(px, "code")


@query("rs11_region_labels", REGIONS + " SELECT tile_id, r, c, CAST(region AS BIGINT) AS region FROM q")
def region_labels(spark, d):
    return labelled(spark, d).select("tile_id", "r", "c", "region")


@query("rs21_component_stats", REGIONS + " SELECT tile_id, CAST(region AS BIGINT) AS region, count(*) AS n_px, CAST(count(*) AS DOUBLE) * max(px_dm) * max(px_dm) / 100 AS area_m2, round(CAST(count(*) AS DOUBLE) / ((max(r) - min(r) + 1) * (max(c) - min(c) + 1)), 6) AS fill, (greatest(max(r) - min(r), max(c) - min(c)) + 1) * max(px_dm) / 10.0 AS long_axis FROM q GROUP BY tile_id, region")
def component_stats(spark, d):
    return changes.region_stats(labelled(spark, d), ["tile_id", "region"]).select("tile_id", "region", "n_px", "area_m2", F.round("fill", 6).alias("fill"), "long_axis")


@query("ag15_zonal_conf", REGIONS + " SELECT tile_id, CAST(region AS BIGINT) AS region, round(least(avg(conf1_milli), avg(conf2_milli)), 6) AS conf FROM q GROUP BY tile_id, region")
def zonal_conf(spark, d):
    s = changes.region_stats(labelled(spark, d), ["tile_id", "region"], conf=["conf1_milli", "conf2_milli"])
    return s.select("tile_id", "region", F.round(F.least("mean_conf1_milli", "mean_conf2_milli"), 6).alias("conf"))


@query("rs12_region_sizes_back", REGIONS + " SELECT tile_id, r, c, CAST(count(*) OVER (PARTITION BY tile_id, region) AS BIGINT) AS n_px FROM q")
def region_sizes_back(spark, d):
    px = labelled(spark, d)
    return px.join(px.groupBy("tile_id", "region").agg(F.count("*").alias("n_px")), ["tile_id", "region"]).select("tile_id", "r", "c", "n_px")


EDGES = REGIONS + ", e0 AS (SELECT a.tile_id, a.region AS a, b.region AS b FROM q a JOIN q b ON a.tile_id = b.tile_id AND ((b.r = a.r AND b.c = a.c + 1) OR (b.r = a.r + 1 AND b.c = a.c)) WHERE a.region <> b.region), e AS (SELECT tile_id, region, neighbour, count(*) AS shared_px FROM (SELECT tile_id, a AS region, b AS neighbour FROM e0 UNION ALL SELECT tile_id, b, a FROM e0) GROUP BY ALL)"


@query("jn6_touching_regions", EDGES + " SELECT tile_id, CAST(region AS BIGINT) AS region, CAST(neighbour AS BIGINT) AS neighbour, shared_px FROM e")
def touching_regions(spark, d):
    return regions.shared_edges(labelled(spark, d)).select("tile_id", "region", "neighbour", "shared_px")


#: Sides of pixels, the arms that they make (by neighbour in nb), and the corners where arms meet; left turns come first.
ARMS_OF = """SELECT *, CASE WHEN side IN ('L', 'B') THEN a ELSE b END AS s0, CASE WHEN side IN ('L', 'B') THEN b ELSE a END AS e0 FROM (
    SELECT {on}, min(p) AS a, max(p) + 1 AS b, count(*) AS len FROM (SELECT *, p - row_number() OVER (PARTITION BY {on} ORDER BY p) AS island FROM side {where}) GROUP BY {on}, island)"""
VERTICES = "CASE WHEN side IN ('L', 'R') THEN {0}0 ELSE line END AS {0}y, CASE WHEN side IN ('L', 'R') THEN line ELSE {0}0 END AS {0}x"
BOUNDARIES = REGIONS.replace("CASE WHEN tile_id % 2 = 0 THEN CAST((y1 - 1) * 17 + y2 AS INT) ELSE y1 END AS code", "pred AS code") + f""", near AS (SELECT q.tile_id, q.r, q.c, q.region, l.region AS l, b.region AS b, rr.region AS rr, t.region AS t FROM q LEFT JOIN q l ON l.tile_id = q.tile_id AND l.r = q.r AND l.c = q.c - 1 LEFT JOIN q b ON b.tile_id = q.tile_id AND b.r = q.r + 1 AND b.c = q.c
    LEFT JOIN q rr ON rr.tile_id = q.tile_id AND rr.r = q.r AND rr.c = q.c + 1 LEFT JOIN q t ON t.tile_id = q.tile_id AND t.r = q.r - 1 AND t.c = q.c),
side AS (SELECT * FROM (SELECT tile_id, region, 'L' AS side, c AS line, r AS p, l AS nb FROM near UNION ALL SELECT tile_id, region, 'B', r + 1, c, b FROM near UNION ALL SELECT tile_id, region, 'R', c + 1, r, rr FROM near UNION ALL SELECT tile_id, region, 'T', r, c, t FROM near) WHERE nb IS DISTINCT FROM region),
arm AS (SELECT *, {VERTICES.format("s")}, {VERTICES.format("e")} FROM ({ARMS_OF.format(on="tile_id, region, side, line", where="")})),
shared_arm AS (SELECT *, {VERTICES.format("s")}, {VERTICES.format("e")} FROM ({ARMS_OF.format(on="tile_id, region, nb, side, line", where="WHERE nb IS NOT NULL")})),
size AS (SELECT tile_id, region, count(*) AS n, CAST(count(*) AS DOUBLE) / ((max(r) - min(r) + 1) * (max(c) - min(c) + 1)) AS fill, max(px_dm) AS e FROM q GROUP BY tile_id, region)"""
TURNS = """, turn AS (SELECT * FROM (SELECT x.tile_id, x.region, x.side, x.sy, x.sx, y.side AS side2, y.sy AS sy2, y.sx AS sx2, x.len * y.len AS product, y.side = translate(x.side, 'LBRT', 'BRTL') AS convex,
    row_number() OVER (PARTITION BY x.tile_id, x.region, x.side, x.ey, x.ex ORDER BY y.side = translate(x.side, 'LBRT', 'BRTL') DESC) AS k FROM arm x JOIN arm y ON y.tile_id = x.tile_id AND y.region = x.region AND y.sy = x.ey AND y.sx = x.ex AND y.side IN (translate(x.side, 'LBRT', 'BRTL'), translate(x.side, 'LBRT', 'TLBR'))) WHERE k = 1),
first AS (SELECT tile_id, region, arg_min(side, (sy, sx, side)) AS side, min(sy) AS sy, arg_min(sx, (sy, sx, side)) AS sx FROM arm GROUP BY tile_id, region),
ring AS (SELECT tile_id, region, side, sy, sx FROM first UNION SELECT t.tile_id, t.region, t.side2, t.sy2, t.sx2 FROM ring g JOIN turn t USING (tile_id, region, side, sy, sx))"""


def predicted(spark, d):
    return regions.polygonize(pixels(spark, d).select("tile_id", "r", "c", "px_dm", "pred"), "pred")


@query("wn1_so4_best_neighbour", BOUNDARIES + """, angle AS (SELECT x.tile_id, x.region, x.nb, count(*) AS angles FROM shared_arm x JOIN shared_arm y ON y.tile_id = x.tile_id AND y.region = x.region AND y.nb = x.nb AND y.side = translate(x.side, 'LBRT', 'BRTL') AND y.sy = x.ey AND y.sx = x.ex
    JOIN size z ON z.tile_id = x.tile_id AND z.region = x.region WHERE x.len * y.len * z.e * z.e / 100.0 > 50 GROUP BY ALL), shared AS (SELECT tile_id, region, nb, count(*) AS shared_px FROM side WHERE nb IS NOT NULL GROUP BY ALL)
SELECT tile_id, CAST(region AS BIGINT) AS region, CAST(nb AS BIGINT) AS neighbour, angles, shared_px FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, region ORDER BY angles DESC, shared_px DESC, nb) AS k FROM angle JOIN shared USING (tile_id, region, nb)) WHERE k = 1""")
def best_neighbour(spark, d):
    """By right angles on the shared boundary, then its length, then the label."""
    return boundaries.best_neighbours(predicted(spark, d), ["tile_id"])


FL8 = TURNS + """, convex AS (SELECT tile_id, region, count(*) AS convex FROM ring JOIN turn USING (tile_id, region, side, sy, sx) JOIN size USING (tile_id, region) WHERE convex AND product * e * e / 100.0 > 50 GROUP BY tile_id, region), around AS (SELECT tile_id, region, count(*) AS n FROM side GROUP BY tile_id, region)
SELECT tile_id, CAST(region AS BIGINT) AS region, convex, around.n * e / 10.0 AS perimeter_m, round(fill, 9) AS fill FROM convex JOIN around USING (tile_id, region) JOIN size USING (tile_id, region) WHERE convex < 5 AND fill > 0.4 AND around.n * e / 10.0 < 400"""


@query("fl8_candidates", BOUNDARIES + FL8)
def candidates(spark, d):
    """Regions with one to four large convex right angles, by their outer ring's corners and their whole boundary."""
    return boundaries.candidates(predicted(spark, d), ["tile_id"]).withColumn("fill", F.round("fill", 9))


@query("wn10_corners", BOUNDARIES + TURNS + " SELECT tile_id, CAST(region AS BIGINT) AS region, count(*) AS corners, count(*) FILTER (WHERE convex) AS convex, CAST(max(product) AS BIGINT) AS largest FROM ring JOIN turn USING (tile_id, region, side, sy, sx) GROUP BY tile_id, region")
def ring_corners(spark, d):
    """Corners of each region's outer ring, the convex ones, and the largest product of two arms that meet."""
    found = boundaries.outer_corners(boundaries.arms(boundaries.sides(predicted(spark, d), ["tile_id"]), ["tile_id"]), ["tile_id"])
    return found.groupBy("tile_id", "region").agg(F.count("*").alias("corners"), F.count_if("convex").alias("convex"), F.max(F.col("before") * F.col("after")).cast("long").alias("largest"))


def tagged(spark, d):
    px = pixels(spark, d).withColumn("code", ((F.col("y1") - 1) * 17 + F.col("y2")).cast("int"))
    px = cut(regions.polygonize(px, "code"))
    keys = ["tile_id", "region"]
    s = changes.region_stats(px, [*keys, "y1", "y2"], conf=["conf1_milli", "conf2_milli"])
    r = regions.rectangles(px, keys).select(*keys, F.col("short_axis").alias("short"), "axis_ratio", "rectangularity")
    conf = F.least("mean_conf1_milli", "mean_conf2_milli") / 1000
    return s.join(r, keys).withColumn("tag", changes.tag(F.col("y1"), F.col("y2"), F.col("area_m2"), conf, F.col("axis_ratio"), F.col("rectangularity"), F.col("short"), F.col("fill")))


SOIL, NON = "(8, 9, 10, 11, 12)", "(1, 2, 3, 4, 5, 6, 13, 14, 15, 16, 17)"


def _ladder(built: str, edge: str, water: str, base: int) -> str:
    tilt = "(ratio < 0.3 OR rect < 0.4)"
    return f"CASE WHEN conf < 0.075 THEN {base + 1} WHEN {built} THEN CASE WHEN {tilt} THEN {base + 3} WHEN rect > 0.8 AND area > 5 THEN {base + 2} ELSE {base + 4} END WHEN ratio < 0.1 AND short < 2 THEN 40 WHEN {edge} AND {tilt} AND short < 4 THEN {base + 5} WHEN {water} AND box > 0.8 AND area > 2500 THEN {base + 6} ELSE {base} END"


# The smallest rotated rectangle shares a side of the hull, so it lies along one of the lines through two corners of the rows' ends.
TAGS = REGIONS.replace("CASE WHEN tile_id % 2 = 0 THEN CAST((y1 - 1) * 17 + y2 AS INT) ELSE y1 END AS code", "CAST((y1 - 1) * 17 + y2 AS INT) AS code") + f""", s AS (SELECT tile_id, CAST(region AS BIGINT) AS region, y1, y2, count(*) AS n, max(px_dm) AS e, CAST(count(*) AS DOUBLE) * max(px_dm) * max(px_dm) / 100 AS area, CAST(count(*) AS DOUBLE) / ((max(r) - min(r) + 1) * (max(c) - min(c) + 1)) AS box,
 least(avg(conf1_milli), avg(conf2_milli)) / 1000 AS conf FROM q GROUP BY ALL),
ends AS (SELECT tile_id, CAST(region AS BIGINT) AS region, CAST(r AS BIGINT) AS r, CAST(min(c) AS BIGINT) AS a, CAST(max(c) AS BIGINT) + 1 AS b FROM q GROUP BY ALL), pt AS (SELECT tile_id, region, a AS x, r AS y FROM ends UNION SELECT tile_id, region, a, r + 1 FROM ends UNION SELECT tile_id, region, b, r FROM ends UNION SELECT tile_id, region, b, r + 1 FROM ends),
way AS (SELECT DISTINCT tile_id, region, (b.x - a.x) // gcd(b.x - a.x, b.y - a.y) AS dx, (b.y - a.y) // gcd(b.x - a.x, b.y - a.y) AS dy FROM pt a JOIN pt b USING (tile_id, region) WHERE b.y > a.y OR (b.y = a.y AND b.x > a.x)),
rect AS (SELECT tile_id, region, CAST(dx * dx + dy * dy AS DOUBLE) AS u, max(x * dx + y * dy) - min(x * dx + y * dy) AS a, max(x * dy - y * dx) - min(x * dy - y * dx) AS b FROM way JOIN pt USING (tile_id, region) GROUP BY tile_id, region, dx, dy),
best AS (SELECT tile_id, region, min(round(a * b / u, 9)) AS least FROM rect GROUP BY ALL),
axes AS (SELECT tile_id, region, max(least) AS whole, min(least(a, b) / sqrt(u)) AS short FROM rect JOIN best USING (tile_id, region) WHERE round(a * b / u, 9) = least GROUP BY ALL),
w AS (SELECT s.tile_id, s.region, y1, y2, area, conf, box, round(short * short / whole, 9) AS ratio, round(n / whole, 9) AS rect, round(short * e / 10.0, 9) AS short FROM s JOIN axes USING (tile_id, region)),
t AS (SELECT tile_id, region, CAST(CASE WHEN y1 = y2 THEN 0 WHEN area < 1 THEN 60 WHEN (y1 = 7) <> (y2 = 7) THEN 50 WHEN y1 IN {SOIL} AND y2 IN {NON} THEN {_ladder('y2 IN (1, 17)', 'y1 = 8', 'y1 = 8 AND y2 = 5', 20)} WHEN y1 IN {NON} AND y2 IN {SOIL} THEN {_ladder('y1 IN (1, 17)', 'y2 = 8', 'y1 = 5 AND y2 = 8', 30)} ELSE 10 END AS INT) AS tag FROM w)"""


@query("rs22_monitor_tags", TAGS + " SELECT tile_id, region, tag FROM t")
def monitor_tags(spark, d):
    return tagged(spark, d).select("tile_id", "region", "tag")


@query("ag12_change_histogram", TAGS + " SELECT tag, count(*) AS n, CAST((SELECT count(*) FROM t WHERE tag BETWEEN 20 AND 26) AS BIGINT) AS soil_to_nonsoil, CAST((SELECT count(*) FROM t WHERE tag BETWEEN 30 AND 36) AS BIGINT) AS nonsoil_to_soil FROM t GROUP BY tag")
def change_histogram(spark, d):
    return changes.change_histogram(tagged(spark, d))


# regions of the whole mosaic: tiles beside each other, labels across their borders

MOSAIC = f"""WITH RECURSIVE {GRID_SQL}, v AS (SELECT px.tile_id, r, c, grow * 32 + r AS gr, gcol * 32 + c AS gc, y1 AS code, px_dm, conf1_milli, conf2_milli FROM px JOIN tg USING (tile_id)),
reach(gr, gc, r0, c0, code) AS (SELECT gr, gc, gr, gc, code FROM v UNION SELECT v.gr, v.gc, reach.r0, reach.c0, v.code FROM reach JOIN v ON v.code = reach.code AND abs(v.gr - reach.gr) + abs(v.gc - reach.gc) = 1),
lab AS (SELECT gr, gc, min(r0 * 2147483648 + c0) AS region FROM reach GROUP BY ALL), q AS (SELECT lab.region, v.* FROM lab JOIN v USING (gr, gc))"""


def mosaic_labelled(spark, d):
    return mosaics.mosaic_regions(pixels(spark, d).withColumn("code", F.col("y1")), "code", tile_grid(spark, d), 32)


@query("rs11_mosaic_labels", MOSAIC + " SELECT tile_id, r, c, CAST(region AS BIGINT) AS region FROM q")
def mosaic_labels(spark, d):
    return mosaic_labelled(spark, d).select("tile_id", "r", "c", "region")


@query("rs21_mosaic_stats", MOSAIC + " SELECT CAST(region AS BIGINT) AS region, count(*) AS n_px, CAST(min(gr) AS BIGINT) AS rmin, CAST(max(gr) AS BIGINT) AS rmax, CAST(min(gc) AS BIGINT) AS cmin, CAST(max(gc) AS BIGINT) AS cmax, CAST(sum(px_dm * px_dm) AS DOUBLE) / 100 AS area_m2 FROM q GROUP BY region")
def mosaic_stats(spark, d):
    return mosaics.mosaic_stats(mosaic_labelled(spark, d))


@query("ag15_box_zones", MOSAIC.split(",\nreach(")[0] + f", {BX_SQL} SELECT id, count(*) AS n, round(avg(conf1_milli), 6) AS conf1_milli, round(avg(conf2_milli), 6) AS conf2_milli FROM v JOIN bx ON gc >= x0 AND gc < x1 AND gr >= y0 AND gr < y1 GROUP BY id")
def box_zones(spark, d):
    """Mean confidences over box zones of the mosaic, by look-ups in summed-area tables."""
    values = ["conf1_milli", "conf2_milli"]
    at = mosaics.placed(pixels(spark, d), tile_grid(spark, d), 32).select(F.col("gr").alias("r"), F.col("gc").alias("c"), *values)
    found = zonal.box_means(boxes(spark, d), zonal.summed_areas(at, values, 32), values, 32)
    return found.select("id", "n", *(F.round(v, 6).alias(v) for v in values))


@query("rs12_mosaic_sizes_back", MOSAIC + " SELECT tile_id, r, c, count(*) OVER (PARTITION BY region) AS n_px FROM q")
def mosaic_sizes_back(spark, d):
    return mosaics.sizes_back(mosaic_labelled(spark, d)).select("tile_id", "r", "c", "n_px")


@query("ag15_mosaic_conf", MOSAIC + " SELECT CAST(region AS BIGINT) AS region, round(least(avg(conf1_milli), avg(conf2_milli)), 6) AS conf FROM q GROUP BY region")
def mosaic_conf(spark, d):
    s = mosaics.mosaic_stats(mosaic_labelled(spark, d), conf=["conf1_milli", "conf2_milli"])
    return s.select("region", F.round(F.least("mean_conf1_milli", "mean_conf2_milli"), 6).alias("conf"))


EMPTY = f"""WITH RECURSIVE {PX_SQL}, v AS (SELECT tile_id, r, c, px_dm FROM px WHERE pred = 0),
reach(tile_id, r, c, r0, c0) AS (SELECT tile_id, r, c, r, c FROM v UNION SELECT v.tile_id, v.r, v.c, reach.r0, reach.c0 FROM reach JOIN v ON v.tile_id = reach.tile_id AND abs(v.r - reach.r) + abs(v.c - reach.c) = 1),
lab AS (SELECT tile_id, r, c, min(r0 * 65536 + c0) AS region FROM reach GROUP BY ALL)
SELECT tile_id, CAST(region AS BIGINT) AS region, count(*) AS n_px, CAST(count(*) AS DOUBLE) * max(px_dm) * max(px_dm) / 100 AS area_m2 FROM lab JOIN v USING (tile_id, r, c) GROUP BY tile_id, region HAVING CAST(count(*) AS DOUBLE) * max(px_dm) * max(px_dm) / 100 > 10"""


@query("rs13_nodata_regions", EMPTY)
def nodata_regions(spark, d):
    px = regions.polygonize(pixels(spark, d).withColumn("empty", (F.col("pred") == 0).cast("int")), "empty").where("empty = 1")
    return changes.region_stats(px, ["tile_id", "region"]).where("area_m2 > 10").select("tile_id", "region", "n_px", "area_m2")


@query("rs17_rs19_corrected")
def corrected(spark, d):
    return regions.correct_artefacts(pixels(spark, d), "pred", "px_dm").select("tile_id", "r", "c", "pred", "corrected")


@query("rs20_halo_post_processing")
def post_processed(spark, d):
    served = halo(tile_grid(spark, d)).select("tile_id", "dr", "dc", "neighbour_id")
    return regions.post_process_tiles(files.encode_tiles(pixels(spark, d), "pred", 32, empty=255), served, "combined", edge_m=5.0)


@query("rs21_rotated_rectangles")
def rotated(spark, d):
    return regions.rectangles(labelled(spark, d), ["tile_id", "region"])


SMALL = EDGES.replace("CASE WHEN tile_id % 2 = 0 THEN CAST((y1 - 1) * 17 + y2 AS INT) ELSE y1 END AS code", "pred AS code") + """, n AS (SELECT tile_id, region, code, CAST(count(*) AS DOUBLE) * max(px_dm) * max(px_dm) / 100 AS n FROM q GROUP BY ALL),
w AS (SELECT e.tile_id, e.region, arg_max(e.neighbour, e.shared_px * 10000000000 - e.neighbour) AS winner FROM e JOIN n USING (tile_id, region) WHERE n.n < 3 GROUP BY e.tile_id, e.region)
SELECT q.tile_id, q.r, q.c, q.code AS pred, coalesce(o.code, q.code) AS merged FROM q LEFT JOIN w ON w.tile_id = q.tile_id AND w.region = q.region LEFT JOIN n o ON o.tile_id = w.tile_id AND o.region = w.winner"""


@query("rs23_merged_small_regions", SMALL)
def merged_small(spark, d):
    """Regions below 3 m2 take the class of the neighbour with the longest shared boundary."""
    return regions.merge_small(pixels(spark, d).select("tile_id", "r", "c", "px_dm", "pred"), "pred", 3, edge_dm="px_dm").drop("px_dm")


@query("rs23_simplified_outlines")
def simplified(spark, d):
    """Small regions merged, then the outlines of all regions with fewer corners."""
    px = regions.merge_small(pixels(spark, d).select("tile_id", "r", "c", "px_dm", "pred"), "pred", 3)
    return regions.outlines(regions.polygonize(px, "merged"), ["tile_id", "region"], tolerance_px=1.0)


@query("rs23_outline_areas", REGIONS + " SELECT tile_id, CAST(region AS BIGINT) AS region, CAST(count(*) AS DOUBLE) AS area_px FROM q GROUP BY tile_id, region")
def outline_areas(spark, d):
    """Areas of regions by their rings, holes taken off."""
    return arcs.shared_outlines(labelled(spark, d), ["tile_id"]).select("tile_id", "region", "area_px")


@query("rs23_shared_outlines")
def shared_outlines(spark, d):
    """Regions below 3 m2 merged, then rings with holes of all regions, of which neighbours share simplified borders."""
    px = regions.merge_small(pixels(spark, d).select("tile_id", "r", "c", "px_dm", "pred"), "pred", 3, edge_dm="px_dm")
    return arcs.shared_outlines(regions.polygonize(px, "merged"), ["tile_id"], tolerance_px=1.0)
