"""Grids of cells over areas, hierarchical cells, web tiles, and splits into train, validation and test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut


def quadtree(cells: DataFrame, depth: int) -> DataFrame:
    """cells(cell, x0, y0, x1, y1) and their quarters down to depth: path names the quarters (0 to 3: SW, SE, NW, NE) and
    place is the order in which quarters come before what they are quarters of. A level is one more explode, so the plan
    grows with depth alone."""
    level = cells.select("cell", F.lit(0).alias("depth"), F.lit("").alias("path"), *(F.col(k).cast("double").alias(k) for k in ("x0", "y0", "x1", "y1")))
    out = level
    for _ in range(depth):
        mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
        quarter = lambda k, *b: F.struct(F.lit(str(k)).alias("k"), *(e.alias(n) for e, n in zip(b, ("x0", "y0", "x1", "y1"), strict=True)))
        x0, y0, x1, y1 = (F.col(k) for k in ("x0", "y0", "x1", "y1"))
        four = F.array(quarter(0, x0, y0, mx, my), quarter(1, mx, y0, x1, my), quarter(2, x0, my, mx, y1), quarter(3, mx, my, x1, y1))
        level = level.select("cell", (F.col("depth") + 1).alias("depth"), F.col("path").alias("up"), F.explode(four).alias("q")).select("cell", "depth", F.concat("up", "q.k").alias("path"), "q.x0", "q.y0", "q.x1", "q.y1")
        out = out.unionByName(level)
    # '4' sorts after the quarters: a cell follows its quarters
    order = Window.partitionBy("cell").orderBy(F.rpad("path", depth + 1, "4"))
    return out.withColumn("place", F.row_number().over(order))


def grid_cells(areas: DataFrame, size: float, digits: int = 1) -> DataFrame:
    """Cells in rows over the box of each area (area, x0, y0, x1, y1): area, row, col, unique_id running over all areas,
    str_id of three counters, and the cell's box, rounded. Cells beyond the box by more than a thousandth are left out."""
    n = lambda a, b: F.ceil((F.col(b) - F.col(a)) / size).cast("int")
    rows = areas.withColumn("row", F.explode(F.sequence(F.lit(0), n("y0", "y1") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0), n("x0", "x1") - 1)))
    at = lambda o, k, d: F.round(F.col(o) + (F.col(k) + d) * size, digits)
    cells = rows.select("area", "row", "col", F.col("x1").alias("ax"), F.col("y1").alias("ay"), at("x0", "col", 0).alias("cx0"), at("y0", "row", 0).alias("cy0"), at("x0", "col", 1).alias("cx1"), at("y0", "row", 1).alias("cy1"))
    inside = cells.where((F.col("cx1") <= F.col("ax") + 1e-3) & (F.col("cy1") <= F.col("ay") + 1e-3))
    # ids: what stays of an area are its first rows and columns, so a cell's number follows from these and from the areas before
    stay = lambda o, e: F.size(F.filter(F.sequence(F.lit(0), n(o, e) - 1), lambda k: F.round(F.col(o) + (k + 1) * size, digits) <= F.col(e) + 1e-3))
    sizes = areas.select("area", stay("x0", "x1").alias("columns"), stay("y0", "y1").alias("rows")).withColumn("k", F.col("columns") * F.col("rows")).where("k > 0")
    before = sizes.select("area", "columns", (F.coalesce(F.sum("k").over(Window.partitionBy(F.lit(0)).orderBy("area").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("before"), F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("area")).alias("rank"))
    named = inside.join(before, "area")  # a row for each area
    return named.select("area", "row", "col", (F.col("before") + F.col("row") * F.col("columns") + F.col("col")).cast("long").alias("unique_id"), F.concat_ws("-", F.col("rank") - 1, F.col("row"), F.col("col")).alias("str_id"), F.col("cx0").alias("x0"), F.col("cy0").alias("y0"), F.col("cx1").alias("x1"), F.col("cy1").alias("y1"))


def grid_size(length: Column, cell: Column | float, overlap: Column | float) -> Column:
    """Cells of a size that a length needs if neighbours overlap."""
    return F.ceil((length - overlap) / (cell - overlap)).cast("int")


def overlapping_grid(tiles: DataFrame, cell: int, overlap: int, region: int, prefix: str = "") -> DataFrame:
    """Cells over each tile (tile_id, x0, y0, x1, y1, whole decimetres) from its upper left corner: row, col within their
    region (rows count downwards), the region's corner and a file name of these."""
    step = cell - overlap
    n = lambda a, b: grid_size(F.col(b) - F.col(a), F.lit(cell), F.lit(overlap))
    cells = tiles.withColumn("i", F.explode(F.sequence(F.lit(0), n("y0", "y1") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), n("x0", "x1") - 1)))
    minx, maxy = F.col("x0") + F.col("j") * step, F.col("y1") - F.col("i") * step
    rx, ry = F.pmod(minx, F.lit(region)), F.pmod(-maxy, F.lit(region))
    out = cells.select("tile_id", minx.alias("minx"), maxy.alias("maxy"), F.floor(rx / step).cast("int").alias("col"), F.floor(ry / step).cast("int").alias("row"), (minx - rx).alias("region_x"), (maxy + ry).alias("region_y"))
    return out.withColumn("file_name", F.concat(F.lit(prefix), F.concat_ws("_", "region_x", "region_y", "row", "col"), F.lit(".tif")))


def web_tile(lon: Column, lat: Column, zoom: Column) -> tuple[Column, Column]:
    """Column and row of the web-mercator tile of a place."""
    n = F.pow(F.lit(2.0), zoom)
    x = F.floor((lon + 180) / 360 * n)
    y = F.floor((1 - F.log(F.tan(F.radians(lat)) + 1 / F.cos(F.radians(lat))) / F.pi()) / 2 * n)
    return x.cast("long"), y.cast("long")


def matrix_tiles(boxes: DataFrame, origin_x: float, origin_y: float, span: float, template: str) -> DataFrame:
    """Addresses of the tiles of a matrix (span metres wide, from its upper left corner) that boxes need, both ends
    included, and the template with {TileCol} and {TileRow} filled in."""
    lo = lambda e: F.floor(e / span).cast("int")
    hi = lambda e: F.ceil(e / span).cast("int")
    rows = boxes.withColumn("tile_col", F.explode(F.sequence(lo(F.col("x0") - origin_x), hi(F.col("x1") - origin_x)))).withColumn("tile_row", F.explode(F.sequence(lo(origin_y - F.col("y1")), hi(origin_y - F.col("y0")))))
    url = F.replace(F.replace(F.lit(template), F.lit("{TileCol}"), F.col("tile_col").cast("string")), F.lit("{TileRow}"), F.col("tile_row").cast("string"))
    return rows.select("id", "tile_col", "tile_row", url.alias("url"))


#: Scales of a pyramid that best_scale() takes.
MOST_SCALES = 1000


def best_scale(wanted: DataFrame, scales: DataFrame) -> DataFrame:
    """For each of wanted(id, wanted) the first of scales(place, size), by place, whose pixel isn't larger, else the last.

    A pyramid has few scales, so they are one literal; more than MOST_SCALES are refused."""
    rows = scales.select("place", "size").orderBy("place").limit(MOST_SCALES + 1).collect()
    if len(rows) > MOST_SCALES:
        raise ValueError(f"more than {MOST_SCALES} scales")
    if not rows:
        return wanted.select("id").limit(0).crossJoin(scales.select("place", "size").limit(0))
    kind = {f.name: f.dataType for f in scales.schema.fields}
    every = F.array(*(F.struct(F.lit(r["place"]).cast(kind["place"]).alias("place"), F.lit(r["size"]).cast(kind["size"]).alias("size")) for r in rows))
    found = F.coalesce(F.get(F.filter(every, lambda s: s["size"] <= F.col("wanted")), F.lit(0)), F.element_at(every, -1))
    return wanted.select("id", found.alias("found")).select("id", "found.place", "found.size")


def shuffled(df: DataFrame, key: str, seed: int, by: list[str] | None = None) -> DataFrame:
    """df with place (from 0) in an order of hashes that any engine can repeat, and how many there are, within `by`.

    Hashes are dealt to 4096 buckets: a row's place is its rank in its bucket and the sizes of the buckets before it, so
    no task sorts a whole group."""
    keys = by or []
    h = F.pmod(F.col(key).cast("long") * 48271 + seed, F.lit(2147483647))
    dealt = df.withColumns({"_h": h, "_bucket": F.shiftright(h, 19)})
    sizes = dealt.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*(keys or [F.lit(0)]))  # at most 4096 rows each
    before = sizes.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_bucket").alias("_b"), (F.sum("_n").over(group.orderBy("_bucket")) - F.col("_n")).alias("_before"), F.sum("_n").over(group).alias("many"))
    same = F.col("_bucket") == F.col("_b")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    rank = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy("_h", key)) - 1
    return dealt.withColumn("_rank", rank).join(before, same).withColumn("place", F.col("_before") + F.col("_rank")).select(*df.columns, "place", "many")


def in_order(df: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """df with place (from 0) in order of key within `by`, and how many there are. Rows are range-sorted; a place is the rank
    in a range and the ranges' sizes before it, so no task holds a whole group."""
    keys = by or []
    ranged = cut(df.repartitionByRange(*keys, key).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*(keys or [F.lit(0)]))  # a row for each range
    before = sizes.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_part").alias("_p"), (F.sum("_n").over(group.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(group).alias("many"))
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    rank = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(key)) - 1
    return ranged.withColumn("_rank", rank).join(before, same).withColumn("place", F.col("_before") + F.col("_rank")).select(*df.columns, "place", "many")


def split(df: DataFrame, key: str, seed: int, by: list[str] | None = None, train: float = 0.7) -> DataFrame:
    """df with split: so much of each group for train, half of the rest for val, the others for test."""
    s = shuffled(df, key, seed, by)
    n_train = F.floor(F.col("many") * train)
    n_val = n_train + F.floor((F.col("many") - n_train) / 2)
    return s.withColumn("split", F.when(F.col("place") < n_train, "train").when(F.col("place") < n_val, "val").otherwise("test")).drop("place", "many")


def val_to_test(df: DataFrame, key: str) -> DataFrame:
    """The first half of val in order of key, and one more, becomes test."""
    val = in_order(df.where("split = 'val'"), key)
    move = F.col("place") < F.floor(F.col("many") / 2) + 1
    moved = val.withColumn("split", F.when(move, "test").otherwise(F.col("split"))).select(df.columns)
    return df.where("NOT split <=> 'val'").unionByName(moved)


def same_aspect(df: DataFrame, width: Column, height: Column, to_width: Column, to_height: Column, digits: int = 2) -> DataFrame:
    """df, with an error for a row whose ratio of width to height isn't that of its target, to so many digits."""
    ratio = lambda w, h: F.round(w / h, digits)
    ok = ratio(width, height) == ratio(to_width, to_height)
    return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit("aspect ratios differ")).cast("boolean")))
