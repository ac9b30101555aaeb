"""Tiles, mosaics and pixel grids as relations of (tile, row, column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.boxes import BOX, box
from .copies import last_of


def crop_border(px: DataFrame, border: int, edge: int) -> DataFrame:
    """Pixels without `border` rows and columns at each side of tiles of `edge`; rows and columns count from 0 again."""
    inside = F.col("r").between(border, edge - border - 1) & F.col("c").between(border, edge - border - 1)
    return px.where(inside).withColumns({"r": F.col("r") - border, "c": F.col("c") - border})


def rescale_nearest(px: DataFrame, factor: float, edge: int) -> DataFrame:
    """Tiles of edge / factor (cut to a whole number): the pixel under each new centre. A factor of 1 changes nothing.
    The few new rows and columns are computed once, and pixels are looked up by an equi-join."""
    size = int(edge / factor)
    spark = px.sparkSession
    new = spark.range(size).select(F.col("id").cast("int").alias("to"), F.floor((F.col("id") + 0.5) * edge / size).cast("int").alias("at"))
    rows, cols = new.toDF("r_new", "r"), new.toDF("c_new", "c")
    found = px.join(F.broadcast(rows), "r").join(F.broadcast(cols), "c")  # `size` rows each
    return found.withColumns({"r": F.col("r_new"), "c": F.col("c_new")}).select(px.columns)


def mosaic(px: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """One pixel for each address: the value of the first in order that has one (null is no value)."""
    return px.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias(value))


def bounds(tiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    return tiles.groupBy(*(by or [])).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def tile_boxes(px: DataFrame, tiles: DataFrame, edge: int = 32) -> DataFrame:
    """Boxes of tiles (tile_id, grow, gcol) in pixels; y grows upwards, so rows count downwards."""
    return tiles.select("tile_id", (F.col("gcol") * edge).alias("x0"), (-(F.col("grow") + 1) * edge).alias("y0"), ((F.col("gcol") + 1) * edge).alias("x1"), (-F.col("grow") * edge).alias("y1"))


def bands(px: DataFrame, first: int, last: int) -> DataFrame:
    return px.where(F.col("band").between(first, last)).withColumn("band", F.col("band") - first + 1)


def masked(px: DataFrame, value: str, nodata: int) -> DataFrame:
    return px.withColumn(value, F.when(F.col(value) != nodata, F.col(value)))


def drop_empty(px: DataFrame, value: str, key: str = "tile_id") -> DataFrame:
    """Keys of tiles that have a value other than 0."""
    return px.groupBy(key).agg(F.max(F.abs(value)).alias("top")).where("top <> 0").select(key)


def cut_to_cells(px: DataFrame, cell: int, tolerance: int = 2) -> DataFrame:
    """Pixels of a mosaic (r, c) as cells of cell x cell pixels: crow, ccol, r, c; cells that lack more than tolerance
    rows or columns are left out. Division gives the cell, so no box is compared."""
    at = px.withColumns({"crow": F.floor(F.col("r") / cell).cast("int"), "ccol": F.floor(F.col("c") / cell).cast("int")}).withColumns({"r": F.pmod("r", F.lit(cell)).cast("int"), "c": F.pmod("c", F.lit(cell)).cast("int")})
    keys = [k for k in ("tile_id",) if k in px.columns]
    sizes = at.groupBy(*keys, "crow", "ccol").agg((F.max("r") + 1).alias("h"), (F.max("c") + 1).alias("w"))
    whole = sizes.where((F.abs(F.col("h") - cell) <= tolerance) & (F.abs(F.col("w") - cell) <= tolerance)).select(*keys, "crow", "ccol")
    return at.join(whole, [*keys, "crow", "ccol"])


def pad(px: DataFrame, edge: int, keys: list[str], value: str) -> DataFrame:
    """All edge * edge pixels of each tile; those that it lacks at the right and bottom are 0."""
    spark = px.sparkSession
    at = spark.range(edge * edge).select((F.col("id") / edge).cast("int").alias("r"), (F.col("id") % edge).cast("int").alias("c"))
    grid = px.select(*keys).distinct().crossJoin(F.broadcast(at))  # a constant number of pixels for each tile
    return grid.join(px.select(*keys, "r", "c", value), [*keys, "r", "c"], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def zero_fill(px: DataFrame, value: str, edge: int, wrap: bool = False, key: str = "tile_id") -> DataFrame:
    """Zeros take the value below, then to the right, above and to the left; each pass sees what the one before filled.
    wrap: the other end of the tile counts as a neighbour, too."""
    for dr, dc in ((1, 0), (0, 1), (-1, 0), (0, -1)):
        src = px.select(key, *((F.pmod(F.col(k) - d, F.lit(edge)) if wrap else F.col(k) - d).cast("int").alias(k) for k, d in (("r", dr), ("c", dc))), F.col(value).alias("_from"))
        filled = F.when(F.col(value) == 0, F.coalesce("_from", F.lit(0))).otherwise(F.col(value))
        px = px.join(src, [key, "r", "c"], "left").withColumn(value, filled).drop("_from")
    return px


def mask_outside(px: DataFrame, inside: Column, value: str, nodata: int, invert: bool = False) -> DataFrame:
    """inside: whether a pixel's centre is in the mask."""
    return px.withColumn(value, F.when(~inside if invert else inside, F.col(value)).otherwise(nodata))


def rasterize(boxes: DataFrame, value: str, order: str, background: DataFrame, cell: int = 32) -> DataFrame:
    """background(r, c) with the value of the last box, by order, that holds the pixel's centre, else 0. Boxes are dealt
    to cells of pixels; a pixel is in one cell. Of equal boxes only the last one is dealt, and cells are dealt to as many
    tasks as shuffles have: their work is as pixels times boxes."""
    x0, y0, x1, y1 = box()
    n = int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = lambda a, b: F.sequence(F.floor(a / cell), F.floor((b - 1) / cell))
    dealt = last_of(boxes.where((x1 > x0) & (y1 > y0)), list(BOX), value, order).withColumn("cy", F.explode(span(y0, y1))).withColumn("cx", F.explode(span(x0, x1)))
    px = background.withColumns({"cy": F.floor(F.col("r") / cell), "cx": F.floor(F.col("c") / cell)})
    hit = px.repartition(n, "cy", "cx").join(dealt.repartition(n, "cy", "cx").hint("merge"), ["cy", "cx"]).where((F.col("c") + 0.5 > x0) & (F.col("c") + 0.5 < x1) & (F.col("r") + 0.5 > y0) & (F.col("r") + 0.5 < y1))
    won = hit.groupBy("r", "c").agg(F.max_by(value, order).alias(value))
    return background.join(won, ["r", "c"], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def content_box(px: DataFrame, value: str, key: str = "tile_id") -> DataFrame:
    """The rows and columns that hold something other than 0."""
    return px.where(F.col(value) != 0).groupBy(key).agg(*(f(k).alias(f"{k}{n}") for k in ("r", "c") for n, f in (("0", F.min), ("1", F.max))))


def window_starts(length: int, crop: int, stride: int) -> list[int]:
    """Where sliding windows begin; the last one is moved back to end with the input."""
    n = max(length - crop + stride - 1, 0) // stride + 1
    return [max(min(k * stride + crop, length) - crop, 0) for k in range(n)]


def sliding_mean(px: DataFrame, value: str, edge: int, crop: int, stride: int, key: str = "tile_id", weight: str | None = None) -> DataFrame:
    """key, r, c, n (windows over the pixel), mean of the windows' values there. A window's value at a pixel is that of
    the pixel, plus `weight` times the window's number if given: what a model returns for each window stands there."""
    starts = window_starts(edge, crop, stride)
    at = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("s")) for k, s in enumerate(starts)])
    hits = lambda c: F.filter(at, lambda w: (F.col(c) >= w["s"]) & (F.col(c) < w["s"] + crop))
    each = px.select(key, "r", "c", value, *([weight] if weight else []), F.explode(hits("r")).alias("wr"), hits("c").alias("wcs")).withColumn("wc", F.explode("wcs"))
    seen = F.col(value) + (F.col(weight) * (F.col("wr.k") * len(starts) + F.col("wc.k")) if weight else 0)
    return each.groupBy(key, "r", "c").agg(F.count("*").alias("n"), (F.sum(seen) / F.count("*")).alias("mean"))


def flip_mean(px: DataFrame, value: str, edge: int, key: str = "tile_id") -> DataFrame:
    """Mean of a score and of that of the mirrored tile, mirrored back."""
    back = px.select(key, "r", (edge - 1 - F.col("c")).alias("c"), F.col(value).alias("_mirrored"))
    return px.join(back, [key, "r", "c"], "left").select(key, "r", "c", ((F.col(value) + F.coalesce("_mirrored", F.col(value))) / 2).alias("mean"))


def region_key(name: Column) -> Column:
    """Of a tile's file name: the characters that name its region."""
    return F.concat_ws("_", F.substring(name, 1, 6), F.substring(name, 10, 6))
