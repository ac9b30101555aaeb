"""Regions of a whole mosaic of tiles, labelled in two levels.

Each tile is labelled by itself. Along the line between two tiles only the border's pixels meet, by their place on it; equal
values side by side join two tiles' regions. The distinct pairs of regions are a graph whose components name the regions
of the mosaic. No task sees more than one tile or, of the graph, more than edges; a region may span all tiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut, scratch
from . import regions
from .graphs import connected_components

#: A region's name holds the row of its first pixel above this many bits, and the column below.
BITS = 31


def address(row: Column, column: Column) -> Column:
    """One number for a pixel of the mosaic, in order of rows, then columns; both from 0 to 2 ** 31 - 1."""
    return F.shiftleft(row.cast("long"), BITS).bitwiseOR(column.cast("long"))


def placed(px: DataFrame, tiles: DataFrame, edge: int) -> DataFrame:
    """px(tile_id, r, c, ...) with gr and gc: the pixel's row and column in the mosaic of tiles(tile_id, grow, gcol)."""
    at = tiles.select("tile_id", "grow", "gcol")
    return px.join(at, "tile_id").withColumns({"gr": F.col("grow").cast("long") * edge + F.col("r"), "gc": F.col("gcol").cast("long") * edge + F.col("c")}).drop("grow", "gcol")


def border_links(px: DataFrame, value: str, edge: int) -> DataFrame:
    """u, v: names of regions of neighbouring tiles that have equal values side by side; px(gr, gc, value, name).

    The last rows and columns of tiles meet the first ones behind them by address: 4 of edge pixels' sides at most take
    part, and a run of pixels between the same two regions is one link."""
    of = lambda c: F.pmod(c, F.lit(edge))
    links = None
    for along, across in (("gr", "gc"), ("gc", "gr")):
        before = px.where(of(F.col(across)) == edge - 1).select(F.col(along).alias("at"), (F.col(across) + 1).alias("line"), F.col(value).alias("value"), F.col("name").alias("u"))
        behind = px.where(of(F.col(across)) == 0).select(F.col(along).alias("at"), F.col(across).alias("line"), F.col(value).alias("value"), F.col("name").alias("v"))
        found = before.join(behind, ["line", "at", "value"]).select("u", "v").distinct()
        links = found if links is None else links.unionByName(found)
    return links


def mosaic_regions(px: DataFrame, value: str, tiles: DataFrame, edge: int) -> DataFrame:
    """px(tile_id, r, c, value, ...) with gr, gc (row and column in the mosaic) and region: the address of the first pixel,
    by rows, of the 4-connected region of equal values that the pixel belongs to, across all tiles.

    tiles(tile_id, grow, gcol): where each tile is. Pixels of a null value make regions of their own, tile by tile, that
    no border joins; tiles that are missing, cut off or without pixels join nothing."""
    at = placed(regions.polygonize(px, value), tiles, edge)
    # a tile's label is the place of the region's first pixel in the tile
    row, column = F.col("gr") - F.col("r") + F.shiftright("region", 16), F.col("gc") - F.col("c") + F.col("region").bitwiseAND(0xFFFF)
    with scratch(px.sparkSession) as kept:
        named = cut(at.withColumn("name", address(row, column)).drop("region"), "named")
        roots = cut(connected_components(border_links(named.select("gr", "gc", value, "name"), value, edge)), "roots")
        kept += [named, roots]
    return named.join(roots, named["name"] == roots["node"], "left").withColumn("region", F.coalesce("root", "name")).drop("name", "node", "root")


def mosaic_stats(px: DataFrame, edge_dm: str = "px_dm", conf: list[str] | None = None) -> DataFrame:
    """region, n_px, first and last row and column (gr, gc), area_m2 and means of confidences of each region of a mosaic.

    Tiles are summed up before regions: a region of very many tiles sends one row for each task."""
    means = [F.avg(c).alias(f"mean_{c}") for c in conf or []]
    return px.groupBy("region").agg(
        F.count("*").alias("n_px"), F.min("gr").alias("rmin"), F.max("gr").alias("rmax"), F.min("gc").alias("cmin"), F.max("gc").alias("cmax"), (F.sum(F.col(edge_dm) * F.col(edge_dm)) / 100.0).alias("area_m2"), *means
    )


def sizes_back(px: DataFrame) -> DataFrame:
    """px(region, ...) with n_px, the size of the pixel's region in the whole mosaic."""
    return px.join(px.groupBy("region").agg(F.count("*").alias("n_px")), "region")
