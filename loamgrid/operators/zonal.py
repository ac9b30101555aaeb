"""Means over any box zones by summed-area tables, block by block.

A mosaic is cut into blocks of a fixed edge. Of each block one row holds, for every place in it, the sum and the number of
pixels above and to the left. What a zone has of a block is at most four of these numbers, so a zone costs a few look-ups
for each block that it meets, however many pixels it has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.boxes import BOX


def summed_areas(px: DataFrame, values: list[str], block: int = 64) -> DataFrame:
    """by, bx and, row by row of the block, the running sums of each of the values, of the pixels that have it (n_...), and of
    all pixels that are there (n).

    px(r, c, values): whole-numbered places; missing pixels and null values count nothing. Blocks are of block x block."""
    columns = ["n", *values, *(f"n_{v}" for v in values)]

    def run(table: pa.Table) -> pa.Table:
        place = table["r"].to_numpy() % block * block + table["c"].to_numpy() % block
        out = {k: [table[k][0].as_py()] for k in ("by", "bx")}
        for name in columns:
            if name in values:
                own = np.asarray(pa.compute.fill_null(table[name].cast(pa.float64()), 0.0))
            else:
                own = np.ones(len(place)) if name == "n" else np.asarray(table[name.removeprefix("n_")].is_valid(), np.float64)
            grid = np.bincount(place, own, block * block).reshape(block, block)
            out[name] = [grid.cumsum(0).cumsum(1).ravel().tolist()]
        return pa.table(out, schema=pa.schema([("by", pa.int64()), ("bx", pa.int64()), *((k, pa.list_(pa.float64())) for k in columns)]))

    at = px.select("r", "c", *values, F.floor(F.col("r") / block).alias("by"), F.floor(F.col("c") / block).alias("bx"))
    lists = ", ".join(f"{k} array<double>" for k in columns)
    return at.groupBy("by", "bx").applyInArrow(run, f"by long, bx long, {lists}")


def _inside(sums: str, block: int) -> Column:
    """Of the box (_x0, _y0) to (_x1, _y1) in a block, last row and column left out: by its four corners."""
    at = lambda y, x: F.when((F.col(y) > 0) & (F.col(x) > 0), F.get(F.col(sums), ((F.col(y) - 1) * block + F.col(x) - 1).cast("int"))).otherwise(0.0)
    return at("_y1", "_x1") - at("_y0", "_x1") - at("_y1", "_x0") + at("_y0", "_x0")


def box_means(zones: DataFrame, areas: DataFrame, values: list[str], block: int = 64) -> DataFrame:
    """id, n (pixels) and the mean of each value, of those pixels that have it, over each of zones(id, x0, y0, x1, y1), last row and column left out; zones
    without pixels are left out. areas: summed_areas() of the same values and block."""
    x0, y0, x1, y1 = (F.col(k) for k in BOX)
    span = lambda a, b: F.sequence(F.floor(a / block), F.floor((b - 1) / block))
    dealt = zones.where((x1 > x0) & (y1 > y0)).select("id", *BOX, F.explode(span(x0, x1)).alias("bx"), span(y0, y1).alias("_rows")).withColumn("by", F.explode("_rows")).drop("_rows")
    clip = lambda v, k: F.least(F.greatest(v - F.col(k) * block, F.lit(0)), F.lit(block))
    parts = dealt.select("id", "by", "bx", clip(x0, "bx").alias("_x0"), clip(x1, "bx").alias("_x1"), clip(y0, "by").alias("_y0"), clip(y1, "by").alias("_y1"))
    sums = parts.join(areas, ["by", "bx"]).groupBy("id").agg(*(F.sum(_inside(k, block)).alias(k) for k in ("n", *values, *(f"n_{v}" for v in values)))).where("n > 0")
    return sums.select("id", F.col("n").cast("long").alias("n"), *(F.try_divide(F.col(k), F.col(f"n_{k}")).alias(k) for k in values))
