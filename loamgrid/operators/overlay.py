"""Exact areas of unions, intersections and differences of layers of boxes.

Boxes are cut at square cells. In a cell the distinct x coordinates make slabs; in a slab boxes are intervals of y, and a
sweep over their ends in order keeps how many boxes of each layer are open, so the covered length up to any end is a
running sum. What of a box is covered is the difference of that sum between its own two ends, so no pair of boxes is ever
made. Equal boxes of a cell count as one with a weight. Cells that hold more distinct boxes than a bound are cut again.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.boxes import BOX, area, box
from ..sources.shared import cut, scratch

#: Distinct boxes of a cell beyond which it is cut into 16, and how often.
MOST_IN_CELL, MOST_CUTS = 128, 8


def _dealt(pieces: DataFrame, size: float) -> DataFrame:
    """pieces(x0, y0, x1, y1, ...) cut at cells of that size: cx, cy and the box inside the cell. Empty boxes have none."""
    x0, y0, x1, y1 = box()
    # a box that ends at a cell's border isn't in the cell behind
    span = lambda a, b: F.sequence(F.floor(a / size), F.greatest(F.ceil(b / size) - 1, F.floor(a / size)))
    rest = [c for c in pieces.columns if c not in (*BOX, "cx", "cy", "size")]
    at = pieces.where((x1 > x0) & (y1 > y0)).select(*rest, *BOX, F.explode(span(x0, x1)).alias("cx"), span(y0, y1).alias("_rows")).withColumn("cy", F.explode("_rows"))
    low, high = F.col("cx") * size, F.col("cy") * size
    inside = (F.greatest(x0, low), F.greatest(y0, high), F.least(x1, low + size), F.least(y1, high + size))
    return at.select(*rest, F.lit(float(size)).alias("size"), "cx", "cy", *(e.alias(n) for e, n in zip(inside, BOX, strict=True)))


def _cells(layers: DataFrame, size: float) -> DataFrame:
    """layers(id, layer, x0, y0, x1, y1) in cells of at most MOST_IN_CELL distinct boxes, or of boxes that all reach over the
    smallest cell's borders."""
    now, done = _dealt(layers, size), []
    for k in range(MOST_CUTS + 1):
        now = cut(now, "cells")
        # a box over the whole cell has no coordinate of its own there
        whole = (F.col("x1") - F.col("x0") == F.col("size")) & (F.col("y1") - F.col("y0") == F.col("size"))
        crowded = now.where(~whole).select("cx", "cy", *BOX).distinct().groupBy("cx", "cy").agg(F.count("*").alias("n")).where(F.col("n") > MOST_IN_CELL).select("cx", "cy")
        if k == MOST_CUTS or not crowded.limit(1).count():
            return functools.reduce(DataFrame.unionByName, [*done, now])
        done.append(now.join(crowded, ["cx", "cy"], "left_anti"))
        size /= 4
        now = _dealt(now.join(crowded, ["cx", "cy"]), size)
    raise AssertionError


def _swept(rects: DataFrame, layers: list[str]) -> DataFrame:
    """Of rects(size, cx, cy, box, a weight for each layer): the ends of their intervals in each slab, with the slab's width,
    how many boxes of each layer are open below the end (n_...), and the length since the end before (step)."""
    cell = ["size", "cx", "cy"]
    x = rects.select(*cell, F.explode(F.array("x0", "x1")).alias("x")).groupBy(*cell).agg(F.sort_array(F.collect_set("x")).alias("xs"))
    slabs = rects.join(x, cell).withColumn("slab", F.explode(F.filter(F.arrays_zip(F.expr("slice(xs, 1, size(xs) - 1)").alias("a"), F.expr("slice(xs, 2, size(xs) - 1)").alias("b")), lambda s: (s["a"] >= F.col("x0")) & (s["b"] <= F.col("x1")))))
    ends = F.explode(F.array(F.struct(F.col("y0").alias("y"), F.lit(1).alias("sign")), F.struct(F.col("y1").alias("y"), F.lit(-1).alias("sign")))).alias("end")
    events = slabs.select(*cell, F.col("slab.a").alias("sx"), (F.col("slab.b") - F.col("slab.a")).alias("width"), *BOX, *layers, ends).select("*", "end.y", "end.sign").drop("end")
    upwards = Window.partitionBy(*cell, "sx").orderBy("y", "sign", *BOX, *layers)
    before = upwards.rowsBetween(Window.unboundedPreceding, -1)
    opened = {f"n_{c}": F.coalesce(F.sum(F.col(c) * F.col("sign")).over(before), F.lit(0)) for c in layers}
    return events.withColumns(opened | {"step": F.coalesce(F.col("y") - F.lag("y").over(upwards), F.lit(0.0))})


def _as_layer(boxes: DataFrame, layer: str) -> DataFrame:
    return boxes.select("id", F.lit(layer).alias("layer"), *(F.col(c).cast("double").alias(c) for c in BOX))


def _rects(pieces: DataFrame, layers: list[str]) -> DataFrame:
    return pieces.groupBy("size", "cx", "cy", *BOX).agg(*(F.sum((F.col("layer") == c).cast("long")).alias(c) for c in layers))


def coverage(boxes: DataFrame, others: DataFrame | None = None, cell: float = 64) -> DataFrame:
    """id, area and covered of each of boxes(id, x0, y0, x1, y1): the area of what all of others cover of it together.

    others(x0, y0, x1, y1): without them the other boxes of the same layer. ids are unique. Null or empty boxes have area 0
    or null and nothing covered; touching covers nothing. cell is about a typical box's size, a power of two at best."""
    own = _as_layer(boxes, "own")
    layers = own if others is None else own.unionByName(_as_layer(others.withColumn("id", F.lit(None).cast(boxes.schema["id"].dataType)), "other"))
    names = ["own"] if others is None else ["own", "other"]
    with scratch(boxes.sparkSession) as kept:
        pieces = _cells(layers, cell)
        ends = _swept(_rects(pieces, names), names)
        is_covered = F.col("n_own") >= 2 if others is None else F.col("n_other") >= 1
        # between the two ends of a box its own interval is open, so what lies between them is inside of it
        upto = F.sum(F.when(is_covered, F.col("step")).otherwise(0.0)).over(Window.partitionBy("size", "cx", "cy", "sx").orderBy("y", "sign", *BOX, *names).rowsBetween(Window.unboundedPreceding, 0))
        covered = ends.withColumn("upto", upto).groupBy("size", "cx", "cy", *BOX).agg(F.sum(-F.col("sign") * F.col("upto") * F.col("width")).alias("covered"))
        mine = pieces.where("layer = 'own'").join(covered, ["size", "cx", "cy", *BOX])
        sums = cut(mine.groupBy("id").agg(F.sum("covered").alias("covered")), "covered")
        kept.append(sums)
    return boxes.select("id", area(box()).cast("double").alias("area")).join(sums, "id", "left").withColumn("covered", F.coalesce("covered", F.lit(0.0)))


def overlay_areas(left: DataFrame, right: DataFrame, cell: float = 64) -> DataFrame:
    """Areas of both layers' unions and of what is in either, in both, in the left only and in the right only.

    left, right (x0, y0, x1, y1): layers of boxes. One row, or none if both layers are empty."""
    named = lambda df, layer: _as_layer(df.withColumn("id", F.lit(0)), layer)
    names = ["own", "other"]
    with scratch(left.sparkSession) as kept:
        ends = _swept(_rects(_cells(named(left, "own").unionByName(named(right, "other")), cell), names), names)
        l, r, size = F.col("n_own") > 0, F.col("n_other") > 0, F.col("step") * F.col("width")
        sums = {"left_area": l, "right_area": r, "union_area": l | r, "both_area": l & r, "left_only": l & ~r, "right_only": r & ~l}
        found = cut(ends.agg(*(F.sum(F.when(c, size).otherwise(0.0)).alias(k) for k, c in sums.items())).where("union_area IS NOT NULL"), "areas")
        kept.append(found)
    return found


def left_over(boxes: DataFrame, others: DataFrame | None = None, least_share: Column | float = 0.4, cell: float = 64) -> DataFrame:
    """id and share of the boxes of which more than least_share is left after the difference with all others."""
    share = 1 - F.try_divide(F.col("covered"), F.col("area"))
    return coverage(boxes, others, cell).select("id", share.alias("share")).where(F.col("share") > least_share)
