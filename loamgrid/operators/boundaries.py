"""Boundaries of labelled regions in expressions: sides of pixels, straight arms, corners, and what they decide.

A region's boundary is walked with the region on the left as seen with y up: down its left sides (L), to the right along
its bottom sides (B), up its right sides (R) and to the left along its top sides (T). Sides of one line that follow each
other are an arm. Where an arm ends another begins; of two that begin at one place (pixels that touch at a corner only) the
left turn is the boundary, as diagonal pixels aren't connected. A left turn is a convex corner.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut, scratch

#: The arm that a left turn and that a right turn leads to.
LEFT, RIGHT = {"L": "B", "B": "R", "R": "T", "T": "L"}, {"L": "T", "B": "L", "R": "B", "T": "R"}


def _turn(side: Column, turns: dict[str, str]) -> Column:
    return F.translate(side, "".join(turns), "".join(turns.values()))


def together(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows dealt by keys: windows and groups on keys and more need no further exchange.

    The number of partitions is given, as pixels are small rows whose sides and arms are larger than Spark expects."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def sides(px: DataFrame, keys: list[str], region: str = "region") -> DataFrame:
    """keys, region, side, line, at, other: each side of a pixel behind which another region (other) or nothing (null) is.

    px(keys, r, c, region): line is the row or column of the grid's line that the side lies on, at its place there. The rows
    are dealt by keys."""
    row, column = Window.partitionBy(*keys, "r").orderBy("c"), Window.partitionBy(*keys, "c").orderBy("r")
    beside = lambda f, w, c, step: F.when(f(c).over(w) == F.col(c) + step, f("region").over(w))
    near = together(px.select(*keys, "r", "c", F.col(region).alias("region")), keys).withColumns({"_L": beside(F.lag, row, "c", -1), "_R": beside(F.lead, row, "c", 1), "_T": beside(F.lag, column, "r", -1), "_B": beside(F.lead, column, "r", 1)})
    each = [F.struct(F.lit(s).alias("side"), line.cast("int").alias("line"), F.col(at).cast("int").alias("at"), F.col(f"_{s}").alias("other")) for s, line, at in (("L", F.col("c"), "r"), ("B", F.col("r") + 1, "c"), ("R", F.col("c") + 1, "r"), ("T", F.col("r"), "c"))]
    open_ = F.filter(F.array(*each), lambda e: e["other"].isNull() | (e["other"] != F.col("region")))
    return near.select(*keys, "region", F.inline(open_))


def arms(rows: DataFrame, keys: list[str], by_other: bool = False) -> DataFrame:
    """keys, region, side, line, a, b, length and sy, sx, ey, ex (where it begins and ends) of each arm; by_other: arms end where
    another neighbour begins, and have the column other."""
    on = [*keys, "region", "side", "line", *(["other"] if by_other else [])]
    island = F.col("at") - F.row_number().over(Window.partitionBy(*on).orderBy("at"))
    found = rows.withColumn("_island", island).groupBy(*on, "_island").agg(F.min("at").alias("a"), (F.max("at") + 1).alias("b")).drop("_island")
    forth, upright = F.col("side").isin("L", "B"), F.col("side").isin("L", "R")
    start, end = F.when(forth, F.col("a")).otherwise(F.col("b")), F.when(forth, F.col("b")).otherwise(F.col("a"))
    at = {"sy": F.when(upright, start).otherwise(F.col("line")), "sx": F.when(upright, F.col("line")).otherwise(start), "ey": F.when(upright, end).otherwise(F.col("line")), "ex": F.when(upright, F.col("line")).otherwise(end)}
    return found.withColumns({"length": F.col("b") - F.col("a")} | at)


def corners(found: DataFrame, keys: list[str]) -> DataFrame:
    """keys, region, side, y, x, before, after, convex: each corner, where it lies, the lengths of the arms that meet there,
    and the side of the arm before it. Arms meet by grouping their ends by place; a side ends or begins there once at most."""
    on = [*keys, "region"]
    end = lambda y, x, ends: F.struct(F.col(y).alias("y"), F.col(x).alias("x"), F.lit(ends).alias("ends"))
    ends = found.select(*on, "side", "length", F.inline(F.array(end("ey", "ex", True), end("sy", "sx", False))))
    lengths = [F.max(F.when((F.col("side") == s) & (F.col("ends") == e), F.col("length"))).alias(f"_{s}{int(e)}") for s in LEFT for e in (True, False)]
    begun = lambda s: F.col(f"_{s}0")
    turn = lambda s: F.struct(F.lit(s).alias("side"), F.col(f"_{s}1").alias("before"), F.coalesce(begun(LEFT[s]), begun(RIGHT[s])).alias("after"), begun(LEFT[s]).isNotNull().alias("convex"))
    met = ends.groupBy(*on, "y", "x").agg(*lengths)
    turns = F.filter(F.array(*map(turn, LEFT)), lambda t: t["before"].isNotNull() & t["after"].isNotNull())
    return met.select(*on, "y", "x", F.inline(turns)).select(*on, "side", "y", "x", "before", "after", "convex")


def with_outer(every: DataFrame, keys: list[str]) -> DataFrame:
    """corners() with the column outer: whether they are of their region's outer ring.

    A ring's convex corners are four more than its others if it is the outer one, and four fewer if it is a hole's. A small
    kernel on one tile's corners follows the rings by doubling pointers from corner to corner."""
    kinds = dict(every.dtypes)
    names = [*keys, "region", "side", "y", "x", "before", "after", "convex"]

    def run(table: pa.Table) -> pa.Table:
        y, x, after, convex = (table[k].to_numpy().astype(np.int64) for k in ("y", "x", "after", "convex"))
        side = pc.index_in(table["side"], pa.array(list(LEFT))).to_numpy()
        # the next arm, by its direction, leads to the next corner
        ahead = (side + np.where(convex == 1, 1, 3)) % 4
        to_y, to_x = y + np.array([1, 0, -1, 0])[ahead] * after, x + np.array([0, 1, 0, -1])[ahead] * after
        own, height, width = np.unique(table["region"].to_numpy(), return_inverse=True)[1], int(y.max()) + 1, int(x.max()) + 1
        place = lambda y, x, side: ((own * height + y) * width + x) * 4 + side
        at = place(y, x, side)
        order = np.argsort(at)
        to = order[np.searchsorted(at[order], place(to_y, to_x, ahead))]
        ring = np.arange(len(to))
        for _ in range(len(to).bit_length()):
            ring, to = np.minimum(ring, ring[to]), to[to]
        return table.append_column("outer", pa.array(np.bincount(ring, np.where(convex == 1, 1, -1), len(ring))[ring] > 0))

    return every.select(names).groupBy(*keys).applyInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in names) + ", outer boolean")


def outer_corners(found: DataFrame, keys: list[str]) -> DataFrame:
    """corners() of the outer ring of each region."""
    return with_outer(corners(found, keys), keys).where("outer").drop("outer")


def _large(px_edge_dm: Column, least_product: float) -> Column:
    """Whether the arms' product exceeds least_product m2."""
    return F.col("before") * F.col("after") * px_edge_dm * px_edge_dm / 100.0 > least_product


def candidates(px: DataFrame, keys: list[str], edge_dm: str = "px_dm", most_perimeter: float = 400, least_fill: float = 0.4, least_product: float = 50) -> DataFrame:
    """keys, region, convex, perimeter_m, fill of the regions that look like cut-out squares: 1 to 4 convex right angles with
    large arms on the outer ring, a boundary (holes included) below most_perimeter m, and more than least_fill of the
    bounding box. px(keys, r, c, region, edge_dm): the pixels of a tile have one edge."""
    on, tile = [*keys, "region"], [*keys, edge_dm]
    turns = with_outer(corners(arms(sides(px, tile), tile), tile), tile)
    # each arm ends at a corner, so lengths, extents and areas of regions are sums over corners
    swept = F.when(F.col("side") == "R", F.col("x") * F.col("before")).when(F.col("side") == "L", -F.col("x") * F.col("before"))
    h, w = F.max("y") - F.min("y"), F.max("x") - F.min("x")
    shapes = turns.groupBy(*on).agg(
        F.count_if(F.col("outer") & F.col("convex") & _large(F.col(edge_dm), least_product)).alias("convex"),
        (F.sum("before") * F.max(edge_dm) / 10.0).alias("perimeter_m"), (F.sum(swept) / (h * w)).alias("fill"),
    )
    return shapes.where((F.col("convex") > 0) & (F.col("convex") < 5) & (F.col("fill") > least_fill) & (F.col("perimeter_m") < most_perimeter))


def neighbours(px: DataFrame, keys: list[str], edge_dm: str = "px_dm", least_product: float = 50) -> DataFrame:
    """keys, region, neighbour, shared_px, angles: how much boundary two regions share and how many convex right angles with
    large arms the first one has on it. Arms end where the shared stretch does."""
    on = [*keys, "region", "other"]
    with scratch(px.sparkSession) as kept:
        rows = cut(sides(px, keys).where("other IS NOT NULL"), "sides")
        kept.append(rows)
    shared = rows.groupBy(*on).agg(F.count("*").alias("shared_px"))
    found = arms(rows, keys, by_other=True)
    ends = found.select(*on, _turn(F.col("side"), LEFT).alias("next"), F.col("ey").alias("y"), F.col("ex").alias("x"), F.col("length").alias("before"))
    begins = found.select(*on, F.col("side").alias("next"), F.col("sy").alias("y"), F.col("sx").alias("x"), F.col("length").alias("after"))
    edge = px.groupBy(*keys).agg(F.max(edge_dm).alias("_edge"))
    turns = ends.join(begins, [*on, "next", "y", "x"]).join(edge, keys).where(_large(F.col("_edge"), least_product)).groupBy(*on).agg(F.count("*").alias("angles"))
    return shared.join(turns, on, "left").select(*keys, "region", F.col("other").alias("neighbour"), "shared_px", F.coalesce("angles", F.lit(0).cast("long")).alias("angles"))


def best_neighbours(px: DataFrame, keys: list[str], edge_dm: str = "px_dm", least_product: float = 50) -> DataFrame:
    """keys, region, neighbour, angles, shared_px: of each region the neighbour with the most right angles on the shared
    boundary, at least one, then the longest shared boundary, then the smallest label."""
    best = F.max_by(F.struct("neighbour", "angles", "shared_px"), F.struct("angles", "shared_px", -F.col("neighbour"))).alias("b")
    return neighbours(px, keys, edge_dm, least_product).where("angles > 0").groupBy(*keys, "region").agg(best).select(*keys, "region", "b.*")
