"""Outlines of regions with holes, of which neighbours share their borders: arcs, simplified once each.

Arms (straight stretches of a border with one neighbour) are linked to the next one of their region, which makes rings.
Places where neighbours change, where a region touches itself and the raster's corners are nodes; between two nodes lies an
arc, which belongs to the two regions at its sides. An arc is simplified for one of them, and the other one takes the same
points backwards, so simplified regions still fit together and their areas still sum up to the whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut, scratch
from .boundaries import arms, sides, together
from .regions import kept_points

POINTS = "array<struct<x: double, y: double>>"
#: Rounds of pointer doubling: chains of up to 2 ** 40 rows.
MOST_ROUNDS = 40


def ranked(rows: DataFrame) -> DataFrame:
    """rows(node, before): node and rank, how many rows lie before it in its chain; before is null for the first one. For chains
    that no task has whole; those of a tile are ordered by ring_order().

    Pointers are doubled: each round a row takes on what its predecessor knows of those before."""
    with scratch(rows.sparkSession) as kept:
        now = cut(rows.select("node", F.col("before").alias("to"), F.col("before").isNotNull().cast("long").alias("rank")), "ranks")
        for _ in range(MOST_ROUNDS):
            if not now.where("to IS NOT NULL").limit(1).count():
                break
            ahead = now.select(F.col("node").alias("to"), F.col("to").alias("further"), F.col("rank").alias("more"))
            now = cut(now.join(ahead, "to", "left").select("node", F.col("further").alias("to"), (F.col("rank") + F.coalesce("more", F.lit(0))).alias("rank")), "ranks")
        kept.append(now)
    return now.select("node", "rank")


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Points (x, y) one after the other as lists of these sizes."""
    fields = [pa.field("x", pa.float64()), pa.field("y", pa.float64())]
    points = pa.StructArray.from_arrays([pa.array(values[:, 0]), pa.array(values[:, 1])], fields=fields)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), points)


def ring_order(following: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each member of closed rings, the ring's member with the smallest order, and how many steps lie from that one to it.

    following: the index of the next member. Pointers are doubled: in each round a member takes on what is known further on."""
    n = len(following)
    rounds = range(n.bit_length())
    best, to = order.copy(), following
    for _ in rounds:
        best, to = np.minimum(best, best[to]), to[to]
    member = np.empty(n, np.int64)
    member[order] = np.arange(n)
    head = member[best]
    is_head = head == np.arange(n)
    ahead, to = np.where(is_head, 0, 1), np.where(is_head, head, following)
    for _ in rounds:
        ahead, to = ahead + ahead[to], to[to]
    length = np.bincount(head, minlength=n)[head]
    return head, (length - ahead) % length


def traced(found: DataFrame, keys: list[str]) -> DataFrame:
    """keys, region, other, ring, arc, place, line: the arcs of arms(by_other), of each ring (a number in its tile) in order.

    place is one of the grid's places in an arc, the same one for both regions, and line has its points. A small kernel on one
    tile's arms finds the next arm of each one, the nodes, and each ring's order from its first node, or from its first place if
    it has none: its neighbour's ring begins there, too."""

    def run(table: pa.Table) -> pa.Table:
        region, line, a, sy, sx, ey, ex, name = (table[k].to_numpy() for k in ("region", "line", "a", "sy", "sx", "ey", "ex", "name"))
        side = pc.index_in(table["side"], pa.array(list("LBRT"))).to_numpy()
        other = pc.fill_null(pc.index_in(table["other"], table["region"].unique()), -1).to_numpy()
        n, width = len(region), int(max(sx.max(), ex.max())) + 1
        start, end = sy.astype(np.int64) * width + sx, ey.astype(np.int64) * width + ex
        own = np.unique(region, return_inverse=True)[1] * (int(max(start.max(), end.max())) + 1)
        begins, ends = (own + start) * 4 + side, (own + end) * 4
        by_begin = np.argsort(begins)
        sorted_begins = begins[by_begin]

        def begun(turned: int) -> np.ndarray:
            wanted = ends + (side + turned) % 4
            at = np.minimum(np.searchsorted(sorted_begins, wanted), n - 1)
            return np.where(sorted_begins[at] == wanted, by_begin[at], -1)

        # of two that begin where pixels touch at a corner, the left turn is next
        left, straight, right = begun(1), begun(0), begun(3)
        following = np.where(left >= 0, left, np.where(straight >= 0, straight, right))
        pinch = (left >= 0).astype(int) + (straight >= 0) + (right >= 0) > 1
        corner = (other < 0) & (other[following] < 0) & ((left >= 0) | (straight < 0))
        is_node = np.isin(start, end[(other != other[following]) | pinch | corner])
        order = np.empty(n, np.int64)
        order[np.lexsort((name, sx, sy, ~is_node))] = np.arange(n)
        head, rank = ring_order(following, order)
        along = np.lexsort((rank, head))
        opens = (is_node | (rank == 0))[along]
        first = np.flatnonzero(opens)
        last = np.append(first[1:], n) - 1
        arc = np.cumsum(opens)
        arc -= np.maximum.accumulate(np.where(rank[along] == 0, arc - 1, 0))
        # an arc's points are its arms' starts and the last one's end
        upright = (side % 2 == 0).astype(np.int64)
        place = np.minimum.reduceat(((upright << 62) + (line.astype(np.int64) << 31) + a)[along], first)
        points = np.insert(np.stack([sx, sy], 1)[along], last + 1, np.stack([ex, ey], 1)[along][last], axis=0).astype(float)
        at = along[first]
        return table.select([*keys, "region", "other"]).take(pa.array(at)).append_column("ring", pa.array(head[at])).append_column("arc", pa.array(arc[first])).append_column("place", pa.array(place)).append_column("line", _lists(points, last - first + 2))

    kinds = dict(found.dtypes)
    named = found.select(*keys, "region", "other", "side", "line", "a", "sy", "sx", "ey", "ex", F.xxhash64(*keys, "region", "side", "sy", "sx").alias("name"))
    return named.groupBy(*keys).applyInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in (*keys, "region", "other")) + f", ring long, arc long, place long, line {POINTS}")


def _simplified(points: Column, tolerance: float) -> Column:
    """A line with fewer points, both ends kept; a closed one is cut at the point farthest from its ends."""

    @F.arrow_udf(POINTS)
    def run(lines: pa.Array) -> pa.Array:
        sizes, flat = pc.list_value_length(lines).to_numpy(), lines.flatten()
        xy = np.stack([flat.field("x").to_numpy(), flat.field("y").to_numpy()], 1)
        keep, begins = np.ones(len(xy), bool), np.cumsum(sizes) - sizes
        for k in np.flatnonzero(sizes > 2).tolist():
            line = xy[begins[k] : begins[k] + sizes[k]]
            far = len(line) - 1
            if (line[0] == line[-1]).all():
                far = int(((line - line[0]) ** 2).sum(1).argmax())
            keep[begins[k] : begins[k] + sizes[k]] = False
            for a, b in ((0, far), (far, len(line) - 1)):
                keep[begins[k] + a + np.asarray(kept_points(line[a : b + 1], tolerance))] = True
        return _lists(xy[keep], np.add.reduceat(keep.astype(int), begins) if len(begins) else sizes)

    return run(points)


def shared_outlines(px: DataFrame, keys: list[str], tolerance_px: float = 0.0) -> DataFrame:
    """keys, region and rings (the outer one first, then holes; points (x, y) in pixels, the first one repeated at the end) of
    each region of px(keys, r, c, region). tolerance_px: how far a left-out point may lie from the line; nodes stay.

    A tile's arcs stay together: pixels are dealt by keys once, arcs once more, and nothing is written in between."""
    arcs = together(traced(arms(sides(px, keys), keys, by_other=True), keys), keys)
    # a place on the grid lies in one arc of two regions: one of them has it simplified, for the other one it runs backwards
    own = F.col("other").isNull() | (F.col("region") < F.col("other"))
    pairs = arcs.groupBy(*keys, "place").agg(F.first(F.when(own, F.col("line")), ignorenulls=True).alias("line"), F.collect_list(F.struct(own.alias("own"), "region", "ring", "arc")).alias("of"))
    lines = pairs.withColumn("line", _simplified(F.col("line"), tolerance_px)).select(*keys, "line", F.inline("of"))
    run = F.when(F.col("own"), F.col("line")).otherwise(F.reverse("line"))
    rings = lines.select(*keys, "region", "ring", "arc", run.alias("line")).groupBy(*keys, "region", "ring").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("arc", "line"))), lambda s: F.slice(s["line"], F.lit(1), F.size(s["line"]) - 1))).alias("ring_points"))
    closed = rings.select(*keys, "region", F.concat("ring_points", F.array(F.element_at("ring_points", 1))).alias("ring"))
    # y grows downwards: the region lies on the left as seen with y up
    cross = F.aggregate(F.zip_with(F.slice("ring", F.lit(1), F.size("ring") - 1), F.slice("ring", F.lit(2), F.size("ring") - 1), lambda a, b: a["y"] * b["x"] - a["x"] * b["y"]), F.lit(0.0), lambda s, v: s + v)
    found = closed.withColumn("area", cross / 2).groupBy(*keys, "region").agg(F.sort_array(F.collect_list(F.struct((-F.col("area")).alias("order"), "ring"))).alias("rings"))
    return found.select(*keys, "region", F.transform("rings", lambda r: r["ring"]).alias("rings"), F.aggregate("rings", F.lit(0.0), lambda s, r: s - r["order"]).alias("area_px"))
