"""Regions of equal class in a tile or mosaic: labels, outlines, neighbours, rectangles, and correction of artefacts.

A region's label is its smallest row * width + column, so labels don't depend on the order of work. Kernels see one
mosaic (at most some million pixels) and run under grouped Arrow functions; all else stays in expressions.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classes import SOIL, TO_SUPERCLASS


def label4(cls: np.ndarray) -> np.ndarray:
    """Labels of the 4-connected regions of equal values: union of the runs of neighbouring rows."""
    h, w = cls.shape
    flat = cls.ravel()
    new = np.ones(h * w, bool)
    new[1:] = flat[1:] != flat[:-1]
    new[::w] = True
    start = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    upper, lower = run[: (h - 1) * w], run[w:]
    pairs = np.unique(np.stack([upper, lower], 1)[flat[: (h - 1) * w] == flat[w:]], axis=0)
    root = np.arange(len(start))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    for a in range(len(root)):
        root[a] = root[root[a]]
    return start[root][run].reshape(h, w)


def dense(pdf: pd.DataFrame, value: str, empty: int = -1) -> np.ndarray:
    out = np.full((int(pdf.r.max()) + 1, int(pdf.c.max()) + 1), empty, np.int64)
    out[pdf.r, pdf.c] = pdf[value].fillna(empty)
    return out


def polygonize(px: DataFrame, value: str, key: str = "tile_id") -> DataFrame:
    """px(key, r, c, value, ...) with the column region: the label of each pixel's region in its tile."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # labels count the widest tile's columns, so that a cut-off tile has the same labels
        width = int(pdf.c.max()) + 1
        labels = label4(dense(pdf, value))[pdf.r, pdf.c]
        return pdf.assign(region=(labels // width * 65536 + labels % width).astype("int64"))

    return px.groupBy(key).applyInPandas(run, px.withColumn("region", F.lit(0).cast("long")).schema)


def shared_edges(px: DataFrame, region: str = "region", key: str = "tile_id") -> DataFrame:
    """key, region, neighbour, shared_px: pixel edges that two regions share, both ways; corners don't count."""
    at = px.select(key, "r", "c", region)
    steps = at.withColumn("d", F.explode(F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in ((0, 1), (1, 0))]))).select(key, (F.col("r") + F.col("d.dr")).alias("r"), (F.col("c") + F.col("d.dc")).alias("c"), F.col(region).alias("a"))
    pairs = steps.join(at, [key, "r", "c"]).where(F.col("a") != F.col(region)).select(key, "a", F.col(region).alias("b"))
    both = pairs.unionByName(pairs.select(key, F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy(key, F.col("a").alias("region"), F.col("b").alias("neighbour")).agg(F.count("*").alias("shared_px"))


# outlines: pixel corners (x to the right, y down), the region always on the left hand as seen with y up

_STEPS = ((1, 0), (0, 1), (-1, 0), (0, -1))  # right, down, left, up on the screen


def outline(mask: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The outer ring of a 4-connected region as unit edges (x, y, dx, dy), counter-clockwise as seen with y up, from
    the upper left corner of its first pixel downwards."""
    width = mask.shape[1] + 2
    m = np.pad(mask, 1).astype(np.uint8).tobytes()
    # of a corner, by direction: the next corner, and the pixels on the left (y up) and on the right of the edge to it
    move, left, right = (1, width, -1, -width), (-width, 0, -1, -width - 1), (0, -1, -width - 1, -width)
    start = at = m.index(1)
    d, out = 1, []
    while True:
        y, x = divmod(at, width)
        out.append((x - 1, y - 1, *_STEPS[d]))
        at += move[d]
        if at == start:
            return out
        for turn in (3, 0, 1):  # to the left first: diagonal pixels aren't connected
            nd = (d + turn) % 4
            if m[at + left[nd]] and not m[at + right[nd]]:
                d = nd
                break


def corners(edges: list[tuple[int, int, int, int]], closed: bool = True) -> list[tuple[int, int, bool]]:
    """(arm before, arm after, convex) of each corner of a chain of unit edges, in pixels."""
    if not edges:
        return []
    turn = [k for k in range(len(edges)) if edges[k][2:] != edges[k - 1][2:] and (k or closed)]
    if not turn:
        return []
    ends = [*turn[1:], turn[0] + len(edges)] if closed else [*turn[1:], len(edges)]
    arms = [b - a for a, b in zip(turn, ends, strict=True)]
    before = [arms[k - 1] if k or closed else turn[0] for k in range(len(turn))]
    out = []
    for k, a, b in zip(turn, before, arms, strict=True):
        (ux, uy), (vx, vy) = edges[k - 1][2:], edges[k][2:]
        out.append((a, b, ux * -vy - -uy * vx > 0))
    return out


def right_angles(mask: np.ndarray, edge_m: float, least_product: float = 50) -> tuple[int, int, int]:
    """Right angles of the outline, those whose arms' product exceeds least_product m2, and the convex ones of these."""
    found = corners(outline(mask))
    large = [convex for a, b, convex in found if a * b * edge_m * edge_m > least_product]
    return len(found), len(large), sum(large)


#: By direction, where the pixel on an edge's right lies from the corner that the edge begins at, as (row, column).
_RIGHT = {(1, 0): (0, 0), (0, 1): (0, -1), (-1, 0): (-1, -1), (0, -1): (-1, 0)}


def right_labels(edges: list[tuple[int, int, int, int]], around: np.ndarray) -> list[int]:
    """The label on the right of each edge; around: labels, padded by one."""
    at = np.asarray([(y + _RIGHT[dx, dy][0] + 1, x + _RIGHT[dx, dy][1] + 1) for x, y, dx, dy in edges])
    return around[at[:, 0], at[:, 1]].tolist()


def shared_right_angles(edges: list, right: list[bool], edge_m: float, least_product: float = 50) -> tuple[int, int]:
    """Along the outline where a neighbour lies on its right: convex corners with large arms, and the length in pixels.
    Arms end with the shared stretch; a ring that is shared as a whole is closed."""
    n = sum(right)
    if n == len(edges):
        chains, closed = [edges], True
    else:
        closed, chains = False, []
        first = right.index(False)
        for k in range(first, first + len(edges)):
            k %= len(edges)
            if right[k]:
                if not right[k - 1]:
                    chains.append([])
                chains[-1].append(edges[k])
    hits = sum(a * b * edge_m * edge_m > least_product and convex for chain in chains for a, b, convex in corners(chain, closed))
    return hits, n


def perimeter(labels: np.ndarray) -> dict[int, int]:
    """Pixel edges around each label, holes included."""
    p = np.pad(labels, 1, constant_values=-1)
    own = p[1:-1, 1:-1]
    n = sum((own != p[a : a + own.shape[0], b : b + own.shape[1]]).astype(np.int64) for a, b in ((0, 1), (2, 1), (1, 0), (1, 2)))
    return dict(zip(*(x.tolist() for x in _sums(own, n)), strict=True))


def _sums(labels: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, inverse = np.unique(labels, return_inverse=True)
    return ids, np.bincount(inverse.ravel(), values.ravel()).astype(np.int64)


def _boxes(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels in order, (first row, last row, first column, last column) of each, and pixels of each."""
    ids, at, n = np.unique(labels, return_inverse=True, return_counts=True)
    at = at.ravel()
    rows, columns = np.divmod(np.arange(labels.size), labels.shape[1])
    order = np.argsort(at, kind="stable")
    begin = np.cumsum(n) - n
    rows, columns = rows[order], columns[order]
    return ids, np.stack([np.minimum.reduceat(rows, begin), np.maximum.reduceat(rows, begin), np.minimum.reduceat(columns, begin), np.maximum.reduceat(columns, begin)], 1), n


def correct_array(cls: np.ndarray, edge_m: float = 0.1, most_perimeter: float = 400, least_fill: float = 0.4, least_product: float = 50, within: tuple[int, int, int, int] | None = None) -> np.ndarray:
    """Regions that look like cut-out squares take the class of the neighbour that they were cut from.

    A candidate has 1 to 4 large convex right angles, less than most_perimeter m of boundary and more than least_fill of
    its bounding box. The winner has the most right angles on the shared boundary (at least one), then the longest
    shared boundary, then the smallest label. All decisions read the classes as they were. within (first row, row after the
    last, and columns likewise): only regions that have to do with this box are looked at, the result holds inside it."""
    labels, out = label4(cls), cls.copy()
    ids, boxes, n_px = _boxes(labels)
    rounds = perimeter(labels)
    heights, widths = boxes[:, 1] - boxes[:, 0] + 1, boxes[:, 3] - boxes[:, 2] + 1
    # arms are no longer than the box's sides, so smaller boxes have no large right angle
    likely = (heights * widths * edge_m * edge_m > least_product) & (n_px / (heights * widths) > least_fill) & (cls.ravel()[ids] >= 0)
    likely &= np.asarray([rounds[i] for i in ids.tolist()]) * edge_m < most_perimeter
    if within:
        likely &= np.isin(ids, labels[within[0] : within[1], within[2] : within[3]])
    padded = np.pad(labels, 1, constant_values=-1)
    for k in np.flatnonzero(likely).tolist():
        i, (y0, y1, x0, x1) = int(ids[k]), boxes[k].tolist()
        mask = labels[y0 : y1 + 1, x0 : x1 + 1] == i
        edges = outline(mask)
        large = sum(convex for a, b, convex in corners(edges) if a * b * edge_m * edge_m > least_product)
        if not 0 < large < 5:
            continue
        right = right_labels(edges, padded[y0 : y1 + 3, x0 : x1 + 3])
        best = None
        for j in sorted(set(right)):
            if j == -1 or cls.flat[j] < 0:
                continue
            angles, shared = shared_right_angles(edges, [r == j for r in right], edge_m, least_product)
            if angles and (best is None or (angles, shared) > best[0]):
                best = ((angles, shared), j)
        if best:
            out[y0 : y1 + 1, x0 : x1 + 1][mask] = cls.flat[best[1]]
    return out


def correct_artefacts(px: DataFrame, value: str, edge_dm: str | None = None, key: str = "tile_id") -> DataFrame:
    """px with the column `corrected`; each tile is corrected by itself. edge_dm: a column with a pixel's edge in dm."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        edge = float(pdf[edge_dm].iloc[0]) / 10 if edge_dm else 0.1
        return pdf.assign(corrected=correct_array(dense(pdf, value), edge)[pdf.r, pdf.c].astype("int32"))

    return px.groupBy(key).applyInPandas(run, px.withColumn("corrected", F.lit(0)).schema)


def _processed(mosaic: np.ndarray, mode: str, edge: int, edge_m: float, to: np.ndarray) -> np.ndarray:
    """The middle of a mosaic of 3 x 3 tiles, corrected. to: superclasses by class + 1."""
    middle = (edge, 2 * edge, edge, 2 * edge)
    if mode in ("mc", "combined"):
        # what the superclasses' regions look like depends on corrections all over the mosaic
        mosaic = correct_array(mosaic, edge_m, within=middle if mode == "mc" else None)
    if mode in ("soil", "combined"):
        mosaic = correct_array(to[mosaic + 1], edge_m, within=middle)
    return mosaic[edge : 2 * edge, edge : 2 * edge]


def _table(superclass: dict[int, int] | None) -> np.ndarray:
    table = superclass or TO_SUPERCLASS
    out = np.full(max(table) + 2, -1, np.int64)
    for k, v in table.items():
        out[k + 1] = v
    return out


def post_process(halo: DataFrame, mode: str = "mc", edge: int = 32, edge_m: float = 0.1, superclass: dict[int, int] | None = None) -> DataFrame:
    """Correction of tiles within their ring of neighbours. halo(tile_id, dr, dc, r, c, cls): each tile's own pixels (dr
    and dc 0) and its neighbours' (-1, 0 or 1). mode: mc on the classes; soil on the superclasses; combined: on the
    classes, then on their superclasses. Returns tile_id, r, c, cls of the tiles themselves; missing neighbours are no data.
    For small inputs: bulk work is done by post_process_tiles."""
    to = _table(superclass)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        mosaic = np.full((3 * edge, 3 * edge), -1, np.int64)
        mosaic[(pdf.dr + 1) * edge + pdf.r, (pdf.dc + 1) * edge + pdf.c] = pdf.cls
        own = pdf[(pdf.dr == 0) & (pdf.dc == 0)]
        return pd.DataFrame({"tile_id": own.tile_id, "r": own.r, "c": own.c, "cls": _processed(mosaic, mode, edge, edge_m, to)[own.r, own.c].astype("int32")})

    return halo.groupBy("tile_id").applyInPandas(run, "tile_id long, r int, c int, cls int")


def post_process_tiles(tiles: DataFrame, halo: DataFrame, mode: str = "mc", edge: int = 32, edge_m: float = 0.1, superclass: dict[int, int] | None = None, empty: int = 255) -> DataFrame:
    """post_process() in bulk: tiles(tile_id, data) have a row each, of edge x edge unsigned bytes (empty: no data), and
    halo(tile_id, dr, dc, neighbour_id) says which tiles are where. Nine rows meet for a tile, whatever its pixels are."""
    to = _table(superclass)
    parts = halo.join(tiles.withColumnRenamed("tile_id", "neighbour_id"), "neighbour_id").select("tile_id", "dr", "dc", "data")

    def run(table: pa.Table) -> pa.Table:
        mosaic = np.full((3 * edge, 3 * edge), -1, np.int64)
        own = None
        for dr, dc, data in zip(*(table[k].to_pylist() for k in ("dr", "dc", "data")), strict=True):
            part = np.frombuffer(data, np.uint8).reshape(edge, edge).astype(np.int64)
            part[part == empty] = -1
            mosaic[(dr + 1) * edge : (dr + 2) * edge, (dc + 1) * edge : (dc + 2) * edge] = part
            own = part if (dr, dc) == (0, 0) else own
        made = _processed(mosaic, mode, edge, edge_m, to)
        r, c = np.nonzero(own >= 0) if own is not None else (np.zeros(0, np.int64),) * 2
        ids = np.full(len(r), table["tile_id"][0].as_py(), np.int64)
        return pa.table({"tile_id": pa.array(ids), "r": pa.array(r, pa.int32()), "c": pa.array(c, pa.int32()), "cls": pa.array(made[r, c], pa.int32())})

    return parts.groupBy("tile_id").applyInArrow(run, "tile_id long, r int, c int, cls int")


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull of whole-numbered points, counter-clockwise."""
    pts = np.unique(points, axis=0).tolist()

    def half(rows):
        out = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.asarray(half(pts) + half(pts[::-1]) if len(pts) > 2 else pts, float)


def rotated_rectangle(points: np.ndarray) -> tuple[float, float]:
    """Long and short edge of the smallest rectangle around the points, in any rotation; it shares a side of the hull. Of
    equally small ones the one with the shortest edge."""
    h = hull(points)
    side = np.roll(h, -1, axis=0) - h
    u = side / np.linalg.norm(side, axis=1, keepdims=True)
    along, across = h @ u.T, h @ np.stack([-u[:, 1], u[:, 0]])
    a, b = np.ptp(along, axis=0), np.ptp(across, axis=0)
    area = np.round(a * b, 9)
    short = np.where(area == area.min(), np.minimum(a, b), np.inf).min()
    return float(area.min() / short), float(short)


#: A convex chain over points in order: of the chain so far, whatever doesn't turn left towards the next point goes; that is
#: an end of it, as the chain turns left everywhere.
_CHAIN = "aggregate({0}, CAST(array() AS array<struct<x: bigint, y: bigint>>), (h, p) -> concat(filter(h, (q, i) -> i = 0 OR (q.x - get(h, i - 1).x) * (p.y - get(h, i - 1).y) - (q.y - get(h, i - 1).y) * (p.x - get(h, i - 1).x) > 0), array(p)))"
#: Twice the extent along and across each side of the hull; the smallest rectangle lies along one of them.
_RECTANGLES = """transform(transform(hull, (p, i) -> struct(get(hull, (i + 1) % size(hull)).x - p.x AS dx, get(hull, (i + 1) % size(hull)).y - p.y AS dy)), s -> struct(
    array_max(transform(hull, p -> p.x * s.dx + p.y * s.dy)) - array_min(transform(hull, p -> p.x * s.dx + p.y * s.dy)) AS a,
    array_max(transform(hull, p -> p.x * s.dy - p.y * s.dx)) - array_min(transform(hull, p -> p.x * s.dy - p.y * s.dx)) AS b, CAST(s.dx * s.dx + s.dy * s.dy AS DOUBLE) AS u))"""


def rectangles(px: DataFrame, keys: list[str], edge_dm: str = "px_dm") -> DataFrame:
    """keys, long_axis, short_axis (m), axis_ratio, rectangularity of each region by its smallest rotated rectangle; of equally
    small ones the one with the shortest edge.

    Only the ends of each row's pixels can be on the hull. A region's row ends are one array, and hull and rectangles are
    array expressions on it, so regions need no group of their own."""
    ends = px.groupBy(*keys, "r").agg(F.min("c").cast("long").alias("c0"), (F.max("c") + 1).cast("long").alias("c1"), F.count("*").alias("n"), F.max(edge_dm).alias("edge"))
    rows = ends.groupBy(*keys).agg(F.collect_list(F.struct(F.col("r").cast("long").alias("r"), "c0", "c1")).alias("ends"), F.sum("n").alias("n"), (F.max("edge") / 10.0).alias("edge"))
    points = rows.withColumn("points", F.expr("array_sort(array_distinct(flatten(transform(ends, e -> array(named_struct('x', e.c0, 'y', e.r), named_struct('x', e.c0, 'y', e.r + 1), named_struct('x', e.c1, 'y', e.r), named_struct('x', e.c1, 'y', e.r + 1))))))"))
    chains = points.select(*keys, "n", "edge", F.expr(_CHAIN.format("points")).alias("low"), F.expr(_CHAIN.format("reverse(points)")).alias("high"))
    hulls = chains.select(*keys, "n", "edge", F.expr("concat(slice(low, 1, size(low) - 1), slice(high, 1, size(high) - 1))").alias("hull"))
    found = hulls.select(*keys, "n", "edge", F.expr(_RECTANGLES).alias("boxes"))
    best = found.select(*keys, "n", "edge", F.expr("array_min(transform(boxes, b -> struct(round(b.a * b.b / b.u, 9) AS area, least(b.a, b.b) / sqrt(b.u) AS short)))").alias("best"))
    area, short = F.col("best.area"), F.col("best.short")
    long = area / short
    return best.select(*keys, (long * F.col("edge")).alias("long_axis"), F.round(short * F.col("edge"), 9).alias("short_axis"), F.round(short / long, 9).alias("axis_ratio"), F.round(F.col("n") / (long * short), 9).alias("rectangularity"))


def merge_small(px: DataFrame, value: str, least: float, key: str = "tile_id", edge_dm: str | None = None) -> DataFrame:
    """px with the column merged: regions of fewer than `least` pixels, or with edge_dm (a column with a pixel's edge in dm)
    m2, take the class of the neighbour with the longest shared boundary (then the smallest label), all at once."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cls = dense(pdf, value)
        labels = label4(cls)
        ids, n = np.unique(labels, return_counts=True)
        size = n * int(pdf[edge_dm].max()) ** 2 / 100 if edge_dm else n
        small = set(ids[size < least].tolist())
        shared: dict[tuple[int, int], int] = defaultdict(int)
        for a, b in ((labels[1:], labels[:-1]), (labels[:, 1:], labels[:, :-1])):
            for x, y in zip(a[a != b].tolist(), b[a != b].tolist(), strict=True):
                shared[x, y] += 1
                shared[y, x] += 1
        best: dict[int, tuple[int, int]] = {}
        for (x, y), k in shared.items():
            if x in small and cls.flat[y] >= 0 and (k, -y) > best.get(x, (0, 0)):
                best[x] = (k, -y)
        out = cls.copy()
        for x, (_, y) in best.items():
            out[labels == x] = cls.flat[-y]
        return pdf.assign(merged=out[pdf.r, pdf.c].astype("int32"))

    return px.groupBy(key).applyInPandas(run, px.withColumn("merged", F.lit(0)).schema)


def kept_points(p: np.ndarray, tolerance: float) -> list[int]:
    """Douglas-Peucker: which of the points stay, none of the others being farther than tolerance from the line."""
    keep, todo = {0, len(p) - 1}, [(0, len(p) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d, v = p[b] - p[a], p[a + 1 : b] - p[a]
        length = np.hypot(*d)
        off = np.abs(d[0] * v[:, 1] - d[1] * v[:, 0]) / length if length else np.hypot(*v.T)
        k = a + 1 + int(off.argmax())
        if off.max() > tolerance:
            keep.add(k)
            todo += [(a, k), (k, b)]
    return sorted(keep)


def simplify(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """The points that kept_points() keeps."""
    return points if len(points) < 3 else [points[k] for k in kept_points(np.asarray(points, float), tolerance)]


def _ring(r: np.ndarray, c: np.ndarray, tolerance_px: float) -> tuple[int, np.ndarray]:
    """How many corners the outer ring of these pixels has, and its simplified points."""
    r0, c0 = int(r.min()), int(c.min())
    mask = np.zeros((int(r.max()) - r0 + 1, int(c.max()) - c0 + 1), bool)
    mask[r - r0, c - c0] = True
    edges = outline(mask)
    ring = [(x + c0, y + r0) for k, (x, y, dx, dy) in enumerate(edges) if (dx, dy) != edges[k - 1][2:]]
    far = max(range(len(ring)), key=lambda k: (ring[k][0] - ring[0][0]) ** 2 + (ring[k][1] - ring[0][1]) ** 2)
    points = np.asarray([*ring, ring[0]], float)
    return len(ring), points[kept_points(points[: far + 1], tolerance_px)[:-1] + [far + k for k in kept_points(points[far:], tolerance_px)]]


def outlines(px: DataFrame, keys: list[str], tolerance_px: float = 0.0) -> DataFrame:
    """keys, corners (of the outer ring as traced) and ring: its points (x, y) in pixels, simplified, the first one repeated
    at the end. A ring is cut at its first corner and at the one farthest from it, and both halves are simplified.

    A region's pixels are a list, and Python sees batches of regions: one is too small for a group of its own."""

    @F.arrow_udf("corners int, ring array<struct<x: double, y: double>>")
    def run(regions: pa.Array) -> pa.Array:
        sizes, at = pc.list_value_length(regions).to_numpy(), regions.flatten().to_numpy()
        ends = np.cumsum(sizes)
        made = [_ring(at[a:b] >> 32, at[a:b] & 0xFFFFFFFF, tolerance_px) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
        xy = np.concatenate([np.zeros((0, 2)), *(ring for _, ring in made)])
        fields = [pa.field("x", pa.float64()), pa.field("y", pa.float64())]
        points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=fields)
        rings = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(ring) for _, ring in made)]), pa.int32()), points)
        return pa.StructArray.from_arrays([pa.array([n for n, _ in made], pa.int32()), rings], ["corners", "ring"])

    place = F.shiftleft(F.col("r").cast("long"), 32) + F.col("c")
    return px.select(*keys, place.alias("_at")).groupBy(*keys).agg(F.collect_list("_at").alias("_at")).select(*keys, run("_at").alias("_o")).select(*keys, "_o.corners", "_o.ring")


def soil_mask(px: DataFrame, value: str) -> DataFrame:
    return px.withColumn("soil", F.col(value).isin(SOIL))
