"""Vector tables: polygons as well-known binary in Parquet with their boxes, or as GeoJSON lines.

A polygon is a column of rings, each an array of points (x, y) with the first one repeated at its end; a geometry of several
parts is an array of polygons, and is read as a row for each part. Boxes are written beside the geometry, so a reader's box
filter reaches the Parquet scan and geometries outside of it are never decoded.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RINGS = "array<array<struct<x: double, y: double>>>"
PARTS = f"array<{RINGS}>"
POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
BOX = ("min_x", "min_y", "max_x", "max_y")


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The rings of a box, counter-clockwise."""
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0)))


def area(rings: Column) -> Column:
    """Area of a polygon: the first ring's, less the others'."""
    cross = lambda ring: F.aggregate(F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]), F.lit(0.0), lambda s, v: s + v)
    each = F.transform(rings, lambda ring: F.abs(cross(ring)) / 2)
    return 2 * F.element_at(each, 1) - F.aggregate(each, F.lit(0.0), lambda s, v: s + v)


def with_box(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """df with the box of each geometry's outer rings."""
    outer = F.element_at(F.col(geometry), 1) if _is_single(df, geometry) else F.flatten(F.transform(F.filter(F.col(geometry), lambda p: F.size(p) > 0), lambda p: p[0]))
    x, y = F.transform(outer, lambda p: p["x"]), F.transform(outer, lambda p: p["y"])
    return df.withColumns({"min_x": F.array_min(x), "min_y": F.array_min(y), "max_x": F.array_max(x), "max_y": F.array_max(y)})


def _is_single(df: DataFrame, geometry: str) -> bool:
    return df.schema[geometry].dataType.simpleString() == RINGS.replace(" ", "")


def _coordinates(points: pa.Array) -> np.ndarray:
    """A row of x and y for each point of a flat array."""
    return np.stack([np.asarray(points.field(k), "<f8") for k in (0, 1)], 1) if len(points) else np.zeros((0, 2), "<f8")


def _polygon(xy: np.ndarray, ends: np.ndarray, first: int, last: int) -> bytes:
    """The rings from first up to last, of which ring k's points end at ends[k + 1]."""
    out = [struct.pack("<BII", 1, 3, last - first)]
    for k in range(first, last):
        out += [struct.pack("<I", ends[k + 1] - ends[k]), xy[ends[k] : ends[k + 1]].tobytes()]
    return b"".join(out)


def to_wkb(geometry: Column, single: bool = True) -> Column:
    """Well-known binary of a polygon, or of several parts (of one part: a polygon). Points are copied as blocks."""

    @F.arrow_udf("binary")
    def run(values: pa.Array) -> pa.Array:
        parts = values if single else pa.compute.list_flatten(values)
        rings = pa.compute.list_flatten(parts)
        xy = _coordinates(pa.compute.list_flatten(rings))
        of = lambda lists: np.concatenate([[0], np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)))]).astype(int)
        ends, last = of(rings), of(parts)
        made = [_polygon(xy, ends, a, b) for a, b in zip(last, last[1:], strict=False)]
        if not single:
            each = of(values)
            made = [made[a] if b == a + 1 else struct.pack("<BII", 1, 6, b - a) + b"".join(made[a:b]) for a, b in zip(each, each[1:], strict=False)]
        return pa.array([m if v else None for m, v in zip(made, values.is_valid().to_pylist(), strict=True)], pa.binary())

    return run(geometry)


def _decoded(data: bytes, xy: list, ring_sizes: list, part_sizes: list) -> int:
    """Appends points, rings' and parts' sizes of one geometry; the number of its parts."""

    def polygon(at: int) -> int:
        order = "<" if data[at] == 1 else ">"
        kind, n = struct.unpack_from(f"{order}II", data, at + 1)
        if kind != 3:
            raise ValueError(f"neither a polygon nor several: kind {kind}")
        at += 9
        for _ in range(n):
            (points,) = struct.unpack_from(f"{order}I", data, at)
            xy.append(np.frombuffer(data, f"{order}f8", 2 * points, at + 4).astype("<f8"))
            ring_sizes.append(points)
            at += 4 + 16 * points
        part_sizes.append(n)
        return at

    order = "<" if data[0] == 1 else ">"
    kind, n = struct.unpack_from(f"{order}II", data, 1)
    if kind != 6:
        polygon(0)
        return 1
    at = 9
    for _ in range(n):
        at = polygon(at)
    return n


def _lists(sizes: list, values: pa.Array, valid: list | None = None) -> pa.Array:
    offsets = np.cumsum([0, *sizes]).astype(np.int32)
    mask = None if valid is None else pa.array([not v for v in valid])
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)


def parts_from_wkb(data: Column) -> Column:
    """The parts of polygons and of geometries of several polygons, each a polygon's rings."""

    @F.arrow_udf(PARTS)
    def run(values: pa.Array) -> pa.Array:
        xy, ring_sizes, part_sizes, each = [], [], [], []
        rows = values.to_pylist()
        for v in rows:
            each.append(0 if v is None else _decoded(v, xy, ring_sizes, part_sizes))
        flat = np.concatenate(xy) if xy else np.zeros(0, "<f8")
        points = pa.StructArray.from_arrays([pa.array(flat[k::2]) for k in (0, 1)], fields=list(POINT))
        return _lists(each, _lists(part_sizes, _lists(ring_sizes, points)), [v is not None for v in rows])

    return run(data)


def from_wkb(data: Column) -> Column:
    """The rings of a polygon's well-known binary; of several parts those of the first."""
    return F.get(parts_from_wkb(data), F.lit(0))


def write_vectors(df: DataFrame, path: str, form: str = "wkb", geometry: str = "geometry", overwrite: bool = True) -> None:
    """df with its polygons as Parquet (wkb, with boxes) or as a folder of GeoJSON lines, one feature each."""
    mode = "overwrite" if overwrite else "error"
    single = _is_single(df, geometry)
    if form == "wkb":
        with_box(df, geometry).withColumn(geometry, to_wkb(F.col(geometry), single)).write.mode(mode).parquet(path)
    elif form == "geojson":
        of = lambda rings: F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
        points = of(F.col(geometry)) if single else F.transform(F.col(geometry), of)
        shape = F.when(F.col(geometry).isNotNull(), F.struct(F.lit("Polygon" if single else "MultiPolygon").alias("type"), points.alias("coordinates")))
        rest = F.struct(*(c for c in df.columns if c != geometry))
        df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), rest.alias("properties"), shape.alias("geometry"))).alias("value")).write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown form: {form}")


def read_vectors(spark: SparkSession, path: str, form: str = "wkb", properties: str | None = None, box: tuple[float, float, float, float] | None = None, geometry: str = "geometry") -> DataFrame:
    """What write_vectors wrote, with geometry as rings: a row for each part of a feature; box: only features whose box meets
    it. A feature without a geometry has a row without one. GeoJSON needs the properties' types as DDL, and files may be
    collections of one feature a line."""
    if form == "wkb":
        df = spark.read.parquet(path)
    elif form == "geojson":
        rows = spark.read.text(path).select(F.from_json("value", f"properties struct<{properties}>, geometry struct<type: string, coordinates: string>").alias("f"))
        kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
        # one polygon is several of one part
        several = F.from_json(F.when(kind == "Polygon", F.concat(F.lit("["), text, F.lit("]"))).when(kind == "MultiPolygon", text), "array<array<array<array<double>>>>")
        parts = F.transform(several, lambda rings: F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))))
        df = with_box(rows.select("f.properties.*", parts.alias(geometry)), geometry)
    else:
        raise ValueError(f"unknown form: {form}")
    if box:
        df = df.where((F.col("min_x") <= box[2]) & (F.col("max_x") >= box[0]) & (F.col("min_y") <= box[3]) & (F.col("max_y") >= box[1]))
    parts = parts_from_wkb(F.col(geometry)) if form == "wkb" else F.col(geometry)
    return df.drop(*BOX).withColumn(geometry, parts).withColumn(geometry, F.explode_outer(geometry))


def feature_collection(text: str) -> list[dict]:
    """Features of a small GeoJSON document as properties with rings: settings-like files such as an area of interest."""
    out = []
    for f in json.loads(text)["features"]:
        if f["geometry"]["type"] != "Polygon":
            raise ValueError(f"not a polygon: {f['geometry']['type']}")
        out.append({**f["properties"], "geometry": [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in f["geometry"]["coordinates"]]})
    return out
