"""Queries of files, capabilities, labels, tiles in bulk and prediction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.classes import CLASSES, TO_SUPERCLASS, lookup
from ..functions.labels import closest
from ..operators import inference
from ..sources import files
from ..sources.fixtures import PX_SQL, pixels
from .registry import query

CAPABILITIES = """<Capabilities xmlns="urn:wmts" xmlns:ows="urn:ows"><Contents>
<Layer><ows:Identifier>ortho</ows:Identifier><Format>image/png</Format><TileMatrixSetLink><TileMatrixSet>m</TileMatrixSet></TileMatrixSetLink></Layer>
<Layer><ows:Identifier>relief</ows:Identifier><Format>image/jpeg</Format></Layer>
<TileMatrixSet><ows:Identifier>m</ows:Identifier>
<TileMatrix><ows:Identifier>0</ows:Identifier><ScaleDenominator>14285714.3</ScaleDenominator><TopLeftCorner>2420000 1350000</TopLeftCorner><TileWidth>256</TileWidth><TileHeight>256</TileHeight><MatrixWidth>1</MatrixWidth><MatrixHeight>1</MatrixHeight></TileMatrix>
<TileMatrix><ows:Identifier>1</ows:Identifier><ScaleDenominator>7142857.1</ScaleDenominator><TopLeftCorner>2420000 1350000</TopLeftCorner><TileWidth>256</TileWidth><TileHeight>256</TileHeight><MatrixWidth>2</MatrixWidth><MatrixHeight>2</MatrixHeight></TileMatrix>
</TileMatrixSet></Contents></Capabilities>"""


@query("sc1_sc2_file_listing")
def file_listing(spark, d):
    return files.raster_files(spark, d, recursive=True, glob="*.parquet", content=False).select("relative", "length")


LEAVES = [
    ("/Capabilities", "Capabilities", None), ("/Capabilities/Contents", "Contents", None),
    ("/Capabilities/Contents/Layer", "Layer", None), ("/Capabilities/Contents/Layer/Identifier", "Identifier", "ortho"), ("/Capabilities/Contents/Layer/Format", "Format", "image/png"),
    ("/Capabilities/Contents/Layer/TileMatrixSetLink", "TileMatrixSetLink", None), ("/Capabilities/Contents/Layer/TileMatrixSetLink/TileMatrixSet", "TileMatrixSet", "m"),
    ("/Capabilities/Contents/Layer", "Layer", None), ("/Capabilities/Contents/Layer/Identifier", "Identifier", "relief"), ("/Capabilities/Contents/Layer/Format", "Format", "image/jpeg"),
    ("/Capabilities/Contents/TileMatrixSet", "TileMatrixSet", None), ("/Capabilities/Contents/TileMatrixSet/Identifier", "Identifier", "m"),
    *((f"/Capabilities/Contents/TileMatrixSet/TileMatrix{'/' * bool(t)}{t}", t or "TileMatrix", v) for k, scale in ((0, "14285714.3"), (1, "7142857.1")) for t, v in (("", None), ("Identifier", str(k)), ("ScaleDenominator", scale), ("TopLeftCorner", "2420000 1350000"), ("TileWidth", "256"), ("TileHeight", "256"), ("MatrixWidth", str(k + 1)), ("MatrixHeight", str(k + 1)))),
]


def _values(rows: list[tuple]) -> str:
    said = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return "VALUES " + ", ".join(f"({', '.join(map(said, r))})" for r in rows)


@query("sc13_capabilities", f"SELECT CAST(place AS INT) AS place, path, tag, CAST(value AS VARCHAR) AS value FROM ({_values([(k, *x) for k, x in enumerate(LEAVES)])}) t(place, path, tag, value)")
def capability_elements(spark, d):
    return files.capabilities(spark, CAPABILITIES).select("place", "path", "tag", "value")


@query("sc14_layer", "SELECT * FROM (VALUES ('Identifier', 'ortho'), ('Format', 'image/png'), ('TileMatrixSetLink', NULL)) t(tag, value)")
def layer_fields(spark, d):
    return files.layer(files.capabilities(spark, CAPABILITIES), "ortho").select("tag", "value")


@query("sc15_tile_matrices", "SELECT identifier, CAST(scale AS DOUBLE) AS scale, 2420000.0::DOUBLE AS \"left\", 1350000.0::DOUBLE AS top, 256 AS tile_width, 256 AS tile_height, n AS width, n AS height FROM (VALUES ('0', 14285714.3, 1), ('1', 7142857.1, 2)) t(identifier, scale, n)")
def matrices(spark, d):
    return files.tile_matrices(files.capabilities(spark, CAPABILITIES), "m")


@query("pr17_fuzzy_labels")
def fuzzy_labels(spark, d):
    named = pixels(spark, d).select(lookup(F.col("y1"), dict(enumerate(CLASSES))).alias("name")).distinct()
    return named.select("name", closest(F.regexp_replace("name", "e", ""), CLASSES).alias("found"))


def coded(spark, d):
    return files.encode_tiles(pixels(spark, d), "pred", 32)


SUPER = "CASE pred " + " ".join(f"WHEN {k} THEN {v}" for k, v in TO_SUPERCLASS.items()) + " ELSE 0 END"
#: All pixels of all tiles; missing ones are 0.
FULL = f"WITH {PX_SQL}, a AS (SELECT tile_id, CAST(i // 32 AS INT) AS r, CAST(i % 32 AS INT) AS c FROM (SELECT DISTINCT tile_id FROM px), range(1024) t(i)), x AS (SELECT tile_id, r, c, coalesce(pred, 0) AS pred FROM a LEFT JOIN px USING (tile_id, r, c))"


@query("sk1_tile_round_trip", FULL + " SELECT tile_id, r, c, pred FROM x")
def round_trip(spark, d):
    return files.decode_tiles(coded(spark, d), "pred")


@query("pr1_bulk_reclassify", FULL + f" SELECT tile_id, CAST({SUPER} AS INT) AS cls, count(*) AS n FROM x GROUP BY ALL")
def bulk_reclassify(spark, d):
    return files.decode_tiles(files.reclassify_tiles(coded(spark, d), TO_SUPERCLASS), "cls").groupBy("tile_id", "cls").agg(F.count("*").alias("n"))


def _arithmetic(image: np.ndarray) -> np.ndarray:
    """A model of three lines, for tests: the score of class k falls with its distance from the mean of the bands."""
    return -np.abs(image.mean(0)[None] - np.arange(18)[:, None, None])


@query("ml1_inference")
def inferred(spark, d):
    t = coded(spark, d).withColumn("data", F.concat("data", "data", "data"))
    out = inference.infer(t, _arithmetic, crop=16, stride=10)
    return out.select("tile_id", "height", F.xxhash64("cls").alias("cls_hash"), F.length("margin").alias("margin_bytes"))
