"""Pixels, boxes, scores and logs derived from the star-schema tables, for queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of 32 x 32 pixels: classes at two dates, a noisy prediction, two confidences in thousandths."""
    px = table(spark, sf_dir, "orders").selectExpr("o_orderkey div 1024 AS tile_id", "CAST((o_orderkey % 1024) div 32 AS INT) AS r", "CAST(o_orderkey % 32 AS INT) AS c", "CAST(floor(o_totalprice) AS BIGINT) AS p")
    shaped = px.selectExpr("*", "CASE tile_id % 4 WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN 8 ELSE 16 END AS bh", "CASE tile_id % 4 WHEN 0 THEN 6 WHEN 1 THEN 16 WHEN 2 THEN 8 ELSE 1 END AS bw", "CASE tile_id % 3 WHEN 0 THEN 10 WHEN 1 THEN 1 ELSE 100 END AS px_dm")
    blocks = shaped.selectExpr("*", "CAST(7 * (r div bh) + 11 * (c div bw) + 13 * tile_id AS BIGINT) AS b")
    return blocks.selectExpr(
        "tile_id", "r", "c", "px_dm", "CAST(1 + b % 17 AS INT) AS y1",
        "CAST(CASE WHEN (b * 31 + 5) % 3 <> 0 THEN 1 + (b * 29 + 3) % 17 ELSE 1 + b % 17 END AS INT) AS y2",
        "CAST(CASE WHEN p % 5 = 0 THEN (b + p) % 18 ELSE 1 + b % 17 END AS INT) AS pred",
        "CAST(p % 1000 AS INT) AS conf1_milli", "CAST((p div 7) % 1000 AS INT) AS conf2_milli",
    )


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile_id, r, c, band 1 to 4, value."""
    return pixels(spark, sf_dir).selectExpr("tile_id", "r", "c", "posexplode(array(pred, y1, y2, conf1_milli)) AS (k, value)").selectExpr("tile_id", "r", "c", "k + 1 AS band", "value")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "CAST(p_partkey % 8 AS INT) AS grp", "CAST((p_partkey * 37) % 400 AS INT) AS x0", "CAST((p_partkey * 53) % 400 AS INT) AS y0",
        "CAST((p_partkey * 37) % 400 + 5 + p_size AS INT) AS x1", "CAST((p_partkey * 53) % 400 + 5 + (p_size * 3) % 40 AS INT) AS y1",
    )


def _notched(x0, y0, w, h):
    """A box with a notch down to its middle and a triangular hole below the notch."""
    point = lambda x, y: F.struct((x0 + w * x).cast("double").alias("x"), (y0 + h * y).cast("double").alias("y"))
    outer = F.array(*(point(x, y) for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.5, 0.5), (0.0, 1.0), (0.0, 0.0))))
    return F.array(outer, F.array(*(point(x, y) for x, y in ((0.25, 0.125), (0.5, 0.375), (0.75, 0.125), (0.25, 0.125)))))


def notched_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, grp, geometry: concave polygons with a hole, one in each box."""
    x0, y0, x1, y1 = (F.col(k) for k in ("x0", "y0", "x1", "y1"))
    return boxes(spark, sf_dir).select("id", "grp", _notched(x0, y0, x1 - x0, y1 - y0).alias("geometry"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone, geometry: such a polygon of 100 x 100 for each nation, side by side."""
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(k.cast("int").alias("zone"), _notched(k % 5 * 100, F.floor(k / 5) * 100, F.lit(100), F.lit(100)).alias("geometry"))


def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile_id with its global row and column, and region origin, row and column in regions of 2 x 2 tiles."""
    return pixels(spark, sf_dir).select("tile_id").distinct().selectExpr(
        "tile_id", "CAST(tile_id div 4 AS INT) AS grow", "CAST(tile_id % 4 AS INT) AS gcol",
        "CAST((tile_id div 4) div 2 AS INT) AS region_y", "CAST((tile_id % 4) div 2 AS INT) AS region_x", "CAST((tile_id div 4) % 2 AS INT) AS row", "CAST((tile_id % 4) % 2 AS INT) AS col",
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id and 18 class scores."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 18), lambda x: x.cast("double")).alias("logits"))


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id AS step", "CASE event_type WHEN 'view' THEN 'val' ELSE 'train' END AS mode", "value AS loss", "CAST(get_json_object(props, '$.k') AS INT) AS k", "ts")


# The same tables in DuckDB SQL, as common table expressions.
PX_SQL = """p0 AS (SELECT o_orderkey // 1024 AS tile_id, CAST((o_orderkey % 1024) // 32 AS INT) AS r, CAST(o_orderkey % 32 AS INT) AS c, CAST(floor(o_totalprice) AS BIGINT) AS p FROM orders),
p1 AS (SELECT *, CASE tile_id % 4 WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN 8 ELSE 16 END AS bh, CASE tile_id % 4 WHEN 0 THEN 6 WHEN 1 THEN 16 WHEN 2 THEN 8 ELSE 1 END AS bw, CASE tile_id % 3 WHEN 0 THEN 10 WHEN 1 THEN 1 ELSE 100 END AS px_dm FROM p0),
p2 AS (SELECT *, CAST(7 * (r // bh) + 11 * (c // bw) + 13 * tile_id AS BIGINT) AS b FROM p1),
px AS (SELECT tile_id, r, c, px_dm, CAST(1 + b % 17 AS INT) AS y1, CAST(CASE WHEN (b * 31 + 5) % 3 <> 0 THEN 1 + (b * 29 + 3) % 17 ELSE 1 + b % 17 END AS INT) AS y2,
 CAST(CASE WHEN p % 5 = 0 THEN (b + p) % 18 ELSE 1 + b % 17 END AS INT) AS pred, CAST(p % 1000 AS INT) AS conf1_milli, CAST((p // 7) % 1000 AS INT) AS conf2_milli FROM p2)"""
BANDS_SQL = PX_SQL + """,
bands AS (SELECT tile_id, r, c, 1 AS band, pred AS value FROM px UNION ALL SELECT tile_id, r, c, 2, y1 FROM px UNION ALL SELECT tile_id, r, c, 3, y2 FROM px UNION ALL SELECT tile_id, r, c, 4, conf1_milli FROM px)"""
BX_SQL = """bx AS (SELECT p_partkey AS id, CAST(p_partkey % 8 AS INT) AS grp, CAST((p_partkey * 37) % 400 AS INT) AS x0, CAST((p_partkey * 53) % 400 AS INT) AS y0,
 CAST((p_partkey * 37) % 400 + 5 + p_size AS INT) AS x1, CAST((p_partkey * 53) % 400 + 5 + (p_size * 3) % 40 AS INT) AS y1 FROM part)"""
#: Edges of a notched box at x0, y0 with width w and height h, by ring.
NOTCHED_SQL = """(SELECT * FROM (VALUES (0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0), (1.0, 1.0, 0.5, 0.5), (0.5, 0.5, 0.0, 1.0), (0.0, 1.0, 0.0, 0.0), (0.25, 0.125, 0.5, 0.375), (0.5, 0.375, 0.75, 0.125), (0.75, 0.125, 0.25, 0.125)) n(a, b, c, d))"""
EDGES_SQL = BX_SQL + f""",
pe AS (SELECT id, CAST(x0 + (x1 - x0) * a AS DOUBLE) AS ax, CAST(y0 + (y1 - y0) * b AS DOUBLE) AS ay, CAST(x0 + (x1 - x0) * c AS DOUBLE) AS bx, CAST(y0 + (y1 - y0) * d AS DOUBLE) AS b_y FROM bx, {NOTCHED_SQL}),
ze AS (SELECT CAST(n_nationkey AS INT) AS zone, CAST(n_nationkey % 5 * 100 + 100 * a AS DOUBLE) AS ax, CAST(n_nationkey // 5 * 100 + 100 * b AS DOUBLE) AS ay, CAST(n_nationkey % 5 * 100 + 100 * c AS DOUBLE) AS bx, CAST(n_nationkey // 5 * 100 + 100 * d AS DOUBLE) AS b_y FROM nation, {NOTCHED_SQL})"""
GRID_SQL = PX_SQL + """,
tg AS (SELECT DISTINCT tile_id, CAST(tile_id // 4 AS INT) AS grow, CAST(tile_id % 4 AS INT) AS gcol, CAST((tile_id // 4) // 2 AS INT) AS region_y, CAST((tile_id % 4) // 2 AS INT) AS region_x, CAST((tile_id // 4) % 2 AS INT) AS row, CAST((tile_id % 4) % 2 AS INT) AS col FROM px)"""
LOG_SQL = """lg AS (SELECT event_id AS step, CASE event_type WHEN 'view' THEN 'val' ELSE 'train' END AS mode, value AS loss, CAST(json_extract_string(props, '$.k') AS INT) AS k, ts FROM events)"""
LOGITS_SQL = """lz AS (SELECT vec_id, CAST(embedding[1:18] AS DOUBLE[]) AS z FROM embeddings)"""
