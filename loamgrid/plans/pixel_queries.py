"""Queries of pixels: scans, maps, filters, joins of dates, mosaics, kernels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classes as K
from ..operators import changes, grid, tiles
from ..sources import files, rasters, shared
from ..sources.fixtures import BANDS_SQL, GRID_SQL, LOG_SQL, LOGITS_SQL, PX_SQL, bands, logits, pixels, tile_grid, train_log
from .evaluation import NAMES, SUPER
from .range_join import halo, predicate
from .registry import query

W = f"WITH {PX_SQL} "
SOIL = "(8, 9, 10, 11, 12)"
NON = "(1, 2, 3, 4, 5, 6, 13, 14, 15, 16, 17)"

# scans


@query("sc3_first_band", f"WITH {BANDS_SQL} SELECT tile_id, r, c, value FROM bands WHERE band = 1")
def first_band(spark, d):
    return tiles.bands(bands(spark, d), 1, 1).drop("band")


@query("pr3_three_bands", f"WITH {BANDS_SQL} SELECT tile_id, r, c, CAST(band - 1 AS INT) AS band, value FROM bands WHERE band BETWEEN 2 AND 4")
def three_bands(spark, d):
    return tiles.bands(bands(spark, d), 2, 4)


@query("sc4_masked_read", W + "SELECT tile_id, count(nullif(pred, 0)) AS n_valid, CAST(sum(nullif(pred, 0)) AS BIGINT) AS total FROM px GROUP BY tile_id")
def masked_read(spark, d):
    return tiles.masked(pixels(spark, d), "pred", 0).groupBy("tile_id").agg(F.count("pred").alias("n_valid"), F.sum("pred").alias("total"))


@query("sc6_mosaic_bounds", f"WITH {GRID_SQL} SELECT min(gcol * 32) AS x0, min(-(grow + 1) * 32) AS y0, max((gcol + 1) * 32) AS x1, max(-grow * 32) AS y1 FROM tg")
def mosaic_bounds(spark, d):
    return tiles.bounds(tiles.tile_boxes(None, tile_grid(spark, d)))


@query("ag21_region_bounds", f"WITH {GRID_SQL} SELECT region_x, region_y, min(gcol * 32) AS x0, min(-(grow + 1) * 32) AS y0, max((gcol + 1) * 32) AS x1, max(-grow * 32) AS y1 FROM tg GROUP BY ALL")
def region_bounds(spark, d):
    t = tile_grid(spark, d)
    return tiles.bounds(tiles.tile_boxes(None, t).join(t.select("tile_id", "region_x", "region_y"), "tile_id"), ["region_x", "region_y"])


@query("sc9_mask_layers", W + "SELECT 'a' AS layer, tile_id, r, -1 AS c FROM px WHERE pred = 3 UNION ALL SELECT 'b', tile_id, -1, c FROM px WHERE pred = 4")
def mask_layers(spark, d):
    px = pixels(spark, d)
    return px.where("pred = 3").select(F.lit("a").alias("layer"), "tile_id", "r").unionByName(px.where("pred = 4").select(F.lit("b").alias("layer"), "tile_id", "c"), allowMissingColumns=True).na.fill(-1)


@query("sc11_train_log", f"WITH {LOG_SQL} SELECT step, loss, k FROM lg WHERE mode = 'train'")
def train_lines(spark, d):
    return train_log(spark, d).where("mode = 'train'").select("step", "loss", "k")


@query("sc19_image_links", "WITH l AS (SELECT concat('https://data.example/image_', 2000 + o_orderkey % 24, '_', 2400 + o_orderkey % 100, '-', 1100 + o_orderkey % 90, '_0.1.tif') AS url FROM orders) SELECT CAST(regexp_extract(url, '_([0-9]{4})_', 1) AS INT) AS year, CAST(regexp_extract(url, '_([0-9]{4})-([0-9]{4})_', 1) AS INT) AS east_km, CAST(regexp_extract(url, '_([0-9]{4})-([0-9]{4})_', 2) AS INT) AS north_km, count(*) AS n FROM l GROUP BY ALL")
def image_links(spark, d):
    o = F.col("o_orderkey")
    url = F.concat(F.lit("https://data.example/image_"), 2000 + o % 24, F.lit("_"), 2400 + o % 100, F.lit("-"), 1100 + o % 90, F.lit("_0.1.tif"))
    at = lambda p, k: F.regexp_extract("url", p, k).cast("int")
    km = r"_([0-9]{4})-([0-9]{4})_"
    return spark.read.parquet(f"{d}/orders.parquet").select(url.alias("url")).groupBy(at(r"_([0-9]{4})_", 1).alias("year"), at(km, 1).alias("east_km"), at(km, 2).alias("north_km")).agg(F.count("*").alias("n"))


# maps


@query("pr1_reclassify_super", W + f"SELECT tile_id, r, c, {SUPER.format(c='pred')} AS cls FROM px")
def reclassify_super(spark, d):
    return pixels(spark, d).select("tile_id", "r", "c", K.lookup(F.col("pred"), K.TO_SUPERCLASS, strict=True).alias("cls"))


@query("pr4_label_ids", W + f", n AS (SELECT {NAMES.format(c='y1')} AS name FROM px) SELECT name, count(*) AS n, CAST(CASE name " + " ".join(f"WHEN '{v}' THEN {k}" for k, v in enumerate(K.CLASSES)) + " END AS INT) AS class_id FROM n GROUP BY name")
def label_ids(spark, d):
    named = pixels(spark, d).select(K.lookup(F.col("y1"), dict(enumerate(K.CLASSES))).alias("name"))
    return named.groupBy("name").agg(F.count("*").alias("n")).withColumn("class_id", K.lookup(F.col("name"), {v: k for k, v in enumerate(K.CLASSES)}))


@query("pr5_soil_flags", W + f"SELECT y1 IN {SOIL} AS soil, {SUPER.format(c='y1')} AS package_id, count(*) AS n FROM px GROUP BY ALL")
def soil_flags(spark, d):
    y = F.col("y1")
    return pixels(spark, d).groupBy(y.isin(K.SOIL).alias("soil"), K.lookup(y, K.TO_SUPERCLASS).alias("package_id")).agg(F.count("*").alias("n"))


@query("pr6_soil_mask", W + f"SELECT tile_id, r, c, CASE WHEN pred IN {SOIL} THEN 1 ELSE 0 END AS soil FROM px")
def soil_mask(spark, d):
    return pixels(spark, d).select("tile_id", "r", "c", F.col("pred").isin(K.SOIL).cast("int").alias("soil"))


@query("pr7_jn4_transition_codes", W + "SELECT tile_id, r, c, CAST((a.y1 - 1) * 17 + b.y2 AS INT) AS code FROM (SELECT tile_id, r, c, y1 FROM px) a JOIN (SELECT tile_id, r, c, y2 FROM px) b USING (tile_id, r, c)")
def transition_codes(spark, d):
    px = pixels(spark, d)
    both = px.select("tile_id", "r", "c", "y1").join(px.select("tile_id", "r", "c", "y2"), ["tile_id", "r", "c"])
    return changes.transitions(both).select("tile_id", "r", "c", "code")


GROUPS = f"""CASE WHEN y1 = y2 THEN 'same' WHEN (y1 = 7) <> (y2 = 7) THEN 'snow' WHEN y1 IN {SOIL} AND y2 IN {NON} THEN 'soil_to_nonsoil' WHEN y1 IN {NON} AND y2 IN {SOIL} THEN 'nonsoil_to_soil' ELSE 'other' END"""


@query("s216_transition_groups", W + f"SELECT {GROUPS} AS grp, count(*) AS n, count(*) FILTER (WHERE y1 IN {SOIL} AND y2 IN (1, 17)) AS to_building, count(*) FILTER (WHERE y1 = 8 AND y2 IN {NON} AND y2 NOT IN (1, 17)) AS from_vege, count(*) FILTER (WHERE y1 = 8 AND y2 = 5) AS vege_to_water FROM px GROUP BY 1")
def transition_groups(spark, d):
    g = K.groups(F.col("y1"), F.col("y2"))
    name = F.lit("other")
    for k in ("nonsoil_to_soil", "soil_to_nonsoil", "snow", "same"):
        name = F.when(g[k], k).otherwise(name)
    return pixels(spark, d).groupBy(name.alias("grp")).agg(F.count("*").alias("n"), *(F.count_if(g[k]).alias(n) for k, n in (("soil_to_building", "to_building"), ("vege_to_nonsoil", "from_vege"), ("vege_to_water", "vege_to_water"))))


@query("s216_decoded_transitions", W + ", t AS (SELECT DISTINCT CAST((y1 - 1) * 17 + y2 AS INT) AS code FROM px) SELECT code, CAST((code - 1) // 17 + 1 AS INT) AS c1, CAST((code - 1) % 17 + 1 AS INT) AS c2 FROM t")
def decoded(spark, d):
    t = changes.transitions(pixels(spark, d)).select("code").distinct()
    c1, c2 = K.decode(F.col("code"))
    return t.select("code", c1.alias("c1"), c2.alias("c2"))


@query("pr8_difference", W + "SELECT tile_id, round(avg(CASE WHEN y1 = pred THEN 1.0 ELSE 0.0 END), 6) AS equal_share, CAST(sum(abs(y1 - pred)) AS BIGINT) AS total FROM px GROUP BY tile_id")
def difference(spark, d):
    return pixels(spark, d).groupBy("tile_id").agg(F.round(F.avg((F.col("y1") == F.col("pred")).cast("double")), 6).alias("equal_share"), F.sum(F.abs(F.col("y1") - F.col("pred"))).alias("total"))


@query("pr9_score_quantise", W + ", f AS (SELECT tile_id, r, c, CAST(conf1_milli / 1000.0 AS FLOAT) AS x FROM px) SELECT tile_id, r, c, CAST(CASE WHEN x <= 0.25::FLOAT THEN trunc(x / 0.25::FLOAT * 250::FLOAT) WHEN x <= 0.3::FLOAT THEN 251 WHEN x <= 0.4::FLOAT THEN 252 WHEN x <= 0.6::FLOAT THEN 253 WHEN x <= 0.8::FLOAT THEN 254 WHEN x <= 1 THEN 255 ELSE 0 END AS INT) AS score FROM f")
def score_quantise(spark, d):
    return pixels(spark, d).select("tile_id", "r", "c", K.score_bins(F.col("conf1_milli") / 1000).alias("score"))


SOFT = f"WITH {LOGITS_SQL}, e AS (SELECT vec_id, z, list_transform(z, lambda v: exp(v - list_max(z))) AS p FROM lz), s AS (SELECT vec_id, z, list_transform(p, lambda v: v / list_sum(p)) AS p FROM e)"
BEST = lambda ids: "greatest(" + ", ".join(f"p[{k + 1}]" for k in ids) + ")"


@query("pr10_pr11_pr12_softmax_margin", SOFT + f" SELECT vec_id, CAST(list_position(z, list_max(z)) - 1 AS INT) AS cls, round(abs({BEST(K.SOIL)} - {BEST(K.NON_SOIL)}), 6) AS margin FROM s")
def softmax_margin(spark, d):
    p = logits(spark, d).select("vec_id", "logits", K.softmax(F.col("logits")).alias("p"))
    return p.select("vec_id", K.argmax(F.col("logits")).alias("cls"), F.round(K.margin(F.col("p")), 6).alias("margin"))


@query("pr13_normalised_bands", f"WITH {BANDS_SQL}, s AS (SELECT band, avg(value) AS mean, stddev_pop(value) AS std FROM bands GROUP BY band) SELECT tile_id, r, c, band, round((value - mean) / nullif(std, 0), 6) AS value FROM bands JOIN s USING (band)")
def normalised_bands(spark, d):
    b = bands(spark, d)
    s = b.groupBy("band").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    return b.join(F.broadcast(s), "band").select("tile_id", "r", "c", "band", F.round(F.try_divide(F.col("value") - F.col("mean"), F.col("std")), 6).alias("value"))


@query("pr14_byte_scores", W + "SELECT tile_id, r, c, CAST(floor(conf1_milli * 255 / 1000) AS SMALLINT) AS score FROM px")
def byte_scores(spark, d):
    return pixels(spark, d).select("tile_id", "r", "c", F.floor(F.col("conf1_milli") * 255 / 1000).cast("smallint").alias("score"))


@query("pr15_renamed", W + "SELECT tile_id AS px_tile_id, r AS px_r, c AS px_c, y1 AS label FROM px")
def renamed(spark, d):
    return pixels(spark, d).select("tile_id", "r", "c", "y1").withColumnsRenamed({"y1": "label"} | {k: f"px_{k}" for k in ("tile_id", "r", "c")})


@query("pr16_name_parts", "WITH n AS (SELECT concat(o_orderkey % 7, '-', o_orderkey % 11, '-', o_orderkey, '.tif') AS name FROM orders) SELECT name, CAST(string_split(regexp_replace(name, '\\.tif$', ''), '-')[3] AS BIGINT) AS id, translate(replace(name, '-', '_'), 'tif', 'TIF') AS upper_name FROM n")
def cleaned_names(spark, d):
    o = F.col("o_orderkey")
    n = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(o % 7, F.lit("-"), o % 11, F.lit("-"), o, F.lit(".tif")).alias("name"))
    return n.select("name", F.split(F.regexp_replace("name", r"\.tif$", ""), "-")[2].cast("bigint").alias("id"), F.translate(F.replace("name", F.lit("-"), F.lit("_")), "tif", "TIF").alias("upper_name"))


@query("pr18_mask_bits", W + "SELECT tile_id, y1 & pred AS both_bits, y1 | pred AS any_bits, count(*) AS n FROM px GROUP BY ALL")
def mask_bits(spark, d):
    a, b = F.col("y1"), F.col("pred")
    return pixels(spark, d).groupBy("tile_id", a.bitwiseAND(b).alias("both_bits"), a.bitwiseOR(b).alias("any_bits")).agg(F.count("*").alias("n"))


@query("sk8_palette", W + "SELECT tile_id, r, c, pred * 14 AS red, 255 - pred * 14 AS green, (pred * 53) % 256 AS blue FROM px")
def palette(spark, d):
    colours = spark.createDataFrame([(k, k * 14, 255 - k * 14, k * 53 % 256) for k in range(18)], "pred int, red int, green int, blue int")
    return pixels(spark, d).join(F.broadcast(colours), "pred").select("tile_id", "r", "c", "red", "green", "blue")  # 18 rows


# filters


@query("fl1_grid_query", W + "SELECT tile_id, r, c FROM px WHERE (y1 = 3 AND tile_id = 5) OR NOT (r < 30)")
def grid_query(spark, d):
    return pixels(spark, d).where(predicate("(y1 == 3 & tile_id == 5) | ~(r < 30)")).select("tile_id", "r", "c")


@query("fl3_fl4_id_lists", W + ", ids AS (SELECT DISTINCT tile_id FROM px WHERE tile_id % 3 = 0), no AS (SELECT DISTINCT tile_id FROM px WHERE tile_id % 2 = 0) SELECT tile_id, count(*) AS n FROM px WHERE tile_id IN (SELECT tile_id FROM ids) AND tile_id NOT IN (SELECT tile_id FROM no) GROUP BY tile_id")
def id_lists(spark, d):
    px = pixels(spark, d)
    ids = px.select("tile_id").distinct()
    return px.join(ids.where("tile_id % 3 = 0"), "tile_id", "left_semi").join(ids.where("tile_id % 2 = 0"), "tile_id", "left_anti").groupBy("tile_id").agg(F.count("*").alias("n"))


@query("fl5_usable_labels", W + ", l AS (SELECT tile_id, nullif(pred, 0) AS label, r FROM px) SELECT tile_id, label, part, count(*) AS n FROM (SELECT *, unnest(range(1 + r % 2)) AS part FROM l WHERE label IS NOT NULL) GROUP BY ALL")
def usable_labels(spark, d):
    p = pixels(spark, d).select("tile_id", F.nullif("pred", F.lit(0)).alias("label"), "r").dropna(subset=["label"])
    return p.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("r") % 2).cast("long")))).groupBy("tile_id", "label", "part").agg(F.count("*").alias("n"))


@query("fl6_confident", W + "SELECT tile_id, count(*) AS n FROM px WHERE conf1_milli >= 800 GROUP BY tile_id")
def confident(spark, d):
    return pixels(spark, d).where("conf1_milli >= 800").groupBy("tile_id").agg(F.count("*").alias("n"))


@query("fl7_without_nodata", W + "SELECT pred AS cls, count(*) AS n FROM px WHERE pred <> 0 GROUP BY pred")
def without_nodata(spark, d):
    return pixels(spark, d).where("pred <> 0").groupBy(F.col("pred").alias("cls")).agg(F.count("*").alias("n"))


@query("fl9_whole_tiles", W + ", s AS (SELECT tile_id, max(r) + 1 AS h, max(c) + 1 AS w FROM px GROUP BY tile_id) SELECT tile_id FROM s WHERE abs(h - 32) <= 2 AND abs(w - 32) <= 2")
def whole_tiles(spark, d):
    s = pixels(spark, d).groupBy("tile_id").agg((F.max("r") + 1).alias("h"), (F.max("c") + 1).alias("w"))
    return s.where("abs(h - 32) <= 2 AND abs(w - 32) <= 2").select("tile_id")


@query("fl10_non_empty_tiles", W + "SELECT tile_id FROM px GROUP BY tile_id HAVING max(abs(pred - pred * (tile_id % 2))) <> 0")
def non_empty(spark, d):
    return tiles.drop_empty(pixels(spark, d).withColumn("v", F.col("pred") - F.col("pred") * (F.col("tile_id") % 2)), "v")


@query("fl12_nodata_areas", W + "SELECT tile_id, CAST(count(*) AS DOUBLE) * max(px_dm) * max(px_dm) / 100 AS area_m2 FROM px WHERE pred = 0 GROUP BY tile_id HAVING count(*) * max(px_dm) * max(px_dm) / 100 > 10")
def nodata_areas(spark, d):
    a = pixels(spark, d).where("pred = 0").groupBy("tile_id").agg((F.count("*") * F.max("px_dm") * F.max("px_dm") / 100.0).alias("area_m2"))
    return a.where("area_m2 > 10")


@query("fl14_not_canton", "SELECT c_custkey, name FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS name FROM customer) WHERE name IS DISTINCT FROM 'MACHINERY'")
def not_canton(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("name"))
    return c.where(~F.col("name").eqNullSafe("MACHINERY"))


# joins and sets


@query("jn1_labels_predictions", W + "SELECT a.tile_id, count(*) AS n, CAST(sum(CASE WHEN a.y1 = b.pred THEN 1 ELSE 0 END) AS BIGINT) AS equal FROM px a JOIN px b USING (tile_id, r, c) GROUP BY a.tile_id")
def labels_predictions(spark, d):
    px = pixels(spark, d)
    pairs = px.select("tile_id", "r", "c", "y1").join(px.select("tile_id", "r", "c", "pred"), ["tile_id", "r", "c"], "left")
    pred = F.coalesce("pred", F.raise_error(F.lit("a label has no prediction")).cast("int"))
    return pairs.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum((F.col("y1") == pred).cast("long")).alias("equal"))


@query("jn2_models_per_tile", W + ", m AS (SELECT DISTINCT tile_id, pred % 3 AS model FROM px) SELECT model, count(DISTINCT tile_id) AS n_tiles FROM m GROUP BY model")
def models_per_tile(spark, d):
    m = pixels(spark, d).select("tile_id", (F.col("pred") % 3).alias("model")).distinct()
    gt = pixels(spark, d).select("tile_id").distinct()
    one = gt.join(m, "tile_id").groupBy("tile_id", "model").agg(F.count("*").alias("k"))
    return one.withColumn("k", F.when(F.col("k") == 1, 1).otherwise(F.raise_error(F.lit("more than one prediction")).cast("int"))).groupBy("model").agg(F.sum("k").alias("n_tiles"))


@query("jn3_st2_common_ids", W + "SELECT tile_id FROM px WHERE pred = 3 INTERSECT SELECT tile_id FROM px WHERE pred = 5")
def common_ids(spark, d):
    px = pixels(spark, d)
    return px.where("pred = 3").select("tile_id").intersect(px.where("pred = 5").select("tile_id"))


@query("st3_lost_ids", W + "SELECT tile_id FROM px EXCEPT SELECT tile_id FROM px WHERE pred = 5 AND y1 = 5")
def lost_ids(spark, d):
    px = pixels(spark, d)
    return px.select("tile_id").distinct().join(px.where("pred = 5 AND y1 = 5").select("tile_id"), "tile_id", "left_anti")


@query("st4_distinct_pairs", W + "SELECT DISTINCT y1, y2 FROM px")
def distinct_pairs(spark, d):
    return pixels(spark, d).select("y1", "y2").distinct()


@query("st1_union", W + "SELECT 'first' AS date, y1 AS cls, count(*) AS n FROM px GROUP BY y1 UNION ALL SELECT 'second', y2, count(*) FROM px GROUP BY y2")
def union(spark, d):
    px = pixels(spark, d)
    one = lambda n, c: px.groupBy(F.col(c).alias("cls")).agg(F.count("*").alias("n")).select(F.lit(n).alias("date"), "cls", "n")
    return one("first", "y1").unionByName(one("second", "y2"))


@query("jn13_band_stats", f"WITH {BANDS_SQL}, s AS (SELECT tile_id, band, round(avg(value), 6) AS mean, max(value) AS top FROM bands GROUP BY ALL) SELECT tile_id, " + ", ".join(f"max(CASE WHEN band = {k} THEN mean END) AS mean_{k}, max(CASE WHEN band = {k} THEN top END) AS top_{k}" for k in (1, 2, 3)) + " FROM s WHERE band < 4 GROUP BY tile_id")
def band_stats(spark, d):
    p = bands(spark, d).where("band < 4").groupBy("tile_id").pivot("band", [1, 2, 3]).agg(F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("top"))
    return p.select("tile_id", *(F.col(f"{k}_{n}").alias(f"{n}_{k}") for k in (1, 2, 3) for n in ("mean", "top")))


@query("jn14_scale_lookup", W + "SELECT tile_id, CASE px_dm WHEN 1 THEN 25 WHEN 10 THEN 250 ELSE 2500 END AS buffer FROM (SELECT DISTINCT tile_id, px_dm FROM px)")
def scale_lookup(spark, d):
    return pixels(spark, d).select("tile_id", "px_dm").distinct().select("tile_id", K.lookup(F.col("px_dm"), {1: 25, 10: 250, 100: 2500}).alias("buffer"))


@query("jn15_initial_tile", f"WITH {GRID_SQL} SELECT a.tile_id, b.grow, b.gcol FROM (SELECT DISTINCT tile_id FROM px) a JOIN tg b USING (tile_id)")
def initial_tile(spark, d):
    return pixels(spark, d).select("tile_id").distinct().join(tile_grid(spark, d).select("tile_id", "grow", "gcol"), "tile_id")


@query("jn5_halo_neighbours", f"WITH {GRID_SQL}, o AS (SELECT range - 1 AS o FROM range(3)) SELECT a.tile_id, CAST(dr.o AS INT) AS dr, CAST(dc.o AS INT) AS dc, b.tile_id AS neighbour_id FROM tg a, o dr, o dc, tg b WHERE b.grow = a.grow + dr.o AND b.gcol = a.gcol + dc.o")
def halo_neighbours(spark, d):
    return halo(tile_grid(spark, d)).select("tile_id", "dr", "dc", "neighbour_id")


@query("sk9_missing_tiles", W + "SELECT DISTINCT tile_id FROM px WHERE tile_id NOT IN (SELECT tile_id FROM px WHERE pred = 7)")
def missing_tiles(spark, d):
    px = pixels(spark, d)
    return files.missing_only(px.select("tile_id").distinct(), px.where("pred = 7"), ["tile_id"])


@query("sk10_upsert", W + ", a AS (SELECT DISTINCT tile_id FROM px), b AS (SELECT tile_id, count(*) AS n FROM px WHERE pred = 0 GROUP BY tile_id) SELECT tile_id, coalesce(n, 0) AS n FROM a FULL JOIN b USING (tile_id)")
def upsert(spark, d):
    """The names of all tiles, with the new counts of those that have pixels of class 0."""
    px = pixels(spark, d)
    return files.upsert_names(px.select("tile_id").distinct(), px.where("pred = 0").groupBy("tile_id").agg(F.count("*").alias("n")), "tile_id").na.fill(0)


# tiles


@query("rs4_crop_border", W + "SELECT tile_id, r - 3 AS r, c - 3 AS c, pred FROM px WHERE r BETWEEN 3 AND 28 AND c BETWEEN 3 AND 28")
def crop_border(spark, d):
    return tiles.crop_border(pixels(spark, d).select("tile_id", "r", "c", "pred"), 3, 32)


@query("rs1_sc5_rescale_nearest", W + ", m AS (SELECT CAST(range AS INT) AS i, CAST(floor((range + 0.5) * 32 / 12) AS INT) AS s FROM range(12)) SELECT tile_id, a.i AS r, b.i AS c, pred FROM px JOIN m a ON px.r = a.s JOIN m b ON px.c = b.s")
def rescale(spark, d):
    return tiles.rescale_nearest(pixels(spark, d).select("tile_id", "r", "c", "pred"), 2.6, 32)


@query("rs2_rs3_region_mosaics", f"WITH {GRID_SQL}, g AS (SELECT region_x, region_y, row * 28 + r AS r, col * 28 + c AS c, tile_id, nullif(pred, 0) AS v FROM px JOIN tg USING (tile_id)) SELECT region_x, region_y, r, c, min_by(v, tile_id) AS v FROM g WHERE v IS NOT NULL GROUP BY ALL")
def region_mosaics(spark, d):
    g = pixels(spark, d).join(tile_grid(spark, d), "tile_id")  # tiles overlap by four pixels
    px = g.select("region_x", "region_y", (F.col("row") * 28 + F.col("r")).alias("r"), (F.col("col") * 28 + F.col("c")).alias("c"), "tile_id", F.nullif("pred", F.lit(0)).alias("v"))
    return tiles.mosaic(px, ["region_x", "region_y", "r", "c"], "v", "tile_id")


@query("tg9_region_keys", f"WITH {GRID_SQL}, n AS (SELECT tile_id, concat(lpad(CAST(25000 + region_x AS VARCHAR), 8, '0'), '_', lpad(CAST(12000 + region_y AS VARCHAR), 8, '0'), '_', row, '_', col, '.tif') AS name FROM tg) SELECT tile_id, concat(substr(name, 1, 6), '_', substr(name, 10, 6)) AS region FROM n")
def region_keys(spark, d):
    wide = lambda e: F.lpad(e.cast("string"), 8, "0")
    name = F.concat(F.concat_ws("_", wide(25000 + F.col("region_x")), wide(12000 + F.col("region_y")), "row", "col"), F.lit(".tif"))
    return tile_grid(spark, d).select("tile_id", tiles.region_key(name).alias("region"))


@query("vg7_tile_names", f"WITH {GRID_SQL}, n AS (SELECT tile_id, concat(region_x * 9702, '_', region_y * 9702, '_', row, '_', col, '.tif') AS name FROM tg) SELECT tile_id, name, CAST(string_split(name, '_')[1] AS BIGINT) AS minx, CAST(string_split(name, '_')[2] AS BIGINT) AS maxy FROM n")
def tile_names(spark, d):
    name = F.format_string("%d_%d_%d_%d.tif", F.col("region_x") * 9702, F.col("region_y") * 9702, F.col("row"), F.col("col"))
    n = tile_grid(spark, d).select("tile_id", name.alias("name"))
    return n.select("tile_id", "name", files.tile_key(F.col("name")).alias("k")).select("tile_id", "name", "k.minx", "k.maxy")


CUT = """, s AS (SELECT tile_id, CAST(r // 10 AS INT) AS crow, CAST(c // 10 AS INT) AS ccol, CAST(r % 10 AS INT) AS r, CAST(c % 10 AS INT) AS c, pred FROM px), k AS (SELECT tile_id, crow, ccol FROM s GROUP BY ALL HAVING abs(max(r) + 1 - 10) <= 2 AND abs(max(c) + 1 - 10) <= 2)"""


@query("rs5_cut_to_grid", W + CUT + " SELECT tile_id, crow, ccol, r, c, pred FROM s JOIN k USING (tile_id, crow, ccol)")
def cut_to_grid(spark, d):
    return tiles.cut_to_cells(pixels(spark, d).select("tile_id", "r", "c", "pred"), 10).select("tile_id", "crow", "ccol", "r", "c", "pred")


FILL = "".join(f", z{k + 1} AS (SELECT a.tile_id, a.r, a.c, CASE WHEN a.v = 0 THEN coalesce(b.v, 0) ELSE a.v END AS v FROM z{k} a LEFT JOIN z{k} b ON a.tile_id = b.tile_id AND b.r = a.r + {dr} AND b.c = a.c + {dc})" for k, (dr, dc) in enumerate(((1, 0), (0, 1), (-1, 0), (0, -1))))


@query("rs6_zero_fill", W + ", z0 AS (SELECT tile_id, r, c, pred AS v FROM px)" + FILL + " SELECT tile_id, r, c, v FROM z4")
def zero_fill(spark, d):
    return tiles.zero_fill(pixels(spark, d).select("tile_id", "r", "c", F.col("pred").alias("v")), "v", 32)


@query("rs7_padded_subtiles", W + ", t AS (SELECT DISTINCT tile_id FROM px) SELECT tile_id, CAST(i // 36 AS INT) AS r, CAST(i % 36 AS INT) AS c, coalesce(pred, 0) AS v FROM t CROSS JOIN (SELECT range AS i FROM range(1296)) LEFT JOIN px USING (tile_id) WHERE 1 = 0 UNION ALL SELECT t.tile_id, CAST(i // 36 AS INT), CAST(i % 36 AS INT), coalesce(px.pred, 0) FROM t CROSS JOIN (SELECT range AS i FROM range(1296)) LEFT JOIN px ON px.tile_id = t.tile_id AND px.r = i // 36 AND px.c = i % 36")
def padded(spark, d):
    return tiles.pad(pixels(spark, d).select("tile_id", "r", "c", F.col("pred").alias("v")), 36, ["tile_id"], "v")


@query("rs8_masked", W + "SELECT tile_id, r, c, CASE WHEN r + 0.5 > 4 AND r + 0.5 < 20 AND c + 0.5 > 6 AND c + 0.5 < 30 THEN pred ELSE 255 END AS v FROM px")
def masked(spark, d):
    y, x = F.col("r") + 0.5, F.col("c") + 0.5
    return tiles.mask_outside(pixels(spark, d).select("tile_id", "r", "c", F.col("pred").alias("v")), (y > 4) & (y < 20) & (x > 6) & (x < 30), "v", 255)


@query("rs9_clipped", W + "SELECT tile_id, r - 4 AS r, c - 6 AS c, pred AS v FROM px WHERE r BETWEEN 4 AND 19 AND c BETWEEN 6 AND 29")
def clipped(spark, d):
    return pixels(spark, d).where("r BETWEEN 4 AND 19 AND c BETWEEN 6 AND 29").selectExpr("tile_id", "r - 4 AS r", "c - 6 AS c", "pred AS v")


@query("rs14_content_box", W + "SELECT tile_id, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM px WHERE pred * CAST(r > 3 AND c < 29 AS INT) <> 0 GROUP BY tile_id")
def content(spark, d):
    return tiles.content_box(pixels(spark, d).withColumn("v", F.col("pred") * ((F.col("r") > 3) & (F.col("c") < 29)).cast("int")), "v")


@query("rs15_sliding_mean", W + ", s AS (SELECT k, s FROM (VALUES (0, 0), (1, 10), (2, 16)) v(k, s)), e AS (SELECT tile_id, r, c, conf1_milli + pred * (a.k * 3 + b.k) AS v FROM px JOIN s a ON r >= a.s AND r < a.s + 16 JOIN s b ON c >= b.s AND c < b.s + 16) SELECT tile_id, r, c, count(*) AS n, round(CAST(sum(v) AS DOUBLE) / count(*), 6) AS mean FROM e GROUP BY ALL")
def sliding(spark, d):
    m = tiles.sliding_mean(pixels(spark, d), "conf1_milli", 32, 16, 10, weight="pred")
    return m.withColumn("mean", F.round("mean", 6))


@query("rs16_flip_mean", W + "SELECT a.tile_id, a.r, a.c, round((a.conf1_milli + coalesce(b.conf1_milli, a.conf1_milli)) / 2.0, 6) AS mean FROM px a LEFT JOIN px b ON a.tile_id = b.tile_id AND a.r = b.r AND b.c = 31 - a.c")
def flipped(spark, d):
    return tiles.flip_mean(pixels(spark, d), "conf1_milli", 32).withColumn("mean", F.round("mean", 6))


# logs


@query("ag20_elapsed", f"WITH {LOG_SQL} SELECT mode, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) AS micros FROM lg GROUP BY mode")
def elapsed(spark, d):
    return train_log(spark, d).groupBy("mode").agg((F.unix_micros(F.max(F.col("ts").cast("timestamp"))) - F.unix_micros(F.min(F.col("ts").cast("timestamp")))).alias("micros"))


@query("wn6_every_nth", f"WITH {LOG_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY step) AS n FROM lg) SELECT mode, step, loss FROM n WHERE n > 50 AND (n - 51) % 50 = 0")
def every_nth(spark, d):
    n = grid.in_order(train_log(spark, d), "step", ["mode"]).withColumn("n", F.col("place") + 1)
    return n.where((F.col("n") > 50) & ((F.col("n") - 51) % 50 == 0)).select("mode", "step", "loss")


@query("wn7_clip_normalise", f"WITH {LOG_SQL}, q AS (SELECT mode, quantile_cont(loss, 0.975) AS q FROM lg GROUP BY mode), x AS (SELECT mode, step, least(loss, q) AS loss FROM lg JOIN q USING (mode)), b AS (SELECT mode, min(loss) AS lo, max(loss) AS hi FROM x GROUP BY mode) SELECT mode, step, round((loss - lo) / nullif(hi - lo, 0), 6) AS loss FROM x JOIN b USING (mode)")
def clip_normalise(spark, d):
    lg = train_log(spark, d)
    q = lg.groupBy("mode").agg(F.percentile("loss", F.lit(0.975)).alias("q"), F.min("loss").alias("lo"), F.max("loss").alias("top"))
    hi = F.least("top", "q")  # the greatest value after clipping
    lo = F.least("lo", "q")
    return lg.join(F.broadcast(q), "mode").select("mode", "step", F.round(F.try_divide(F.least("loss", "q") - lo, hi - lo), 6).alias("loss"))


__all__ = ["grid"]


@query("sk1_raster_files", W + "SELECT tile_id, r, c, pred FROM px WHERE r >= 8 AND r < 21 AND c >= 3 AND c < 30")
def raster_files(spark, d):
    """Tiles written as raster files, and a window of all of them read back: only the strips that it meets."""
    path = shared.new_folder(spark, "rasters")
    encoded = files.encode_tiles(pixels(spark, d), "pred", 32, empty=255)
    rasters.write_rasters(encoded.withColumn("name", F.concat(F.col("tile_id").cast("string"), F.lit(".tif"))), path, rows_per_strip=8)
    found = rasters.read_rasters(spark, path, (8, 21, 3, 30)).where("value <> 255")
    return found.select(F.regexp_extract("name", r"^(\d+)", 1).cast("long").alias("tile_id"), "r", "c", F.col("value").alias("pred"))
