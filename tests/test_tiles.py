"""Tiles, grids, joins and files: invariants and edge cases."""

import pytest
from pyspark.sql import functions as F

from loamgrid.operators import grid, metrics, tiles
from loamgrid.plans.range_join import box_join, halo, predicate, prefixed
from loamgrid.sources import files


def full(spark, edge, tile=0):
    return spark.range(edge * edge).select(F.lit(tile).cast("long").alias("tile_id"), F.floor(F.col("id") / edge).cast("int").alias("r"), (F.col("id") % edge).cast("int").alias("c"), (F.col("id") % 7).cast("int").alias("v"))


def test_crop_then_mosaic_is_identity(spark):
    px = full(spark, 12)
    parts = [px.where(f"r DIV 4 = {a} AND c DIV 4 = {b}").select(F.lit(a * 3 + b).alias("part"), "r", "c", "v") for a in range(3) for b in range(3)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    back = tiles.mosaic(union, ["r", "c"], "v", "part")
    assert back.exceptAll(px.select("r", "c", "v")).count() == 0 and back.count() == 144


def test_rescale_keeps_and_doubles(spark):
    px = full(spark, 4)
    assert tiles.rescale_nearest(px, 1, 4).exceptAll(px).count() == 0
    assert tiles.rescale_nearest(px, 0.5, 4).count() == 64


def test_windows():
    assert tiles.window_starts(32, 16, 10) == [0, 10, 16]
    assert tiles.window_starts(10, 16, 10) == [0]
    assert tiles.window_starts(32, 16, 16) == [0, 16]


def test_sliding_mean_of_plain_values_is_the_value(spark):
    got = tiles.sliding_mean(full(spark, 12), "v", 12, 5, 3).join(full(spark, 12), ["tile_id", "r", "c"])
    assert got.where("abs(mean - v) > 1e-9").count() == 0 and got.count() == 144


def test_zero_fill_with_and_without_wrap(spark):
    px = full(spark, 4).withColumn("v", F.when((F.col("r") == 3) & (F.col("c") == 1), 0).otherwise(F.col("r") + 1))
    at = lambda df: df.where("r = 3 AND c = 1").first().v
    assert at(tiles.zero_fill(px, "v", 4)) == 4
    assert at(tiles.zero_fill(px, "v", 4, wrap=True)) == 1


def test_halo_wraps_regions(spark):
    t = spark.createDataFrame([(k, k // 3, k % 3) for k in range(9)], "tile_id long, grow int, gcol int")
    n = {r.tile_id: r.n for r in halo(t).groupBy("tile_id").agg(F.count("*").alias("n")).collect()}
    assert n == {0: 4, 1: 6, 2: 4, 3: 6, 4: 9, 5: 6, 6: 4, 7: 6, 8: 4}


def test_box_join_equals_nested_loop(spark):
    b = spark.range(120).selectExpr("id", "cast(id * 37 % 100 - 50 as int) x0", "cast(id * 53 % 100 - 50 as int) y0").withColumns({"x1": F.col("x0") + F.col("id") % 30, "y1": F.col("y0") + F.col("id") % 17}).withColumns({k: F.col(k).cast("int") for k in ("x1", "y1")})
    got = {(r.id, r.r_id) for r in box_join(b, prefixed(b), 10).collect()}
    rows = b.collect()
    assert got == {(p.id, q.id) for p in rows for q in rows if p.x0 <= q.x1 and p.x1 >= q.x0 and p.y0 <= q.y1 and p.y1 >= q.y0}
    assert box_join(b, prefixed(b), 10).count() == len(got)


def test_predicates(spark):
    df = spark.createDataFrame([("a & b", 1), ("c", 2)], "name string, n int")
    assert df.where(predicate("name == 'a & b' | n in [2, 3]")).count() == 2
    assert df.where(predicate("name.str.contains('&')")).count() == 1
    assert df.where(predicate("~(n > @k)", {"k": 1})).count() == 1


def test_quadtree_counts_and_order(spark):
    q = grid.quadtree(spark.createDataFrame([(1, 0.0, 0.0, 8.0, 8.0)], "cell int, x0 double, y0 double, x1 double, y1 double"), 2)
    rows = q.orderBy("place").collect()
    assert len(rows) == 21 and rows[-1].path == "" and [r.path for r in rows[:5]] == ["00", "01", "02", "03", "0"]
    assert q.where("depth = 2").agg(F.sum(F.expr("(x1 - x0) * (y1 - y0)"))).first()[0] == 64


def test_split_sizes(spark):
    s = grid.split(spark.range(101).withColumnRenamed("id", "k"), "k", 3)
    assert {r.split: r.n for r in s.groupBy("split").agg(F.count("*").alias("n")).collect()} == {"train": 70, "val": 15, "test": 16}


def test_two_squares(spark):
    """A square of 100 x 100 pixels predicted 50 pixels aside in 512 x 512."""
    px = spark.range(512 * 512).select((F.col("id") / 512).cast("int").alias("r"), (F.col("id") % 512).cast("int").alias("c"))
    inside = lambda x0: F.when(F.col("r").between(100, 199) & F.col("c").between(x0, x0 + 99), 1).otherwise(0)
    m = metrics.class_metrics(metrics.confusion(px.select(inside(100).alias("label"), inside(150).alias("pred")))).where("class_id = 1").first()
    assert (m.iou, m.precision, m.recall, m.f1) == (5000 / 15000, 0.5, 0.5, 0.5)


def test_empty_classes_have_zero_or_null(spark):
    cm = metrics.confusion(spark.createDataFrame([(1, 2)], "label int, pred int"))
    assert metrics.class_metrics(cm).where("class_id = 1").first().precision == 0.0
    assert metrics.class_metrics(cm, zero=False).where("class_id = 1").first().precision is None
    assert metrics.macro_metrics(cm).first().mcc in (0.0, -0.0)


def test_files(spark, tmp_path):
    px = full(spark, 8)
    coded = files.encode_tiles(px, "v", 8)
    assert files.decode_tiles(coded, "v").exceptAll(px).count() == 0
    files.write_tiles(coded.selectExpr("'gt' AS product", "2020 AS year", "*"), str(tmp_path / "t"))
    files.write_tiles(coded.selectExpr("'gt' AS product", "2023 AS year", "*"), str(tmp_path / "t"), overwrite=True)
    assert {r.year for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {2020, 2023}
    with pytest.raises(ValueError, match="compression"):
        files.write_tiles(coded, str(tmp_path / "u"), codec="zip")
    with pytest.raises(Exception, match="no class for"):
        files.reclassify_tiles(coded, {0: 1}).collect()
    (tmp_path / "s.yaml").write_text("train: [2, 1]\nval: [3]\n")
    assert {(r.split, r.id) for r in files.split_table(spark, str(tmp_path / "s.yaml")).collect()} == {("train", 1), ("train", 2), ("val", 3)}
    files.write_csv(spark.createDataFrame([(1, 0.5)], "class_id int, iou double"), str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).first().iou == "0.5"
    (tmp_path / "log.json").write_text('{"env": "x"}\n{"mode": "train", "loss": 1.5}\n{"mode": "val", "loss": 2.0}\n')
    assert [r.loss for r in files.training_log(spark, str(tmp_path / "log.json")).collect()] == [1.5]
    own = tmp_path / "rasters"
    (own / "a").mkdir(parents=True)
    (own / "a" / "x.tif").write_bytes(b"1")
    (own / "y.tif").write_bytes(b"12")
    assert {r.relative for r in files.raster_files(spark, str(own), recursive=True).collect()} == {"a/x.tif", "y.tif"}
    assert files.raster_files(spark, str(own)).count() == 1


def test_stream_repeats_nothing(spark, tmp_path):
    from loamgrid.streaming.tiles import process_stream, tile_stream

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    full(spark, 4).write.parquet(src)
    for k in range(2):
        process_stream(tile_stream(spark, src, full(spark, 4).schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")), lambda df: tiles.crop_border(df, 1, 4), out, str(tmp_path / f"c{k}"), ["tile_id"]).awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_later_rows_of_a_key_are_added_and_repeated_batches_are_not(spark, tmp_path):
    from loamgrid.streaming.tiles import process_stream, tile_stream

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(2):
        spark.createDataFrame([(1, k)], "tile_id long, r int").write.mode("append").parquet(src)
        process_stream(tile_stream(spark, src, "tile_id long, r int"), lambda df: df, out, str(tmp_path / "one")).awaitTermination()
    assert sorted(r.r for r in spark.read.parquet(out).collect()) == [0, 1]


def test_vector_tables_round_trip(spark, tmp_path):
    from loamgrid.sources import vectors

    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    hole = [ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0)), ring((2, 2), (2, 4), (4, 4), (4, 2), (2, 2))]
    rows = [(1, "a", hole), (2, None, [ring((20, 0), (30, 0), (25, 5), (20, 0))]), (3, "c", None)]
    df = spark.createDataFrame(rows, f"id long, name string, geometry {vectors.RINGS}")
    for form in ("wkb", "geojson"):
        path = str(tmp_path / form)
        vectors.write_vectors(df, path, form)
        back = vectors.read_vectors(spark, path, form, "id bigint, name string")
        assert sorted(map(str, back.select("id", "name", "geometry").collect())) == sorted(map(str, df.collect()))
        assert {r.id: r.a for r in back.select("id", vectors.area("geometry").alias("a")).collect()} == {1: 96.0, 2: 25.0, 3: None}
        assert [r.id for r in vectors.read_vectors(spark, path, form, "id bigint, name string", box=(15.0, 0.0, 22.0, 1.0)).collect()] == [2]
    with pytest.raises(ValueError):
        vectors.write_vectors(df, str(tmp_path / "x"), "shp")


def test_splits_and_pairs_are_written_by_executors(spark, tmp_path):
    path = str(tmp_path / "split")
    want = {("train", k) for k in range(50)} | {("val", 100), ("test", -7)}
    files.write_split(spark.createDataFrame(sorted(want), "split string, id long").repartition(3), path)
    assert {(r.split, r.id) for r in files.read_split(spark, path).collect()} == want
    lines = [x for p in sorted((tmp_path / "split" / "split=train").glob("part-*")) for x in p.read_text().split()[1::2]]
    assert sorted(map(int, lines)) == list(range(50))
    tiles_ = spark.createDataFrame([(k, bytes([k])) for k in range(4)], "tile_id long, data binary")
    files.write_pairs(tiles_, tiles_.where("tile_id > 0"), spark.createDataFrame([(1, "train"), (2, "val"), (9, "val")], "id long, split string"), str(tmp_path / "pairs"))
    assert {(r.split, r.tile_id, bytes(r.image)) for r in files.read_pairs(spark, str(tmp_path / "pairs")).collect()} == {("train", 1, b"\1"), ("val", 2, b"\2")}


def test_image_codecs_are_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, "p", 2020)], "tile_id long, product string, year int")
    for codec in ("LZW", "JPEG", "unheard"):
        with pytest.raises(ValueError):
            files.write_tiles(df, str(tmp_path / "t"), codec=codec)
    files.write_tiles(df, str(tmp_path / "t"), codec="DEFLATE")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_csv_append(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5)], "k int, iou double")
    files.write_csv(df, str(tmp_path / "m"))
    files.write_csv(df, str(tmp_path / "m"), append=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).count() == 2
