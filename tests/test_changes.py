"""Classes, transitions and the tags of changes."""

import itertools

import pytest
from pyspark.sql import functions as F

from loamgrid.functions import classes as K
from loamgrid.operators import changes


def test_codes_decode(spark):
    df = spark.createDataFrame([(a, b) for a in range(1, 18) for b in range(1, 18)], "a int, b int").withColumn("code", K.transition(F.col("a"), F.col("b")))
    c1, c2 = K.decode(F.col("code"))
    assert df.where((c1 != F.col("a")) | (c2 != F.col("b"))).count() == 0
    assert df.select("code").distinct().count() == 289
    assert spark.range(1).select(K.transition(F.lit(9), F.lit(0)).alias("x")).first().x is None


def test_unmapped_class_is_an_error(spark):
    with pytest.raises(Exception, match="no class for"):
        spark.range(3).select(K.lookup(F.col("id").cast("int"), {0: 1, 1: 1}, strict=True)).collect()


def test_groups_are_apart(spark):
    df = spark.createDataFrame(list(itertools.product(range(1, 18), repeat=2)), "a int, b int")
    g = K.groups(F.col("a"), F.col("b"))
    main = [g[k].cast("int") for k in ("same", "snow", "soil_to_nonsoil", "nonsoil_to_soil")]
    n = df.select(sum(main[1:], main[0]).alias("n")).groupBy("n").count().collect()
    assert {r.n: r["count"] for r in n} == {0: 130, 1: 159}


# class 1, class 2, area, confidence, axis ratio, rectangularity, short axis, fill -> tag
CASES = [
    ((8, 8, 9, 0.5, 1, 1, 9, 1), 0), ((0, 8, 9, 0.5, 1, 1, 9, 1), 0), ((8, 1, 0.5, 0.5, 1, 1, 9, 1), 60), ((7, 8, 9, 0.5, 1, 1, 9, 1), 50), ((1, 2, 9, 0.5, 1, 1, 9, 1), 10),
    ((9, 2, 9, 0.07, 1, 1, 9, 1), 21), ((8, 1, 9, 0.5, 1, 0.9, 9, 1), 22), ((8, 17, 9, 0.5, 0.2, 0.9, 9, 1), 23), ((8, 1, 4, 0.5, 1, 0.9, 9, 1), 24), ((8, 1, 9, 0.5, 1, 0.7, 9, 1), 24),
    ((9, 2, 9, 0.5, 0.05, 1, 1, 1), 40), ((8, 2, 9, 0.5, 0.2, 1, 3, 1), 25), ((8, 5, 2600, 0.5, 1, 1, 60, 0.9), 26), ((8, 5, 2600, 0.5, 1, 1, 60, 0.7), 20),
    ((2, 9, 9, 0.07, 1, 1, 9, 1), 31), ((1, 8, 9, 0.5, 1, 0.9, 9, 1), 32), ((17, 8, 9, 0.5, 0.2, 0.9, 9, 1), 33), ((1, 8, 4, 0.5, 1, 0.9, 9, 1), 34), ((2, 8, 9, 0.5, 0.2, 1, 3, 1), 35),
    ((5, 8, 2600, 0.5, 1, 1, 60, 0.9), 36), ((2, 9, 9, 0.5, 1, 1, 9, 1), 30),
]


def test_all_tags(spark):
    df = spark.createDataFrame([(*map(float, c), t) for c, t in CASES], "a double, b double, area double, conf double, ratio double, rect double, short double, fill double, want int")
    got = df.withColumn("tag", changes.tag(F.col("a").cast("int"), F.col("b").cast("int"), *(F.col(k) for k in ("area", "conf", "ratio", "rect", "short", "fill")))).where("tag <> want").collect()
    assert not got
    assert {t for _, t in CASES} == set(K.TAG_NAMES)


def test_histogram_totals(spark):
    tags = spark.createDataFrame([(20,), (23,), (24,), (30,), (0,)], "tag int")
    assert changes.change_histogram(tags).first().soil_to_nonsoil == 3
    assert changes.change_histogram(tags, compat=True).first().soil_to_nonsoil == 3  # 20, and 23 twice
    assert changes.change_histogram(tags).first().nonsoil_to_soil == 1


def test_score_bins(spark):
    df = spark.createDataFrame([(0.0, 0), (0.25, 250), (0.26, 251), (0.3, 251), (0.35, 252), (0.5, 253), (0.7, 254), (1.0, 255), (1.5, 0), (-1.0, 0)], "x double, want int")
    assert df.where(K.score_bins(F.col("x")) != F.col("want")).count() == 0
