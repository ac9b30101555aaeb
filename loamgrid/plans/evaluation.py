"""Evaluation queries: confusion matrices, rates, shares, thresholds, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.classes import CLASSES, TO_SUPERCLASS, lookup
from ..operators import metrics as M
from ..sources.fixtures import PX_SQL, pixels
from .registry import query

CM = f"WITH {PX_SQL}, cm AS (SELECT y1 AS label, pred, count(*) AS n FROM px GROUP BY ALL)"
SIDES = """, s AS (SELECT class_id, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b, CAST(sum(tp) AS BIGINT) AS tp FROM (SELECT label AS class_id, n AS a, 0 AS b, CASE WHEN label = pred THEN n ELSE 0 END AS tp FROM cm UNION ALL SELECT pred, 0, n, 0 FROM cm) GROUP BY 1),
m AS (SELECT class_id, coalesce(CAST(tp AS DOUBLE) / nullif(b, 0), 0) AS precision, coalesce(CAST(tp AS DOUBLE) / nullif(a, 0), 0) AS recall, coalesce(2 * CAST(tp AS DOUBLE) / nullif(a + b, 0), 0) AS f1, coalesce(CAST(tp AS DOUBLE) / nullif(a + b - tp, 0), 0) AS iou, a AS population, 100 * CAST(a AS DOUBLE) / sum(a) OVER () AS population_pct FROM s)"""


def cm(spark, d):
    return M.confusion(pixels(spark, d), "y1", "pred")


def rounded(df, *keys, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in keys else F.col(c) for c, t in df.dtypes])


@query("ag1_confusion_matrix", CM + ", ids AS (SELECT CAST(range AS INT) AS k FROM range(18)) SELECT a.k AS label, b.k AS pred, coalesce(n, 0) AS n FROM ids a CROSS JOIN ids b LEFT JOIN cm ON label = a.k AND pred = b.k")
def confusion_matrix(spark, d):
    return M.dense(cm(spark, d), 18)


@query("ag2_cm_percent", CM + " SELECT label, pred, round(100.0 * n / sum(n) OVER (), 2) AS percent FROM cm")
def cm_percent(spark, d):
    return M.percentages(cm(spark, d))


CLASS_METRICS = CM + SIDES + " SELECT class_id, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(iou, 6) AS iou, population, round(population_pct, 6) AS population_pct FROM m"


@query("ag3_class_metrics", CLASS_METRICS)
def class_metrics(spark, d):
    return rounded(M.class_metrics(cm(spark, d)))


MACRO = """, i AS (SELECT * FROM cm WHERE label <> 0 AND pred <> 0), k AS (SELECT c, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(b) AS DOUBLE) AS b FROM (SELECT label AS c, n AS a, 0 AS b FROM i UNION ALL SELECT pred, 0, n FROM i) GROUP BY c),
t AS (SELECT sum(a) AS s, sum(a * b) AS ab, sum(a * a) AS aa, sum(b * b) AS bb FROM k), r AS (SELECT CAST(sum(CASE WHEN label = pred THEN n ELSE 0 END) AS DOUBLE) AS correct FROM i)"""


@query("ag4_ag5_macro_metrics", CM + SIDES + MACRO + " SELECT round((SELECT avg(precision) FROM m WHERE class_id <> 0), 6) AS mean_precision, round((SELECT avg(recall) FROM m WHERE class_id <> 0), 6) AS mean_recall, round((SELECT avg(f1) FROM m WHERE class_id <> 0), 6) AS mean_f1, round((SELECT avg(iou) FROM m WHERE class_id <> 0), 6) AS mean_iou, round((SELECT CAST(sum(CASE WHEN label = pred THEN n ELSE 0 END) AS DOUBLE) / sum(n) FROM cm), 6) AS accuracy, round(coalesce((correct * s - ab) / nullif(sqrt((s * s - aa) * (s * s - bb)), 0), 0), 6) AS mcc FROM t, r")
def macro_metrics(spark, d):
    return rounded(M.macro_metrics(cm(spark, d)))


@query("ag6_population", CM + SIDES + " SELECT class_id, population, round(population_pct, 6) AS population_pct FROM m")
def population(spark, d):
    return rounded(M.class_metrics(cm(spark, d))).select("class_id", "population", "population_pct")


OVR = CM + """, ids AS (SELECT DISTINCT label AS class_id FROM cm UNION SELECT pred FROM cm), o AS (SELECT class_id, CAST(sum(CASE WHEN label = class_id AND pred = class_id THEN n ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN label <> class_id AND pred = class_id THEN n ELSE 0 END) AS BIGINT) AS fp,
 CAST(sum(CASE WHEN label = class_id AND pred <> class_id THEN n ELSE 0 END) AS BIGINT) AS fn, CAST(sum(CASE WHEN label <> class_id AND pred <> class_id THEN n ELSE 0 END) AS BIGINT) AS tn FROM ids, cm GROUP BY class_id)"""


@query("ag7_ovr_counts", OVR + " SELECT class_id, tp, fp, fn, tn FROM o")
def ovr_counts(spark, d):
    return M.one_vs_rest(cm(spark, d))


@query("ag8_ovr_metrics", OVR + ", x AS (SELECT class_id, CAST(tp AS DOUBLE) tp, CAST(fp AS DOUBLE) fp, CAST(fn AS DOUBLE) fn, CAST(tn AS DOUBLE) tn FROM o) SELECT class_id, round(tp / nullif(tp + fp, 0), 3) AS precision, round(tp / nullif(tp + fn, 0), 3) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 3) AS f1, round(tp / nullif(tp + fp + fn, 0), 3) AS iou, round((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 3) AS mcc FROM x")
def ovr_metrics(spark, d):
    return M.ovr_metrics(M.one_vs_rest(cm(spark, d)))


@query("ag9_class_counts", f"WITH {PX_SQL} SELECT 'gt' AS data, y1 AS class_id, count(*) AS n FROM px GROUP BY ALL UNION ALL SELECT 'pred', pred, count(*) FROM px GROUP BY ALL")
def class_counts(spark, d):
    px = pixels(spark, d).select(F.explode(F.array(F.struct(F.lit("gt").alias("data"), F.col("y1").alias("class_id")), F.struct(F.lit("pred").alias("data"), F.col("pred").alias("class_id")))).alias("x"))
    return px.groupBy("x.data", "x.class_id").agg(F.count("*").alias("n"))


@query("ag10_norm_cm", CM + " SELECT label, pred, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY label), 6) AS of_label, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY pred), 6) AS of_pred FROM cm")
def norm_cm(spark, d):
    return rounded(M.normalized(cm(spark, d)))


@query("ag11_class_share_sets", f"WITH {PX_SQL}, g AS (SELECT coalesce(ds, 'gt') AS dataset, pred AS cls, count(*) AS n FROM (SELECT CAST(tile_id % 3 AS VARCHAR) AS ds, pred FROM px WHERE pred <> 0) GROUP BY GROUPING SETS ((ds, pred), (pred))) SELECT dataset, cls, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY dataset), 6) AS share FROM g")
def class_share_sets(spark, d):
    return rounded(M.class_shares(pixels(spark, d).withColumn("ds", F.col("tile_id") % 3), "ds", "pred"))


UAA = f"""WITH {PX_SQL}, t AS (SELECT range * 125 AS t FROM range(14) UNION ALL SELECT range * 1000 FROM range(2, 11)),
a AS (SELECT t / 10000.0 AS threshold, tile_id, count(*) AS n, CAST(sum(CASE WHEN y1 = pred THEN 1 ELSE 0 END) AS BIGINT) AS hits FROM px, t WHERE conf1_milli * 10000 >= t * 1000 GROUP BY t, tile_id),
u AS (SELECT CAST(threshold AS DOUBLE) AS threshold, tile_id, n, CAST(hits AS DOUBLE) / n AS accuracy, hits FROM a)"""


@query("ag13_uaa_by_threshold", UAA + " SELECT threshold, tile_id, n, round(accuracy, 6) AS accuracy, hits FROM u")
def uaa_by_threshold(spark, d):
    return rounded(M.by_threshold(pixels(spark, d), "y1", "pred", "conf1_milli"), "threshold")


@query("ag14_uaa_stats", UAA + " SELECT threshold, CAST(sum(n) AS BIGINT) AS n_pixels, round(CAST(sum(hits) AS DOUBLE) / sum(n), 6) AS pooled, round(avg(accuracy), 6) AS mean, round(median(accuracy), 6) AS median, round(stddev_pop(accuracy), 6) AS std, round(min(accuracy), 6) AS min, round(max(accuracy), 6) AS max FROM u GROUP BY threshold")
def uaa_stats(spark, d):
    return rounded(M.threshold_stats(M.by_threshold(pixels(spark, d), "y1", "pred", "conf1_milli")), "threshold")


@query("ag15_ag14_tile_iou", f"WITH {PX_SQL}, cm AS (SELECT tile_id, y1 AS label, pred, count(*) AS n FROM px GROUP BY ALL), s AS (SELECT tile_id, class_id, sum(a) AS a, sum(b) AS b, sum(tp) AS tp FROM (SELECT tile_id, label AS class_id, n AS a, 0 AS b, CASE WHEN label = pred THEN n ELSE 0 END AS tp FROM cm UNION ALL SELECT tile_id, pred, 0, n, 0 FROM cm) GROUP BY ALL) SELECT tile_id, class_id, round(CAST(tp AS DOUBLE) / nullif(a + b - tp, 0), 6) AS iou FROM s")
def tile_iou(spark, d):
    return rounded(M.tile_iou(pixels(spark, d), "y1", "pred"))


SUPER = "CASE {c} " + " ".join(f"WHEN {k} THEN {v}" for k, v in TO_SUPERCLASS.items()) + " END"


@query("pr2_superclass_metrics", f"WITH {PX_SQL}, cm AS (SELECT {SUPER.format(c='y1')} AS label, {SUPER.format(c='pred')} AS pred, count(*) AS n FROM px GROUP BY ALL)" + SIDES + " SELECT class_id, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(iou, 6) AS iou, population, round(population_pct, 6) AS population_pct FROM m")
def superclass_metrics(spark, d):
    px = pixels(spark, d)
    return rounded(M.class_metrics(M.confusion(px.select(lookup(F.col("y1"), TO_SUPERCLASS, strict=True).alias("label"), lookup(F.col("pred"), TO_SUPERCLASS, strict=True).alias("pred")))))


# a table of metrics by model and extent, as the exploration reports have it

TABLE = f"""WITH {PX_SQL}, cm AS (SELECT CAST(tile_id % 4 AS INT) AS arch, CAST(tile_id % 3 AS INT) AS extent, y1 AS label, pred, count(*) AS n FROM px GROUP BY ALL),
acc AS (SELECT concat('model', arch) AS arch, concat('extent', extent) AS extent, CAST(sum(CASE WHEN label = pred THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS accuracy, CAST(sum(n) AS BIGINT) AS n FROM cm GROUP BY ALL)"""


def metric_table(spark, d):
    px = pixels(spark, d).withColumns({"arch": F.concat(F.lit("model"), F.col("tile_id") % 4), "extent": F.concat(F.lit("extent"), F.col("tile_id") % 3)})
    c = M.confusion(px, "y1", "pred", by=["arch", "extent"])
    return c.groupBy("arch", "extent").agg((F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"), F.sum("n").alias("n"))


@query("ag19_metric_pivot", TABLE + " SELECT arch, round(max(CASE WHEN extent = 'extent0' THEN accuracy END), 6) AS extent0, round(max(CASE WHEN extent = 'extent1' THEN accuracy END), 6) AS extent1, round(max(CASE WHEN extent = 'extent2' THEN accuracy END), 6) AS extent2 FROM acc GROUP BY arch")
def metric_pivot(spark, d):
    t = metric_table(spark, d)
    return rounded(t.groupBy("arch").pivot("extent", ["extent0", "extent1", "extent2"]).agg(F.avg("accuracy")).orderBy("arch"))


@query("st6_metric_unpivot", TABLE + " SELECT arch, extent, 'accuracy' AS variable, round(accuracy, 6) AS value FROM acc UNION ALL SELECT arch, extent, 'n', CAST(n AS DOUBLE) FROM acc")
def metric_unpivot(spark, d):
    t = metric_table(spark, d).withColumn("n", F.col("n").cast("double"))
    return rounded(t.unpivot(["arch", "extent"], ["accuracy", "n"], "variable", "value"))


@query("sc10_metric_names", TABLE + ", f AS (SELECT concat(arch, '_inst_type_', extent, '_', n) AS name FROM acc) SELECT string_split(name, '_')[1] AS arch, string_split(name, '_')[4] AS extent, CAST(string_split(name, '_')[5] AS BIGINT) AS res FROM f")
def metric_names(spark, d):
    from ..sources.files import name_parts

    t = metric_table(spark, d).select(F.concat_ws("_", "arch", F.lit("inst"), F.lit("type"), "extent", "n").alias("name"))
    p = name_parts(F.col("name"), ["kind", "inst", "type", "extent", "res"])
    return t.select(p["kind"].alias("arch"), p["extent"].alias("extent"), p["res"].cast("bigint").alias("res"))


@query("fl2_report_filters", TABLE + " SELECT arch, extent, round(accuracy, 6) AS accuracy FROM acc WHERE contains(arch, 'model') AND extent IN ('extent0', 'extent2') AND n > 500")
def report_filters(spark, d):
    from .range_join import predicate

    return rounded(metric_table(spark, d).where(predicate("arch.str.contains('model') & extent in @wanted & n > @least", {"wanted": ["extent0", "extent2"], "least": 500})).select("arch", "extent", "accuracy"))


@query("so2_sorted_report", TABLE + " SELECT arch, extent, round(accuracy, 6) AS accuracy FROM acc ORDER BY accuracy DESC, arch, extent")
def sorted_report(spark, d):
    return rounded(metric_table(spark, d).orderBy(F.desc("accuracy"), "arch", "extent").select("arch", "extent", "accuracy"))


@query("ag18_split_class_counts", f"WITH {PX_SQL}, s AS (SELECT CASE WHEN tile_id % 5 < 3 THEN 'train' WHEN tile_id % 5 = 3 THEN 'val' ELSE 'test' END AS split, {SUPER.format(c='y1')} AS cls FROM px), n AS (SELECT cls, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val, count(*) FILTER (WHERE split = 'test') AS test FROM s GROUP BY cls) SELECT cls, train, val, test, round(CAST(train AS DOUBLE) / nullif(train + val + test, 0), 6) AS train_share FROM n")
def split_class_counts(spark, d):
    split = F.when(F.col("tile_id") % 5 < 3, "train").when(F.col("tile_id") % 5 == 3, "val").otherwise("test")
    s = pixels(spark, d).select(split.alias("split"), lookup(F.col("y1"), TO_SUPERCLASS).alias("cls"))
    n = s.groupBy("cls").pivot("split", ["train", "val", "test"]).count().na.fill(0)
    return n.withColumn("train_share", F.round(F.try_divide(F.col("train"), F.col("train") + F.col("val") + F.col("test")), 6))


@query("ag17_class_sets", f"WITH {PX_SQL} SELECT tile_id, count(DISTINCT y1) AS n_classes, count(*) FILTER (WHERE nullif(pred, 0) IS NULL) AS n_null FROM px GROUP BY tile_id")
def class_sets(spark, d):
    return pixels(spark, d).groupBy("tile_id").agg(F.size(F.collect_set("y1")).cast("long").alias("n_classes"), F.count_if(F.nullif("pred", F.lit(0)).isNull()).alias("n_null"))


WN8 = f"WITH {PX_SQL}, n AS (SELECT y1 AS cls, count(*) AS n FROM px GROUP BY y1), f AS (SELECT cls, n, CAST(n AS DOUBLE) / sum(n) OVER () AS share FROM n)"


def relative(spark, d):
    n = pixels(spark, d).groupBy(F.col("y1").alias("cls")).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("total")))).select("cls", "n", (F.col("n") / F.col("total")).alias("share"))


@query("wn8_relative_frequency", WN8 + " SELECT cls, n, round(share, 6) AS share FROM f")
def relative_frequency(spark, d):
    return rounded(relative(spark, d))


@query("wn9_small_categories", WN8 + " SELECT CASE WHEN share < 0.05 THEN 'Other' ELSE CAST(cls AS VARCHAR) END AS category, CAST(sum(n) AS BIGINT) AS n FROM f GROUP BY 1")
def small_categories(spark, d):
    return relative(spark, d).groupBy(F.when(F.col("share") < 0.05, "Other").otherwise(F.col("cls").cast("string")).alias("category")).agg(F.sum("n").alias("n"))


NAMES = "CASE {c} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(CLASSES)) + " END"


@query("ml5_class_table", "SELECT CAST(range AS INT) AS class_id, " + NAMES.format(c="range") + " AS class_name, CAST(" + SUPER.format(c="range") + " AS INT) AS superclass_id, CASE " + SUPER.format(c="range") + " WHEN 0 THEN 'no_data' WHEN 1 THEN 'non-soil' WHEN 2 THEN 'soil' WHEN 3 THEN 'water' ELSE 'uncertain' END AS superclass_name, range BETWEEN 8 AND 12 AS is_soil FROM range(18)")
def class_table(spark, d):
    from ..functions.classes import class_table as classes

    return classes(spark).select("class_id", "class_name", "superclass_id", "superclass_name", "is_soil")
