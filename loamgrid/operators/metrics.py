"""Evaluation of predictions: confusion matrices and what follows from them.

Everything after the confusion matrix works on at most n * n rows. The matrix itself is a partial and final count by
(label, prediction), so a class of most pixels meets no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(px: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None, n: int | None = None) -> DataFrame:
    """label, pred, n for each pair that occurs; pairs outside of 0..n-1 are left out. px has both columns."""
    pairs = px.select(*(by or []), F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("pred"))
    if n is not None:
        pairs = pairs.where(F.col("label").between(0, n - 1) & F.col("pred").between(0, n - 1))
    return pairs.groupBy(*(by or []), "label", "pred").agg(F.count("*").alias("n"))


def dense(cm: DataFrame, classes: int) -> DataFrame:
    """All classes * classes pairs, 0 where none occurs."""
    ids = cm.sparkSession.range(classes).select(F.col("id").cast("int").alias("label"))
    grid = ids.crossJoin(ids.withColumnRenamed("label", "pred"))  # classes ** 2 rows, a constant
    return grid.join(cm, ["label", "pred"], "left").select("label", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def percentages(cm: DataFrame, digits: int = 2) -> DataFrame:
    total = cm.agg(F.sum("n").alias("total"))
    return cm.crossJoin(F.broadcast(total)).select("label", "pred", F.round(100 * F.col("n") / F.col("total"), digits).alias("percent"))


def _rates(tp: Column, label: Column, pred: Column, empty: Column) -> dict[str, Column]:
    return {
        "precision": F.coalesce(F.try_divide(tp, pred), empty), "recall": F.coalesce(F.try_divide(tp, label), empty),
        "f1": F.coalesce(F.try_divide(2 * tp, label + pred), empty), "iou": F.coalesce(F.try_divide(tp, label + pred - tp), empty),
    }


def class_metrics(cm: DataFrame, by: list[str] | None = None, zero: bool = True) -> DataFrame:
    """class_id, precision, recall, f1, iou, population and its percentage. Without a denominator 0, or null if not zero."""
    keys = by or []
    sides = cm.select(*keys, F.col("label").alias("class_id"), F.col("n").alias("rows"), F.lit(0).cast("long").alias("cols"), F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0).alias("tp"))
    sides = sides.unionByName(cm.select(*keys, F.col("pred").alias("class_id"), F.lit(0).cast("long").alias("rows"), F.col("n").alias("cols"), F.lit(0).cast("long").alias("tp")))
    sums = sides.groupBy(*keys, "class_id").agg(*(F.sum(k).alias(k) for k in ("rows", "cols", "tp")))
    total = F.sum("rows").over(Window.partitionBy(*keys)) if keys else F.sum("rows").over(Window.partitionBy(F.lit(0)))
    rates = _rates(F.col("tp").cast("double"), F.col("rows"), F.col("cols"), F.lit(0.0) if zero else F.lit(None))
    return sums.select(*keys, "class_id", *(e.alias(k) for k, e in rates.items()), F.col("rows").alias("population"), (100 * F.col("rows") / total).alias("population_pct"))


def matthews(correct: Column, total: Column, products: Column, rows2: Column, cols2: Column) -> Column:
    """Multiclass Matthews correlation from sums; 0 without a denominator."""
    under = F.sqrt((total * total - rows2) * (total * total - cols2))
    return F.coalesce(F.try_divide(correct * total - products, under), F.lit(0.0))


def macro_metrics(cm: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Means over the classes but 0, Matthews correlation without class 0, and accuracy with it."""
    keys = by or []
    means = class_metrics(cm, keys).where("class_id <> 0").groupBy(*keys).agg(*(F.avg(k).alias(f"mean_{k}") for k in ("precision", "recall", "f1", "iou")))
    all_ = cm.groupBy(*keys).agg((F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    inner = cm.where("label <> 0 AND pred <> 0")
    sums = inner.select(*keys, F.col("label").alias("k"), F.col("n").alias("a"), F.lit(0).alias("b")).unionByName(inner.select(*keys, F.col("pred").alias("k"), F.lit(0).alias("a"), F.col("n").alias("b")))
    sums = sums.groupBy(*keys, "k").agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))
    parts = sums.groupBy(*keys).agg(F.sum("a").alias("s"), F.sum(F.col("a") * F.col("b")).alias("ab"), F.sum(F.col("a") ** 2).alias("aa"), F.sum(F.col("b") ** 2).alias("bb"))
    right = inner.groupBy(*keys).agg(F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)).cast("double").alias("correct"))
    both = parts.join(right, keys) if keys else parts.crossJoin(right)  # one row each
    mcc = both.select(*keys, matthews(F.col("correct"), F.col("s"), F.col("ab"), F.col("aa"), F.col("bb")).alias("mcc"))
    if keys:
        return means.join(all_, keys).join(mcc, keys)
    return means.crossJoin(all_).crossJoin(mcc)


def tile_iou(px: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """tile_id, class_id, iou for each class of each tile."""
    return class_metrics(confusion(px, label, pred, by=["tile_id"]), ["tile_id"], zero=False).select("tile_id", "class_id", "iou")


def one_vs_rest(cm: DataFrame, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn of each class that occurs."""
    keys = by or []
    m = class_metrics(cm, keys).select(*keys, "class_id")
    total = cm.groupBy(*keys).agg(F.sum("n").alias("total"))
    crossed = m.join(cm, keys) if keys else m.crossJoin(cm)  # classes ** 3 rows
    same = lambda c: F.col(c) == F.col("class_id")
    sums = crossed.groupBy(*keys, "class_id").agg(
        F.sum(F.when(same("label") & same("pred"), F.col("n")).otherwise(0)).alias("tp"), F.sum(F.when(~same("label") & same("pred"), F.col("n")).otherwise(0)).alias("fp"),
        F.sum(F.when(same("label") & ~same("pred"), F.col("n")).otherwise(0)).alias("fn"),
    )
    joined = sums.join(total, keys) if keys else sums.crossJoin(total)
    return joined.select(*keys, "class_id", "tp", "fp", "fn", (F.col("total") - F.col("tp") - F.col("fp") - F.col("fn")).alias("tn"))


def ovr_metrics(counts: DataFrame, by: list[str] | None = None, digits: int = 3) -> DataFrame:
    """Rates of one-vs-rest counts, null where there is no denominator, rounded."""
    tp, fp, fn, tn = (F.col(k).cast("double") for k in ("tp", "fp", "fn", "tn"))
    mcc = F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
    out = {"precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, tp + fn), "f1": F.try_divide(2 * tp, 2 * tp + fp + fn), "iou": F.try_divide(tp, tp + fp + fn), "mcc": mcc}
    return counts.select(*(by or []), "class_id", *(F.round(e, digits).alias(k) for k, e in out.items()))


def normalized(cm: DataFrame) -> DataFrame:
    rows, cols = Window.partitionBy("label"), Window.partitionBy("pred")
    return cm.select("label", "pred", (F.col("n") / F.sum("n").over(rows)).alias("of_label"), (F.col("n") / F.sum("n").over(cols)).alias("of_pred"))


def class_shares(px: DataFrame, dataset: str, cls: str, nodata: int = 0, whole: str = "gt") -> DataFrame:
    """dataset, cls, n, share for each dataset, and over all under the name `whole`; nodata isn't counted."""
    counted = px.where(F.col(cls) != nodata).select(F.col(dataset).cast("string").alias("d"), F.col(cls).alias("cls"))
    sets = counted.groupingSets([["d", "cls"], ["cls"]], "d", "cls").agg(F.count("*").alias("n"), F.grouping("d").alias("g"))
    named = sets.select(F.when(F.col("g") == 1, F.lit(whole)).otherwise(F.col("d")).alias("dataset"), "cls", "n")
    return named.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("dataset")))


THRESHOLDS = [k * 125 for k in range(14)] + [k * 1000 for k in range(2, 11)]  # in ten-thousandths: 0 to 0.1625, 0.2 to 1


def by_threshold(px: DataFrame, label: str, pred: str, conf: str, scale: int = 1000, thresholds: list[int] | None = None) -> DataFrame:
    """threshold, tile_id, n, accuracy of the pixels with conf / scale >= threshold; one row for each with a pixel.

    Pixels are first counted by tile, confidence and match: the thresholds meet counts, not pixels."""
    counts = px.groupBy("tile_id", F.col(conf).alias("conf")).agg(F.count("*").alias("n"), F.sum((F.col(label) == F.col(pred)).cast("long")).alias("hits"))
    each = counts.withColumn("t", F.explode(F.array(*map(F.lit, thresholds or THRESHOLDS)))).where(F.col("conf") * 10_000 >= F.col("t") * scale)
    sums = each.groupBy("t", "tile_id").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return sums.select((F.col("t") / 10_000).alias("threshold"), "tile_id", "n", (F.col("hits") / F.col("n")).alias("accuracy"), "hits")


def threshold_stats(accuracies: DataFrame) -> DataFrame:
    """For each threshold the tiles' accuracies: min, max, mean, median, standard deviation; pixels and pooled accuracy."""
    a = F.col("accuracy")
    return accuracies.groupBy("threshold").agg(
        F.sum("n").alias("n_pixels"), (F.sum("hits") / F.sum("n")).alias("pooled"), F.avg(a).alias("mean"), F.percentile(a, F.lit(0.5)).alias("median"), F.stddev_pop(a).alias("std"), F.min(a).alias("min"), F.max(a).alias("max"),
    )
