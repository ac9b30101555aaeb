"""Change detection between two dates: transitions, regions' descriptors and rule-based tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import groups, transition


def transitions(px: DataFrame, first: str = "y1", second: str = "y2") -> DataFrame:
    return px.withColumn("code", transition(F.col(first), F.col(second)))


def tag(c1: Column, c2: Column, area_m2: Column, conf: Column, axis_ratio: Column, rect: Column, short_axis: Column, fill: Column) -> Column:
    """The tag of a region that changed from c1 to c2; 0 if it didn't, or if a class is missing.

    conf: the lesser of both dates' mean confidences; axis_ratio and short_axis of the smallest rectangle around the
    region; rect its share of that rectangle; fill its share of the bounding box."""
    g = groups(c1, c2)
    thin = (axis_ratio < 0.1) & (short_axis < 2)
    tilted = (axis_ratio < 0.3) | (rect < 0.4)

    def ladder(built: Column, edge: Column, water: Column, base: int) -> Column:
        building = F.when(tilted, base + 3).when((rect > 0.8) & (area_m2 > 5), base + 2).otherwise(base + 4)
        return F.when(conf < 0.075, base + 1).when(built, building).when(thin, 40).when(edge & tilted & (short_axis < 4), base + 5).when(water & (fill > 0.8) & (area_m2 > 2500), base + 6).otherwise(base)

    found = (
        F.when(g["same"], 0).when(area_m2 < 1, 60).when(g["snow"], 50)
        .when(g["soil_to_nonsoil"], ladder(g["soil_to_building"], g["vege_to_nonsoil"], g["vege_to_water"], 20))
        .when(g["nonsoil_to_soil"], ladder(g["building_to_soil"], g["nonsoil_to_vege"], g["water_to_vege"], 30)).otherwise(10)
    )
    return F.when((c1 > 0) & (c2 > 0), found).otherwise(0).cast("int")


def region_stats(px: DataFrame, keys: list[str], edge_dm: str = "px_dm", conf: list[str] | None = None) -> DataFrame:
    """For each region (keys): pixels, bounding box, area, fill of the box, axes of the box, mean of each confidence."""
    means = [F.avg(c).alias(f"mean_{c}") for c in conf or []]
    s = px.groupBy(*keys).agg(F.count("*").alias("n_px"), F.min("r").alias("rmin"), F.max("r").alias("rmax"), F.min("c").alias("cmin"), F.max("c").alias("cmax"), F.max(edge_dm).alias("edge"), *means)
    h, w = F.col("rmax") - F.col("rmin") + 1, F.col("cmax") - F.col("cmin") + 1
    return s.select(*keys, "n_px", "rmin", "rmax", "cmin", "cmax", (F.col("n_px") * F.col("edge") * F.col("edge") / 100.0).alias("area_m2"), (F.col("n_px") / (h * w)).alias("fill"), (F.greatest(h, w) * F.col("edge") / 10.0).alias("long_axis"), (F.least(h, w) * F.col("edge") / 10.0).alias("short_axis"), *(f"mean_{c}" for c in conf or []))


def change_histogram(tags: DataFrame, compat: bool = False) -> DataFrame:
    """tag, n, and the totals of both directions on each row; compat counts the first without tag 24 and tag 23 twice."""
    n = tags.groupBy("tag").agg(F.count("*").alias("n"))
    soil = F.when(F.col("tag").between(20, 26), F.col("n"))
    if compat:
        soil = F.when(F.col("tag") == 24, 0).when(F.col("tag") == 23, 2 * F.col("n")).otherwise(soil)
    totals = n.agg(F.coalesce(F.sum(soil), F.lit(0)).alias("soil_to_nonsoil"), F.coalesce(F.sum(F.when(F.col("tag").between(30, 36), F.col("n"))), F.lit(0)).alias("nonsoil_to_soil"))
    return n.crossJoin(F.broadcast(totals))
