"""Class schemes, reclassification maps and groups of class transitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Class ids, names and maps of the land-cover schemes.
CLASSES = ["no_data", "building", "non-concrete anthropogenic surface", "surface in concrete", "bare rock", "natural water", "reed", "snow", "soil with vegetation", "vineyard and orchard", "agricultural land", "tarp", "temporary greenhouse", "permanent greenhouse", "green roof", "basin", "synthetic lawn", "eave"]
SUPERCLASSES = ["no_data", "non-soil", "soil", "water", "uncertain"]
TO_SUPERCLASS = {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 3, 6: 1, 7: 4, 8: 2, 9: 2, 10: 2, 11: 2, 12: 2, 13: 1, 14: 1, 15: 3, 16: 1, 17: 1}
SOIL = [8, 9, 10, 11, 12]
NON_SOIL = [1, 2, 3, 4, 5, 6, 7, 13, 14, 15, 16]
N_CLASSES, SNOW, VEGETATION, WATER, BUILDINGS = 17, 7, 8, 5, (1, 17)
TAG_NAMES = {0: "no class change", 10: "no superclass change", 20: "soil to non-soil", 21: "low confidence soil to non-soil", 22: "construction, soil to building", 23: "tilt, soil to building", 24: "other transitions soil to building", 25: "vegetation hover/tilt to non-soil", 26: "vegetation to water artefacts", 30: "non-soil to soil", 31: "low confidence non-soil to soil", 32: "deconstruction, building to soil", 33: "tilt building, building to soil", 34: "other transitions building to soil", 35: "non-soil to vegetation hover/tilt", 36: "water to vegetation artefacts", 40: "border", 50: "snow cover", 60: "noise"}


def lookup(col: Column, mapping: dict, strict: bool = False) -> Column:
    """The mapping's value; without one null, or an error if strict. Literals, so the plan has no join and no UDF."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.try_element_at(pairs, col)
    if not strict:
        return found
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no class for "), col.cast("string"))).cast("int"))


def transition(c1: Column, c2: Column) -> Column:
    """(c1 - 1) * 17 + c2; a class that is null or 0 gives null, as codes with 0 would fall on other classes' codes."""
    return F.when((c1 > 0) & (c2 > 0), (c1 - 1) * N_CLASSES + c2).cast("int")


def decode(code: Column) -> tuple[Column, Column]:
    return (F.floor((code - 1) / N_CLASSES) + 1).cast("int"), (F.pmod(code - 1, F.lit(N_CLASSES)) + 1).cast("int")


def _non_soil(c: Column) -> Column:
    return c.isin(*range(1, 7), *range(13, 18))


def groups(c1: Column, c2: Column) -> dict[str, Column]:
    """Named groups of transitions, as predicates over both classes."""
    soil1, soil2, non1, non2 = c1.isin(SOIL), c2.isin(SOIL), _non_soil(c1), _non_soil(c2)
    built1, built2 = c1.isin(*BUILDINGS), c2.isin(*BUILDINGS)
    return {
        "same": c1 == c2,
        "snow": (c1 == SNOW) != (c2 == SNOW),
        "soil_to_nonsoil": soil1 & non2,
        "nonsoil_to_soil": non1 & soil2,
        "soil_to_building": soil1 & built2,
        "building_to_soil": built1 & soil2,
        "vege_to_nonsoil": (c1 == VEGETATION) & non2 & ~built2,
        "nonsoil_to_vege": non1 & ~built1 & (c2 == VEGETATION),
        "water_to_vege": (c1 == WATER) & (c2 == VEGETATION),
        "vege_to_water": (c1 == VEGETATION) & (c2 == WATER),
    }


def class_table(spark: SparkSession) -> DataFrame:
    rows = [(k, name, TO_SUPERCLASS[k], SUPERCLASSES[TO_SUPERCLASS[k]], k in SOIL) for k, name in enumerate(CLASSES)]
    return spark.createDataFrame(rows, "class_id int, class_name string, superclass_id int, superclass_name string, is_soil boolean")


def score_bins(x: Column) -> Column:
    """Scores in 0 to 1 as 0 to 255: up to a quarter in 250 steps, then five wider bins; 32-bit arithmetic."""
    f = x.cast("float")
    edges = [(0.25, 0.3, 251), (0.3, 0.4, 252), (0.4, 0.6, 253), (0.6, 0.8, 254), (0.8, 1.0, 255)]
    low = F.when((f >= 0) & (f <= F.lit(0.25).cast("float")), (f * F.lit(4.0).cast("float") * F.lit(250.0).cast("float")).cast("int"))
    return F.coalesce(reduce(lambda e, b: e.when((f > F.lit(b[0]).cast("float")) & (f <= F.lit(b[1]).cast("float")), F.lit(b[2])), edges, low), F.lit(0))


def softmax(logits: Column) -> Column:
    """Of an array; the greatest is taken off first."""
    top = F.array_max(logits)
    powers = F.transform(logits, lambda v: F.exp(v - top))
    return F.transform(powers, lambda v: v / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def argmax(values: Column) -> Column:
    """Index of the greatest value, the first of equal ones."""
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def margin(prob: Column) -> Column:
    """Distance of the best soil class's probability from the best non-soil class's; prob is indexed by class."""
    best = lambda ids: F.greatest(*[F.element_at(prob, k + 1) for k in ids])
    return F.abs(best(SOIL) - best(NON_SOIL))
