"""Axis-parallel boxes as four columns x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = ("x0", "y0", "x1", "y1")


def box(prefix: str = "") -> tuple[Column, ...]:
    return tuple(F.col(f"{prefix}{k}") for k in BOX)


def area(b: tuple[Column, ...]) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0)) * F.greatest(b[3] - b[1], F.lit(0))


def intersection(a: tuple[Column, ...], b: tuple[Column, ...]) -> tuple[Column, ...]:
    return F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])


def overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return area(intersection(a, b))


def intersects(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Touching counts."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def contains(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return (a[0] <= b[0]) & (a[1] <= b[1]) & (a[2] >= b[2]) & (a[3] >= b[3])


def grown(b: tuple[Column, ...], by: Column | float) -> tuple[Column, ...]:
    return b[0] - by, b[1] - by, b[2] + by, b[3] + by


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    both = overlap(a, b)
    return F.try_divide(both.cast("double"), area(a) + area(b) - both)


def angle(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Degrees between two vectors; null for a vector of length 0."""
    norm = F.sqrt((ax * ax + ay * ay) * (bx * bx + by * by))
    cosine = F.try_divide(ax * bx + ay * by, norm)
    return F.degrees(F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0))))


def cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return ax * by - ay * bx
