"""Angles, rotations and unit conversion as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelake.schema import FIELD_OF_VIEW, RESOLUTION, TRUE_DEPTH


def focal_length(axis: int, resolution: tuple[int, int] = RESOLUTION, field_of_view: tuple[float, float] = FIELD_OF_VIEW, corrected: bool = False) -> float:
    """Pixels per unit of slope. By default the half angle stands for its tangent; ``corrected`` uses the tangent."""
    half = math.radians(field_of_view[axis] / 2)
    return resolution[axis] / (2 * (math.tan(half) if corrected else half))


def px_to_mm(x: Column, y: Column, depth: float = TRUE_DEPTH, resolution: tuple[int, int] = RESOLUTION, corrected: bool = False) -> tuple[Column, Column]:
    """Millimetres from the optical axis of a point in pixels, at a depth."""
    at = lambda v, k: F.lit(depth) * (v - F.lit(resolution[k] // 2)) / F.lit(focal_length(k, resolution, corrected=corrected))
    return at(x, 0), at(y, 1)


def rotate(x: Column, y: Column, cx: Column, cy: Column, degrees: Column) -> tuple[Column, Column]:
    """A point turned by minus ``degrees`` about a centre."""
    a = F.radians(-degrees)
    dx, dy = x - cx, y - cy
    return F.cos(a) * dx - F.sin(a) * dy + cx, F.sin(a) * dx + F.cos(a) * dy + cy


def clamp_degrees(a: Column) -> Column:
    """Into [0, 360)."""
    return F.pmod(a, F.lit(360.0))


def clamp_radians(a: Column) -> Column:
    """Into [0, 2 pi)."""
    return F.pmod(a, F.lit(2 * math.pi))


def angle_difference(a: Column, b: Column) -> Column:
    """The smaller difference b - a of two angles in degrees, in (-180, 180]."""
    d = F.pmod(b - a, F.lit(360.0))
    return F.when(d > 180, d - 360).otherwise(d)


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1))


def box_iou(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """Intersection over union of two boxes (x0, y0, x1, y1); null if both are empty."""
    width = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    height = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    both = width * height
    area = lambda r: (r[2] - r[0]) * (r[3] - r[1])
    return F.try_divide(both, area(a) + area(b) - both)


def crosses(x: Column, y: Column, polygon: Column) -> Column:
    """Whether a point lies in a polygon, an array of structs (x, y), by the crossing number."""
    n = F.size(polygon)
    edges = F.transform(polygon, lambda p, i: F.struct(p["x"].alias("x0"), p["y"].alias("y0"), F.get(polygon, F.pmod(i + 1, n))["x"].alias("x1"), F.get(polygon, F.pmod(i + 1, n))["y"].alias("y1")))
    hit = lambda e: (((e["y0"] > y) != (e["y1"] > y)) & (x < (e["x1"] - e["x0"]) * (y - e["y0"]) / F.when(e["y1"] == e["y0"], F.lit(1.0)).otherwise(e["y1"] - e["y0"]) + e["x0"]))
    return F.size(F.filter(edges, hit)) % 2 == 1


def vertex_distance(x: Column, y: Column, polygon: Column) -> Column:
    """Distance of a point to the nearest vertex of a polygon."""
    return F.array_min(F.transform(polygon, lambda p: distance(p["x"], p["y"], x, y)))
