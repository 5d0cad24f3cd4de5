"""False colours as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = 256

# fixed values: points (position, intensity) of the ramp from blue over green to red, channel by channel
JET = {
    "r": [(0.0, 0.0), (0.35, 0.0), (0.66, 1.0), (0.89, 1.0), (1.0, 0.5)],
    "g": [(0.0, 0.0), (0.125, 0.0), (0.375, 1.0), (0.64, 1.0), (0.91, 0.0), (1.0, 0.0)],
    "b": [(0.0, 0.5), (0.11, 1.0), (0.34, 1.0), (0.65, 0.0), (1.0, 0.0)],
}


def ramp(x: Column, points: list[tuple[float, float]]) -> Column:
    """Straight lines between points."""
    out = F.lit(points[-1][1])
    for (x0, y0), (x1, y1) in reversed(list(zip(points, points[1:], strict=False))):
        out = F.when(x < x1, F.lit(y0) + (x - x0) * F.lit((y1 - y0) / (x1 - x0))).otherwise(out)
    return out


def colourise(px: Column, low: float = 0.0, high: float = 100.0, points: dict[str, list[tuple[float, float]]] = JET) -> Column:
    """An array of structs (r, g, b) of 0 to 255: numbers cut to [low, high] and looked up at one of LEVELS steps."""

    def one(v: Column) -> Column:
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v.cast("double") - low) / (high - low)))
        step = F.least(F.floor(share * LEVELS), F.lit(LEVELS - 1)) / F.lit(LEVELS - 1.0)
        return F.struct(*(F.floor(ramp(step, points[c]) * 255).cast("int").alias(c) for c in "rgb"))

    return F.transform(px, one)
