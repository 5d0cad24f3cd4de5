"""Images as row-major arrays: column expressions over one frame's pixels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def invalid(pixels: Column) -> Column:
    """1 where a pixel has no depth (0)."""
    return F.transform(pixels, lambda p: F.when(p == 0, F.lit(1)).otherwise(F.lit(0)))


def prepare(pixels: Column, background: Column, low: float, high: float) -> Column:
    """Height over the background: under ``low`` it is 0, over ``high`` it is ``high``."""
    return F.transform(F.zip_with(background, pixels, lambda b, p: b - p), lambda v: F.when(v < low, F.lit(0.0)).when(v > high, F.lit(float(high))).otherwise(v.cast("double")))


def scale(pixels: Column, low: float, high: float, to_low: int = 0, to_high: int = 255) -> Column:
    """Linear change of range, cut off to integers."""
    return F.transform(pixels, lambda v: F.floor((v - F.lit(float(low))) * F.lit((to_high - to_low) / (high - low)) + F.lit(float(to_low))).cast("int"))


def rotate_180(pixels: Column) -> Column:
    """Half a turn of a row-major image is its reverse."""
    return F.reverse(pixels)


def flip_rows(pixels: Column, width: int, height: int) -> Column:
    """Rows in reverse order."""
    return F.flatten(F.transform(F.sequence(F.lit(height - 1), F.lit(0), F.lit(-1)), lambda r: F.slice(pixels, r * width + 1, width)))


def crop(pixels: Column, width: int, y0: Column, y1: Column, x0: Column, x1: Column) -> Column:
    """Rows [y0, y1) and columns [x0, x1) as a row-major array; empty if either range is."""
    rows = F.when(y1 > y0, F.sequence(y0, y1 - 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(rows, lambda r: F.slice(pixels, r * width + x0 + 1, F.greatest(x1 - x0, F.lit(0)))))


def bbox(mask: Column, width: int) -> Column:
    """(y0, x0, y1, x1) of the pixels above 0, null if there are none."""
    on = F.filter(F.transform(mask, lambda m, i: F.when(m > 0, i)), lambda i: i.isNotNull())
    rows, columns = F.transform(on, lambda i: F.floor(i / width).cast("int")), F.transform(on, lambda i: i % width)
    return F.when(F.size(on) > 0, F.struct(F.array_min(rows).alias("y0"), F.array_min(columns).alias("x0"), F.array_max(rows).alias("y1"), F.array_max(columns).alias("x1")))


def apply_mask(pixels: Column, mask: Column) -> Column:
    return F.zip_with(pixels, mask, lambda p, m: F.when(m > 0, p).otherwise(F.lit(0).cast("double")))


def blend_max(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.greatest(x, y))


def blend_over(a: Column, b: Column, threshold: float) -> Column:
    """``b`` where it is above a threshold, else ``a``."""
    return F.zip_with(a, b, lambda x, y: F.when(y > threshold, y).otherwise(x))


def count(pixels: Column, low: float, high: float) -> Column:
    """Pixels strictly between two values."""
    return F.size(F.filter(pixels, lambda v: (v > low) & (v < high)))


def total(pixels: Column) -> Column:
    return F.aggregate(pixels, F.lit(0.0), lambda a, v: a + v)


def moment(pixels: Column, width: int, p: int, q: int) -> Column:
    """Raw image moment: the sum of v * x**p * y**q."""
    power = lambda v, n: F.lit(1.0) if n == 0 else v if n == 1 else v * v
    return total(F.transform(pixels, lambda v, i: v * power((i % width).cast("double"), p) * power(F.floor(i / width).cast("double"), q)))


def ring(width: int, height: int, cx: float, cy: float, radius: float, thickness: float | None = None) -> Column:
    """A disc of a radius, or its rim of a thickness, as a 0/1 array."""
    cells = F.sequence(F.lit(0), F.lit(width * height - 1))

    def inside(i: Column) -> Column:
        d = F.sqrt(F.pow(i % width - F.lit(cx), 2) + F.pow(F.floor(i / width) - F.lit(cy), 2))
        hit = d <= radius
        return (hit if thickness is None else hit & (d >= radius - thickness)).cast("int")

    return F.transform(cells, inside)
