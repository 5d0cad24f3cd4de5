"""Operators over frames: one row for each frame, pixels as a row-major array.

Frames are never exploded into a row for each pixel, except to take medians over many frames of a session, where the
sample is bounded (every 500th frame by default).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions import arrays, kernels
from framelake.functions.geometry import px_to_mm
from framelake.operators.temporal import velocities
from framelake.schema import TRUE_DEPTH
from framelake.session import share_code


def median_frame(frames: DataFrame, pixels: str = "px", by: str = "session", into: str = "bg", every: int = 1, order: str = "frame_idx") -> DataFrame:
    """The median over a session's frames of each pixel, from every so-manieth frame."""
    some = frames.where(F.col(order) % every == 0) if every > 1 else frames
    medians = some.select(by, F.posexplode(pixels).alias("q_i", "q_v")).groupBy(by, "q_i").agg(F.percentile("q_v", F.lit(0.5)).alias("q_m"))
    return medians.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("q_i", "q_m"))), lambda x: x["q_m"]).alias(into))


def true_depth(backgrounds: DataFrame, mask: Column, bg: str = "bg", by: str = "session") -> DataFrame:
    """Median of a background inside a mask."""
    inside = F.filter(F.zip_with(F.col(bg), mask, lambda v, m: F.when(m > 0, v)), lambda v: v.isNotNull())
    return backgrounds.select(by, F.explode(inside).alias("q_v")).groupBy(by).agg(F.percentile("q_v", F.lit(0.5)).alias("true_depth"))


def moments(frames: DataFrame, pixels: str, width: int) -> DataFrame:
    """Centroid, orientation (degrees, turning with the image's y axis down) and the two axis lengths of an image's mass; null without mass."""
    raw = {f"q_m{p}{q}": arrays.moment(F.col(pixels), width, p, q) for p, q in ((0, 0), (1, 0), (0, 1), (2, 0), (1, 1), (0, 2))}
    m = frames.withColumns(raw)
    c = F.col
    has = c("q_m00") > 0
    m = m.withColumns({"q_cx": F.when(has, c("q_m10") / c("q_m00")), "q_cy": F.when(has, c("q_m01") / c("q_m00"))})
    m = m.withColumns({"q_u20": c("q_m20") - c("q_cx") * c("q_m10"), "q_u02": c("q_m02") - c("q_cy") * c("q_m01"), "q_u11": c("q_m11") - c("q_cx") * c("q_m01")})
    num, den = 2 * c("q_u11"), c("q_u20") - c("q_u02")
    common = F.sqrt(num * num + den * den)
    axis = lambda sign: F.when(has, F.lit(2.0) * F.sqrt(F.lit(2.0)) * F.sqrt(F.greatest(F.lit(0.0), (c("q_u20") + c("q_u02") + sign * common)) / c("q_m00")))
    out = m.withColumns({"cx": c("q_cx"), "cy": c("q_cy"), "orientation": F.when(has, F.degrees(F.lit(-0.5) * F.atan2(num, den))), "major": axis(1), "minor": axis(-1)})
    return out.drop(*raw, "q_cx", "q_cy", "q_u20", "q_u02", "q_u11")


def contour_moments(points: Column) -> dict[str, Column]:
    """Moments of the area inside a closed contour, an array of structs (x, y), by Green's theorem: m00, m10, m01, m20, m11, m02."""
    n = F.size(points)
    after = lambda i: F.get(points, F.pmod(i + 1, n))

    def add(f) -> Column:
        return F.aggregate(F.transform(points, lambda p, i: f(p["x"], p["y"], after(i)["x"], after(i)["y"])), F.lit(0.0), lambda a, v: a + v)

    cross = lambda x0, y0, x1, y1: x0 * y1 - x1 * y0
    found = {
        "m00": add(lambda x0, y0, x1, y1: cross(x0, y0, x1, y1)) / 2,
        "m10": add(lambda x0, y0, x1, y1: cross(x0, y0, x1, y1) * (x0 + x1)) / 6,
        "m01": add(lambda x0, y0, x1, y1: cross(x0, y0, x1, y1) * (y0 + y1)) / 6,
        "m20": add(lambda x0, y0, x1, y1: cross(x0, y0, x1, y1) * (x0 * x0 + x0 * x1 + x1 * x1)) / 12,
        "m11": add(lambda x0, y0, x1, y1: cross(x0, y0, x1, y1) * (x0 * (2 * y0 + y1) + x1 * (y0 + 2 * y1))) / 24,
        "m02": add(lambda x0, y0, x1, y1: cross(x0, y0, x1, y1) * (y0 * y0 + y0 * y1 + y1 * y1)) / 12,
    }
    sign = F.when(found["m00"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return {k: v * sign for k, v in found.items()}


def scalars(features: DataFrame, pixels: str, low: float = 10, high: float = 100, depth: float = TRUE_DEPTH, by: str = "session", order: str = "frame_idx", chunk: int | None = None, corrected: bool = False) -> DataFrame:
    """The 17 scalars of each frame from cx, cy, orientation, major, minor and the frame's heights.

    Area in mm is by the mean linear scale unless ``corrected`` (product of both). Velocities start at 0 in each
    session, or in each chunk.
    """
    mx, my = px_to_mm(F.col("cx"), F.col("cy"), depth)
    sx, sy = px_to_mm(F.col("cx") + 1, F.col("cy") + 1, depth)
    out = features.withColumns({"centroid_x_px": F.col("cx"), "centroid_y_px": F.col("cy"), "centroid_x_mm": mx, "centroid_y_mm": my, "q_sx": F.abs(sx - mx), "q_sy": F.abs(sy - my)})
    seen = F.filter(pixels, lambda v: (v > low) & (v < high))
    out = out.withColumns({"area_px": arrays.count(F.col(pixels), low, high), "q_sum": F.aggregate(seen, F.lit(0.0), lambda a, v: a + v)})
    linear = (F.col("q_sx") + F.col("q_sy")) / 2
    out = out.withColumns(
        {
            "width_px": F.least("major", "minor"),
            "length_px": F.greatest("major", "minor"),
            "height_ave_mm": F.when(F.col("area_px") > 0, F.col("q_sum") / F.col("area_px")).otherwise(F.lit(0.0)),
            "area_mm": F.col("area_px") * (F.col("q_sx") * F.col("q_sy") if corrected else linear),
            "angle": F.radians("orientation"),
        }
    )
    out = out.withColumns({"width_mm": F.col("width_px") * F.col("q_sy"), "length_mm": F.col("length_px") * F.col("q_sx")}).drop("q_sx", "q_sy", "q_sum")
    out = velocities(out, "centroid_x_px", "centroid_y_px", "height_ave_mm", "px", by, order, chunk)
    return velocities(out, "centroid_x_mm", "centroid_y_mm", "height_ave_mm", "mm", by, order, chunk)


def rank_regions(regions: DataFrame, weights: tuple[float, float, float] = (1.0, 0.1, 1.0), by: str = "session") -> DataFrame:
    """Regions (area, extent, distance) in order: ranks by falling area, falling extent and rising distance, ties the highest, weighted.

    A session has few regions, so a session is one window.
    """
    from pyspark.sql import Window

    def rank(c: Column) -> Column:
        return F.count("*").over(Window.partitionBy(by).orderBy(c).rangeBetween(Window.unboundedPreceding, 0))

    ranked = regions.withColumns({"rank_area": rank(-F.col("area")), "rank_extent": rank(-F.col("extent")), "rank_distance": rank(F.col("distance"))})
    mean = (F.col("rank_area") * weights[0] + F.col("rank_extent") * weights[1] + F.col("rank_distance") * weights[2]) / 3
    ranked = ranked.withColumn("rank", mean)
    return ranked.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy("rank", "label")))


def kernel(frames: DataFrame, f, pixels: str, into: str, width: int, element: str = "double") -> DataFrame:
    """A numpy function of one image (height, width) over all frames, in Arrow batches. Only for what expressions can't say."""
    share_code(frames.sparkSession)

    @F.pandas_udf(T.ArrayType(T.IntegerType() if element == "int" else T.DoubleType()))
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([None if x is None else f(np.asarray(x, float).reshape(-1, width)).ravel() for x in part], index=part.index)

    return frames.withColumn(into, run(F.col(pixels)))


def median_blur(frames: DataFrame, pixels: str, into: str, width: int, size: int = 3) -> DataFrame:
    """Median of each pixel's square neighbourhood; edges repeat."""
    return kernel(frames, lambda im: kernels.median_blur(im, size), pixels, into, width)


def opened(frames: DataFrame, pixels: str, into: str, width: int, size: int = 3, rounds: int = 1) -> DataFrame:
    """Erosion then dilation with a square."""
    return kernel(frames, lambda im: kernels.opening(im, kernels.rectangle(size), rounds), pixels, into, width)


def largest_component(frames: DataFrame, mask: str, into: str, width: int) -> DataFrame:
    """1 in the largest 4-connected component of a mask, of equals the first in reading order."""
    return kernel(frames, lambda im: kernels.largest_component(im > 0).astype(np.int32), mask, into, width, "int")


def inpaint(frames: DataFrame, pixels: str, into: str, width: int, rounds: int = 100) -> DataFrame:
    """Zero pixels filled by diffusion from their neighbours."""
    return kernel(frames, lambda im: kernels.inpaint(im, im == 0, rounds), pixels, into, width)


def block_mean(pixels: Column, width: int, height: int, size: int) -> Column:
    """An image made smaller by the means of its square blocks."""
    rows, columns = height // size, width // size
    cells = F.sequence(F.lit(0), F.lit(rows * columns - 1))

    def mean(i: Column) -> Column:
        top, left = F.floor(i / columns).cast("int") * size, (i % columns) * size
        lines = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda r: F.slice(pixels, (top + r) * width + left + 1, F.lit(size))))
        return F.aggregate(lines, F.lit(0.0), lambda a, v: a + v) / (size * size)

    return F.transform(cells, mean)


def _columns(frames: DataFrame, f, columns: list[str], schema: str) -> DataFrame:
    """Adds columns that a numpy function makes of a row's values, in Arrow batches; ``schema`` is theirs as a struct."""
    share_code(frames.sparkSession)

    @F.pandas_udf(schema)
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [f(*values) for values in part.itertuples(index=False, name=None)]
            yield pd.DataFrame(rows, index=part.index, columns=names)

    names = [x.split(" ")[0].strip("`") for x in schema.split(", ")]
    return frames.withColumn("q_out", run(F.struct(*columns))).select(*(c for c in frames.columns if c not in names), "q_out.*")


def cropped_and_turned(frames: DataFrame, pixels: str, into: str, width: int, size: tuple[int, int] = (80, 80), cx: str = "cx", cy: str = "cy", angle: str = "angle") -> DataFrame:
    """A window about each frame's centre, turned by its angle; all 0 where the centre or angle is missing."""

    def f(px, x, y, a):
        ok = all(v is not None and np.isfinite(v) for v in (x, y, a))
        return (kernels.crop_and_rotate(np.asarray(px, float).reshape(-1, width), x, y, a, size).ravel() if ok else np.zeros(size[0] * size[1]),)

    return _columns(frames, f, [pixels, cx, cy, angle], f"{into} array<double>")


def uncropped(frames: DataFrame, pixels: str, into: str, size: tuple[int, int], shape: tuple[int, int], cx: str = "cx", cy: str = "cy", angle: str = "angle") -> DataFrame:
    """Turned windows back at their places in frames of a shape."""

    def f(px, x, y, a):
        ok = all(v is not None and np.isfinite(v) for v in (x, y, a))
        return (kernels.uncrop(np.asarray(px, float).reshape(size), x, y, a, shape).ravel() if ok else np.zeros(shape[0] * shape[1]),)

    return _columns(frames, f, [pixels, cx, cy, angle], f"{into} array<double>")


def cleaned(frames: DataFrame, pixels: str, into: str, width: int, blur: tuple[int, ...] = (3,), open_size: int = 9, erode: int = 0, temporal: int = 0, by: str = "session", order: str = "frame_idx") -> DataFrame:
    """Erosion, median blurs and opening of each frame, then a median over neighbouring frames of each pixel."""

    def f(im: np.ndarray) -> np.ndarray:
        out = kernels.erode(im, kernels.rectangle(erode)) if erode else im
        for size in blur:
            out = kernels.median_blur(out, size)
        return kernels.opening(out, kernels.ellipse(open_size)) if open_size else out

    out = kernel(frames, f, pixels, into, width)
    if not temporal:
        return out
    from framelake.operators.temporal import in_order

    half = temporal // 2
    around = F.collect_list(F.col(into)).over(in_order(by, order).rowsBetween(-half, half))
    out = out.withColumn("q_w", around)
    # beyond the ends frames count as 0
    zeros = F.lit(temporal) - F.size("q_w")
    places = F.sequence(F.lit(0), F.size(into) - 1)
    median = F.transform(places, lambda i: F.get(F.array_sort(F.concat(F.transform("q_w", lambda w: F.get(w, i)), F.array_repeat(F.lit(0.0), zeros))), F.lit(half)))
    return out.withColumn(into, median).drop("q_w")


def shape_features(frames: DataFrame, pixels: str, width: int, low: float, high: float = float("inf")) -> DataFrame:
    """Of each frame's largest component of pixels in (low, high): contour, and centroid, orientation and axes of the area inside it; null without one."""

    out = _contours(frames, pixels, width, low, high)
    m = contour_moments(F.col("contour"))
    out = out.withColumns({f"q_{k}": v for k, v in m.items()})
    c = F.col
    has = c("q_m00") > 0
    out = out.withColumns({"cx": F.when(has, c("q_m10") / c("q_m00")), "cy": F.when(has, c("q_m01") / c("q_m00"))})
    u20, u02, u11 = c("q_m20") - c("cx") * c("q_m10"), c("q_m02") - c("cy") * c("q_m01"), c("q_m11") - c("cx") * c("q_m01")
    num, den = 2 * u11, u20 - u02
    common = F.sqrt(num * num + den * den)
    axis = lambda s: F.when(has, F.lit(2.0) * F.sqrt(F.lit(2.0)) * F.sqrt(F.greatest(F.lit(0.0), (u20 + u02 + s * common) / c("q_m00"))))
    return out.withColumns({"orientation": F.when(has, F.degrees(F.lit(-0.5) * F.atan2(num, den))), "major": axis(1), "minor": axis(-1)}).drop(*(f"q_{k}" for k in m))


def _contours(frames: DataFrame, pixels: str, width: int, low: float, high: float) -> DataFrame:
    share_code(frames.sparkSession)
    point = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    schema = T.StructType([*(f for f in frames.schema.fields if f.name != "contour"), T.StructField("contour", T.ArrayType(point))])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            found = []
            for px in pdf[pixels]:
                image = np.asarray(px, float).reshape(-1, width)
                found.append([(float(x), float(y)) for x, y in kernels.outline(kernels.largest_component((image > low) & (image < high)))])
            yield pdf.assign(contour=found)

    return frames.drop("contour").mapInPandas(run, schema)
