"""Calibration: a session's background, floor plane, region of interest and depth."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions import kernels
from framelake.operators.pixels import median_frame
from framelake.session import share_code


def regions(image: np.ndarray, depth_range: tuple[float, float], tolerance: float, rounds: int, dilate: int, weights: tuple[float, float, float], seed: int) -> tuple[np.ndarray | None, list[np.ndarray]]:
    """The floor plane and regions of pixels near it, best first: ranks by area, extent and distance from the centre, weighted."""
    plane, away = kernels.plane_ransac(image, depth_range, rounds, tolerance, seed=seed)
    near = away < tolerance
    labels, props = kernels.components(near), kernels.region_properties(near)
    if not props:
        return plane, []
    highest = lambda v: np.array([(v <= x).sum() for x in v])  # noqa: E731  ranks, ties the highest
    rank = sum(w * highest(np.array([s * p[k] for p in props])) for w, k, s in zip(weights, ("area", "extent", "distance"), (-1, -1, 1), strict=True))
    out = []
    for i in np.argsort(rank, kind="stable"):
        mask = labels == props[i]["label"]
        if dilate:
            mask = kernels.dilate(mask.astype(float), kernels.rectangle(dilate)) > 0
        out.append(kernels.fill_holes(mask))
    return plane, out


def calibrate(frames: DataFrame, width: int, every: int = 500, depth_range: tuple[float, float] = (650, 750), tolerance: float = 30, rounds: int = 1000, dilate: int = 15, weights: tuple[float, float, float] = (1.0, 0.1, 1.0), index: int = 0, seed: int = 0) -> DataFrame:
    """(session, bg, plane, roi, true_depth): one row for each session. Only backgrounds, one for each session, reach Python."""
    share_code(frames.sparkSession)
    background = median_frame(frames, "px", "session", "bg", every)

    def run(parts):
        for pdf in parts:
            rows = []
            for session, bg in zip(pdf["session"], pdf["bg"], strict=True):
                image = np.asarray(bg, float).reshape(-1, width)
                plane, found = regions(image, depth_range, tolerance, rounds, dilate, weights, seed)
                roi = found[min(index, len(found) - 1)] if found else np.ones(image.shape, bool)
                rows.append((session, np.asarray(bg, float), plane if plane is not None else None, roi.ravel().astype(np.int32), float(np.median(image[roi]))))
            yield pd.DataFrame(rows, columns=["session", "bg", "plane", "roi", "true_depth"])

    kind = background.schema["session"].dataType.simpleString()
    return background.select("session", "bg").mapInPandas(run, f"session {kind}, bg array<double>, plane array<double>, roi array<int>, true_depth double")


def inside(frames: DataFrame, calibration: DataFrame) -> DataFrame:
    """Frames with 0 outside their session's region."""
    roi = calibration.select("session", "roi")
    return frames.join(roi, "session").withColumn("px", F.zip_with("px", "roi", lambda p, m: F.when(m > 0, p).otherwise(F.lit(0)))).drop("roi")
