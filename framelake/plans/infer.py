"""Instances from a model that the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from framelake.functions import kernels
from framelake.session import share_code

INSTANCE = [
    T.StructField("instance", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("box", T.ArrayType(T.DoubleType())),
    T.StructField("mask", T.ArrayType(T.IntegerType())), T.StructField("keypoints", T.ArrayType(T.ArrayType(T.DoubleType()))),
]


def infer(frames: DataFrame, load: Callable[[], Callable[[list[np.ndarray]], list[list[dict]]]], width: int, pixels: str = "px", batch: int = 10) -> DataFrame:
    """A row for each instance that a model finds in each frame: score, box, mask and keypoints.

    ``load`` makes the model once in each task; the model takes a batch of images and gives each one's instances as
    dictionaries with score, box (x0, y0, x1, y1), mask (image) and keypoints (n x 3), best first.
    """
    share_code(frames.sparkSession)
    keys = [f for f in frames.schema.fields if f.name in ("session", "frame_idx")]
    schema = T.StructType([*keys, *INSTANCE])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in parts:
            rows = []
            for a in range(0, len(pdf), batch):
                part = pdf.iloc[a : a + batch]
                images = [np.asarray(x, float).reshape(-1, width) for x in part[pixels]]
                for key, found in zip(part[["session", "frame_idx"]].itertuples(index=False, name=None), model(images), strict=True):
                    rows += [(*key, i, float(x["score"]), [float(v) for v in x["box"]], np.asarray(x["mask"]).astype(int).ravel().tolist(), np.asarray(x["keypoints"], float).tolist()) for i, x in enumerate(found)]
            yield pd.DataFrame(rows, columns=schema.names)

    return frames.select("session", "frame_idx", pixels).mapInPandas(run, schema)


def threshold_model(low: float) -> Callable[[], Callable[[list[np.ndarray]], list[list[dict]]]]:
    """A stand-in without weights: the largest component over a threshold, its box, and keypoints along the box's longer side."""

    def load():
        def model(images: list[np.ndarray]) -> list[list[dict]]:
            out = []
            for im in images:
                mask = kernels.largest_component(im > low)
                at = np.argwhere(mask)
                if not len(at):
                    out.append([])
                    continue
                (y0, x0), (y1, x1) = at.min(axis=0), at.max(axis=0)
                t = np.linspace(0, 1, 8)
                out.append([{"score": float(mask.mean()), "box": (x0, y0, x1, y1), "mask": mask, "keypoints": np.column_stack([x0 + t * (x1 - x0), y0 + t * (y1 - y0), np.ones(8)])}])
            return out

        return model

    return load
