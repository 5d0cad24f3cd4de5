"""Instances and tracks: overlap, suppression, assignment over time."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions import kernels
from framelake.functions.geometry import box_iou, distance
from framelake.operators.batches import by_groups, starts_of
from framelake.session import share_code

FRAME = ["session", "frame_idx"]


def mask_iou(instances: DataFrame, mask: str = "mask", by: list[str] = FRAME) -> DataFrame:
    """Each two instances (a < b) of a frame with the overlap of their masks. A frame has a handful."""
    a = instances.select(*by, F.col("instance").alias("a"), F.col(mask).alias("ma"))
    b = instances.select(*by, F.col("instance").alias("b"), F.col(mask).alias("mb"))
    add = lambda x: F.aggregate(x, F.lit(0), lambda s, v: s + v)
    both, either = add(F.zip_with("ma", "mb", lambda x, y: F.least(x, y))), add(F.zip_with("ma", "mb", lambda x, y: F.greatest(x, y)))
    return a.join(b, by).where("a < b").select(*by, "a", "b", F.try_divide(both, either).alias("iou"))


def suppressed(instances: DataFrame, mask: str = "mask", score: str = "score", threshold: float = 0.5, corrected: bool = False, by: list[str] = FRAME) -> DataFrame:
    """Instances that stay after suppression by mask overlap, with their ``rank``; a frame is one group, of which a batch has many."""
    share_code(instances.sparkSession)
    schema = T.StructType([*instances.schema.fields, T.StructField("rank", T.IntegerType())])

    def run(t: pa.Table, ends: np.ndarray) -> pa.Table:
        masks = t.column(mask).combine_chunks()
        edges, values = masks.offsets.to_numpy(), masks.values.to_numpy(zero_copy_only=False)
        scores, take, rank = t.column(score).to_numpy(zero_copy_only=False).astype(float), [], []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            own = values[edges[a] : edges[b]].reshape(b - a, -1).astype(bool)
            kept = kernels.suppress(own, scores[a:b], threshold, corrected)
            take += [a + i for i in kept]
            rank += range(1, len(kept) + 1)
        return t.take(pa.array(take, pa.int64())).append_column("rank", pa.array(rank, pa.int32()))

    return by_groups(instances, by, ["instance"], run, schema)


def oldest(tracks: DataFrame, k: int, age: str = "age", live: Column | None = None, by: list[str] = FRAME) -> DataFrame:
    """The k oldest live tracks of each frame."""
    rows = tracks if live is None else tracks.where(live)
    w = Window.partitionBy(*by).orderBy(F.desc(age), "track")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class Tracker:
    """Nearest-detection tracks of one session, a frame at a time.

    A detection joins the nearest track within ``reach``; a track gains a hit for each frame with a detection, up to
    ``most_hits``, loses one for each without and ends at none. Pairs are joined nearest first.
    """

    def __init__(self, reach: float = 50.0, most_hits: int = 3, tracks: list[list[float]] | None = None, after: int = 0):
        self.reach, self.most_hits = reach, most_hits
        self.tracks = tracks or []  # [track, x, y, hits, age]
        self.after = after

    def step(self, points: list[tuple[float, float]]) -> list[tuple[int, int]]:
        """(track, age) for each detection."""
        pairs = sorted((math.hypot(t[1] - x, t[2] - y), i, j) for i, t in enumerate(self.tracks) for j, (x, y) in enumerate(points))
        used_t, used_p, out = set(), {}, []
        for d, i, j in pairs:
            if d <= self.reach and i not in used_t and j not in used_p:
                used_t.add(i)
                used_p[j] = i
        for i, t in enumerate(self.tracks):
            t[4] += 1
            t[3] = min(t[3] + 1, self.most_hits) if i in used_t else t[3] - 1
        for j, (x, y) in enumerate(points):
            if j not in used_p:
                self.tracks.append([self.after, x, y, 1, 0])
                used_p[j] = len(self.tracks) - 1
                self.after += 1
            t = self.tracks[used_p[j]]
            t[1], t[2] = x, y
            out.append((int(t[0]), int(t[4])))
        self.tracks = [t for t in self.tracks if t[3] > 0]
        return out


def tracked(detections: DataFrame, reach: float = 50.0, most_hits: int = 3, by: str = "session", order: str = "frame_idx") -> DataFrame:
    """Detections (instance, x, y) with their track and its age in frames. State runs through a session; a batch has many sessions."""
    share_code(detections.sparkSession)
    schema = T.StructType([*detections.schema.fields, T.StructField("track", T.IntegerType()), T.StructField("age", T.IntegerType())])

    def run(t: pa.Table, ends: np.ndarray) -> pa.Table:
        x, y = (t.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("x", "y"))
        frames = starts_of(t, [by, order]).tolist()
        fresh, found = set(ends.tolist()), []
        for a, b in zip(frames, [*frames[1:], t.num_rows], strict=True):
            if a in fresh:
                tracker = Tracker(reach, most_hits)
            found += tracker.step(list(zip(x[a:b], y[a:b], strict=True)))
        return t.append_column("track", pa.array([k for k, _ in found], pa.int32())).append_column("age", pa.array([n for _, n in found], pa.int32()))

    return by_groups(detections, [by], [order, "instance"], run, schema)


def instance_log(instances: DataFrame, box: str | None = "box", points: str | None = "points", by: list[str] = FRAME) -> DataFrame:
    """For each frame how alike its first two instances are, and all scores: box_iou, mask_jaccard and keypoint_distance.

    ``box`` is (x0, y0, x1, y1) and ``points`` an array of structs (x, y) in one order; the distance is the sum over the
    points. Frames with one instance have zeros; tables without boxes or points have none of that column.
    """
    use = {c: c in instances.columns for c in (box, points) if c}
    two = instances.where("instance < 2").select(*by, "instance", *(c for c, there in use.items() if there))
    side = lambda i, name: two.where(F.col("instance") == i).select(*by, *(F.col(c).alias(f"{name}_{c}") for c, there in use.items() if there))
    first = mask_iou(instances.where("instance < 2"), by=by).select(*by, F.col("iou").alias("mask_jaccard"))
    new = {}
    if use.get(box):
        corner = lambda name: tuple(F.get(f"{name}_{box}", F.lit(k)) for k in range(4))
        new["box_iou"] = box_iou(corner("a"), corner("b"))
    if use.get(points):
        apart = F.zip_with(f"a_{points}", f"b_{points}", lambda p, q: distance(p["x"], p["y"], q["x"], q["y"]))
        new["keypoint_distance"] = F.aggregate(apart, F.lit(0.0), lambda s, v: s + v)
    if new:
        first = first.join(side(0, "a").join(side(1, "b"), by).select(*by, *(v.alias(k) for k, v in new.items())), by)
    scores = instances.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("instance", "score"))), lambda s: s["score"]).alias("scores"))
    return scores.join(first, by, "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("mask_jaccard", *new)})


def smoothed(keypoints: DataFrame, parts: list[str], chunk: int = 1000, order_: int = 3, rounds: int = 10, keep: tuple[str, ...] = ("TailTip",), by: str = "session", order: str = "frame_idx") -> DataFrame:
    """Rows (part, x, y) smoothed by one Kalman tracker for each session, chunk by chunk; parts in ``keep`` move too fast and stay as they are.

    The state runs through the session in frame order, so a session is one group; chunks bound the smoother's memory.
    """
    from framelake.functions.kalman import PointTracker

    share_code(keypoints.sparkSession)
    schema = f"{by} {keypoints.schema[by].dataType.simpleString()}, {order} long, part string, x double, y double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot(index=order, columns="part", values=["x", "y"]).sort_index()
        points = np.stack([wide.reindex(columns=[(c, p) for p in parts]).to_numpy(float) for c in ("x", "y")], axis=2)
        tracker = PointTracker(len(parts), order_, rounds)
        out = np.concatenate([tracker.smooth(points[a : a + chunk]) for a in range(0, len(points), chunk)])
        for i, p in enumerate(parts):
            if p in keep:
                out[:, i] = points[:, i]
        frames = np.repeat(wide.index.to_numpy(), len(parts))
        return pd.DataFrame({by: pdf[by].iloc[0], order: frames, "part": parts * len(wide), "x": out[:, :, 0].ravel(), "y": out[:, :, 1].ravel()})

    return keypoints.select(by, order, "part", "x", "y").groupBy(by).applyInPandas(run, schema)


def corrected_angles(frames: DataFrame, angle: str = "angle", alignment: str = "score", flip: str = "flip", chunk: int = 1000, order_: int = 3, by: str = "session", order: str = "frame_idx") -> DataFrame:
    """Angles corrected by a tracker that runs through each session, with flips and the kind of correction.

    The state runs through a session in frame order, so a session is in one task; a task's sessions advance together.
    """
    from framelake.functions.kalman import correct_together

    share_code(frames.sparkSession)
    schema = T.StructType([frames.schema[by], T.StructField(order, T.LongType()), T.StructField("angle_out", T.DoubleType()), T.StructField("flip_out", T.BooleanType()), T.StructField("intervention", T.IntegerType())])

    def run(t: pa.Table, ends: np.ndarray) -> pa.Table:
        number = lambda c: t.column(c).to_numpy(zero_copy_only=False).astype(float)
        a, s, f = number(angle), number(alignment), np.asarray(t.column(flip).to_numpy(zero_copy_only=False), bool)
        found = correct_together([(a[x:y], s[x:y], f[x:y]) for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], chunk, order_)
        columns = [np.concatenate([x[i] for x in found]) for i in range(3)]
        return pa.table([t.column(by), t.column(order).cast(pa.int64()), *(pa.array(c) for c in columns)], names=schema.names)

    return by_groups(frames.select(by, order, angle, alignment, flip), [by], [order], run, schema)
