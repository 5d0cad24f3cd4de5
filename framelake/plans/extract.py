"""The extraction plan: frames and keypoints to features, scalars, keypoints and corrected angles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions.arrays import prepare
from framelake.operators import keypoints as kp
from framelake.operators import pixels, temporal, tracking
from framelake.schema import BODY_PARTS, SCALARS, TRUE_DEPTH
from framelake.session import written


def prepared(frames: DataFrame, low: float, high: float, every: int = 1) -> DataFrame:
    """Frames (session, frame_idx, px) with their height over the session's median frame in ``h``.

    A background is one row for each session; it is joined by session and broadcast only if Spark finds it small.
    """
    background = pixels.median_frame(frames, "px", "session", "bg", every)
    return frames.join(background, "session").withColumn("h", prepare(F.col("px"), F.col("bg"), low, high)).drop("bg")


def extract(frames: DataFrame, keypoints: DataFrame, width: int, low: float = 10, high: float = 100, depth: float = TRUE_DEPTH, length: float = 80.0, track: bool = True, smooth: bool = False, every: int = 1, clean: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row for each frame: the 17 scalars, flip, confidence, alignment and the corrected angle.

    ``keypoints`` has (session, frame_idx, part, x, y, score). With ``smooth`` they are smoothed first; with ``track``
    angles are corrected by a tracker, otherwise by votes and the angle filter.
    """
    f = prepared(frames, low, high, every)
    f = clean(f) if clean else f
    features = pixels.moments(f, "h", width).where("cx is not null")
    # all that comes from pixels, in one pass: what follows reads these slim rows, not frames
    slim = written(pixels.scalars(features, "h", low, high, depth).select("session", "frame_idx", "cx", "cy", "orientation", *(c for c in SCALARS if c != "angle")))
    seen = tracking.smoothed(keypoints, BODY_PARTS) if smooth else keypoints.select("session", "frame_idx", "part", "x", "y")
    frame = ["session", "frame_idx"]
    pose = slim.select(*frame, "cx", "cy", F.pmod("orientation", F.lit(360.0)).alias("angle"))
    posed = seen.join(pose, frame)
    votes = kp.flip_votes(posed, length=length).select(*frame, "flip", "confidence")
    turned = F.when(F.col("flip"), F.pmod(F.col("angle") + 180, F.lit(360.0))).otherwise(F.col("angle"))
    aligned = kp.alignment(kp.turned(posed.join(votes, frame).withColumn("angle", turned)))
    angles = written(pose.join(votes, frame).withColumn("angle", turned).join(aligned, frame))
    if track:
        fixed = tracking.corrected_angles(angles)
    else:
        fixed = temporal.filter_angles_to_rest(angles, "angle", "angle_out", "q_f").select(*frame, "angle_out", (F.col("flip") != F.col("q_f")).alias("flip_out"), F.lit(0).alias("intervention"))
    out = slim.join(angles.select(*frame, "confidence", F.col("score").alias("alignment")), frame).join(fixed, frame)
    return out.withColumn("angle", F.radians("angle_out")).select(*frame, *SCALARS, F.col("flip_out").alias("flip"), "confidence", "alignment", "intervention")
