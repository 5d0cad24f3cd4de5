"""Audits and edits of results: outliers, flips, trims, dataset statistics, samples, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.operators import annotations, editing, intervals, sampling
from framelake.operators import keypoints as kp


def find_outliers(keypoints: DataFrame, window: int = 4, threshold: float = 10.0, with_flips: bool = False, length: float = 80.0) -> DataFrame:
    """(session, kind, start, length, line): ranges of frames with missing parts, jumps, flip disagreements and, combined, any of the first two (or all).

    ``keypoints`` has cx, cy and angle for the flip test.
    """
    missing = kp.missing_frames(keypoints)
    jumping = kp.jumping_frames(keypoints, window, threshold)
    flips = kp.flip_votes(keypoints, length=length).where("flip").select("session", "frame_idx")
    combined = missing.unionByName(jumping).distinct()
    if with_flips:
        combined = combined.unionByName(flips).distinct()
    kinds = {"NaNs": missing, "jumping": jumping, "flips": flips, "combined": combined}
    tagged = None
    for kind, found in kinds.items():
        rows = found.select("session", F.lit(kind).alias("kind"), "frame_idx")
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return intervals.write_lines(tagged, "frame_idx", ["session", "kind"])


def manual_flip(results: DataFrame, lines: DataFrame, session: str) -> DataFrame:
    """Results with the ranges of a flips file applied; raises an error if any is invalid."""
    ranges = intervals.parse_lines(lines).select(F.lit(session).alias("session"), "start", "stop")
    bad = intervals.faults(ranges).limit(20).collect()
    if bad:
        raise ValueError("; ".join(r["fault"] for r in bad))
    return editing.flipped(results, ranges, pixels="px" if "px" in results.columns else None, angle="angle")


def dataset_info(images: DataFrame, parsed: DataFrame) -> DataFrame:
    """One row: pixel mean and deviation over images (image, px), size range, box statistics of first annotations."""
    n = F.size("px")
    mean = F.aggregate("px", F.lit(0.0), lambda a, v: a + v) / n
    per = images.withColumn("m", mean).withColumn("sd", F.sqrt(F.aggregate("px", F.lit(0.0), lambda a, v: a + (v - F.col("m")) * (v - F.col("m"))) / n))
    stats = per.agg(F.count("*").alias("n_images"), F.avg("m").alias("pixel_mean"), F.avg("sd").alias("pixel_std"))
    sizes = parsed.agg(F.min("width").alias("width_min"), F.max("width").alias("width_max"), F.min("height").alias("height_min"), F.max("height").alias("height_max"))
    b = annotations.polygons(parsed).where("polygon = 0").withColumn("b", annotations.box(F.col("vertices")))
    boxes = annotations.box_statistics(b.select(F.lit(0).alias("session"), (F.col("b.x1") - F.col("b.x0")).alias("w"), (F.col("b.y1") - F.col("b.y0")).alias("h"))).drop("session")
    return stats.crossJoin(sizes).crossJoin(boxes)  # one row each


def sample_dataset(frames: DataFrame, n: int, method: str = "random", seed: int = 0, clusters: int = 8) -> DataFrame:
    """About ``n`` frames over all sessions, as many of each: by random choice, at equal steps, or spread over k-means clusters."""
    if method == "kmeans":
        return sampling.diverse(frames, "px", n, clusters, seed)
    sessions = frames.select("session").distinct().count()
    each = -(-n // max(sessions, 1))
    return sampling.per_group(frames, each, seed, "session", "frame_idx") if method == "random" else sampling.uniform(frames, each)


def plan_batch(paths: DataFrame, done: DataFrame, template: str = "extract {path}", prefix: str = "sbatch") -> DataFrame:
    """Commands for the sessions that aren't done, in order of path."""
    todo = paths.join(done.select("path"), "path", "left_anti")
    return todo.orderBy("path").select("path", editing.batch_command(editing.substitute(template, path=F.col("path")), prefix).alias("command"))


trim = editing.trimmed
