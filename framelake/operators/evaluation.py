"""How good predicted keypoints are: object keypoint similarity and average precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.schema import BODY_PARTS

# fixed values: how far experts' marks of a body part scatter, in the order of BODY_PARTS
SIGMAS = [0.026, 0.035, 0.035, 0.079, 0.107, 0.107, 0.089, 0.026]

THRESHOLDS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))
#: Score ranges in which detections are ranked by themselves.
PARTS = 256


def similarity(predicted: DataFrame, truth: DataFrame, area: Column, sigmas: list[float] = SIGMAS, by: tuple[str, ...] = ("session", "frame_idx")) -> DataFrame:
    """(keys, oks): the mean over a frame's true parts of exp(-d**2 / (2 area (2 sigma)**2)); a part that isn't predicted counts 0.

    ``predicted`` and ``truth`` have a row for each part (part, x, y); ``area`` is an expression over truth's columns.
    """
    scatter = F.element_at(F.create_map(*(x for p, s in zip(BODY_PARTS, sigmas, strict=True) for x in (F.lit(p), F.lit(s)))), F.col("part"))
    t = truth.withColumns({"q_area": area, "q_s": 2 * scatter}).select(*by, "part", F.col("x").alias("q_x"), F.col("y").alias("q_y"), "q_area", "q_s")
    both = t.join(predicted.select(*by, "part", "x", "y"), [*by, "part"], "left")
    d2 = (F.col("x") - F.col("q_x")) * (F.col("x") - F.col("q_x")) + (F.col("y") - F.col("q_y")) * (F.col("y") - F.col("q_y"))
    return both.groupBy(*by).agg(F.avg(F.coalesce(F.exp(-d2 / (2 * F.col("q_area") * F.col("q_s") * F.col("q_s"))), F.lit(0.0))).alias("oks"))


def average_precision(detections: DataFrame, n_truths: int, thresholds: tuple[float, ...] = THRESHOLDS, score: str = "score", oks: str = "oks", order: tuple[str, ...] = ("session", "frame_idx")) -> DataFrame:
    """(threshold, ap): the mean of the best precision at 101 levels of recall or more, for detections (score in 0 to 1, similarity) by falling score.

    Ranks are counted in two steps, within ranges of scores and over them, so no task sorts all detections.
    """
    rows = detections.select(*order, F.col(score).alias("q_score"), F.col(oks).alias("q_oks"), F.least(F.floor((1 - F.col(score)) * PARTS), F.lit(PARTS - 1)).alias("q_part"))
    rows = rows.withColumn("threshold", F.explode(F.array(*(F.lit(float(t)) for t in thresholds)))).withColumn("q_hit", (F.col("q_oks") >= F.col("threshold")).cast("long"))
    totals = rows.groupBy("threshold", "q_part").agg(F.count("*").alias("q_n"), F.sum("q_hit").alias("q_h"))
    before = Window.partitionBy("threshold").orderBy("q_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("threshold", "q_part", F.coalesce(F.sum("q_n").over(before), F.lit(0)).alias("q_n0"), F.coalesce(F.sum("q_h").over(before), F.lit(0)).alias("q_h0"))
    inside = Window.partitionBy("threshold", "q_part").orderBy(F.desc("q_score"), *order)
    ranked = rows.withColumns({"q_n": F.row_number().over(inside), "q_h": F.sum("q_hit").over(inside.rowsBetween(Window.unboundedPreceding, 0))})
    # PARTS rows for each threshold
    ranked = ranked.join(F.broadcast(offsets), ["threshold", "q_part"]).withColumns({"q_hits": F.col("q_h0") + F.col("q_h"), "q_rank": F.col("q_n0") + F.col("q_n")})
    level = F.floor(F.col("q_hits") * 100 / F.lit(n_truths))
    best = ranked.where("q_hits > 0").groupBy("threshold", level.alias("q_level")).agg(F.max(F.col("q_hits") / F.col("q_rank")).alias("q_p"))
    levels = rows.select("threshold").distinct().select("threshold", F.explode(F.sequence(F.lit(0), F.lit(100))).alias("q_level"))
    at_least = Window.partitionBy("threshold").orderBy(F.desc("q_level"))
    found = levels.join(best, ["threshold", "q_level"], "left").withColumn("q_p", F.coalesce(F.max("q_p").over(at_least), F.lit(0.0)))
    return found.groupBy("threshold").agg(F.avg("q_p").alias("ap"))
