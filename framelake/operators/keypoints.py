"""Operators over body parts: rows (session, frame_idx, part, x, y, score) unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.functions.geometry import distance, px_to_mm, rotate
from framelake.operators.temporal import keyed
from framelake.schema import BODY_PARTS, BODY_RANK, FRONT_PARTS, REAR_PARTS, SKELETON, TRUE_DEPTH

FRAME = ["session", "frame_idx"]


def gathered(keypoints: DataFrame, by: list[str] = FRAME, parts: list[str] = BODY_PARTS, *more: str) -> DataFrame:
    """One row for each frame with ``kp``, its parts in canonical order as structs (part, x, y, score); a missing part is all 0."""
    order = F.array_position(F.array(*(F.lit(p) for p in parts)), F.col("part"))
    own = keypoints.where(F.col("part").isin(parts)).groupBy(*by, *more).agg(F.map_from_entries(F.collect_list(F.struct(order.cast("int"), F.struct("x", "y", "score")))).alias("q_m"))
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("score"))
    full = F.array(*(F.struct(F.lit(p).alias("part"), *(F.coalesce(F.try_element_at("q_m", F.lit(i + 1)), zero)[c].alias(c) for c in ("x", "y", "score"))) for i, p in enumerate(parts)))
    return own.withColumn("kp", full).drop("q_m")


def distances(keypoints: DataFrame, metric: str = "euclidean", by: list[str] = FRAME) -> DataFrame:
    """All ordered pairs of a frame's parts with their distance, or signed difference in x or y (parts are few: 8 at most)."""
    pair = keypoints.groupBy(*by).agg(F.collect_list(F.struct("part", "x", "y")).alias("a")).withColumn("b", F.col("a"))
    pair = pair.select(*by, F.explode("a").alias("a"), "b").select(*by, "a", F.explode("b").alias("b"))
    a, b = F.col("a"), F.col("b")
    value = {"euclidean": distance(a["x"], a["y"], b["x"], b["y"]), "x": a["x"] - b["x"], "y": a["y"] - b["y"]}[metric]
    return pair.select(*by, a["part"].alias("part_a"), b["part"].alias("part_b"), value.alias("distance"))


def skeleton(spark) -> DataFrame:
    """The skeleton's nine edges."""
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(SKELETON)], "edge int, src string, dst string")


def edge_lengths(keypoints: DataFrame, by: list[str] = FRAME) -> DataFrame:
    """Length of each skeleton edge in each frame. Edges are nine rows and are broadcast."""
    edges = F.broadcast(skeleton(keypoints.sparkSession))
    a = keypoints.select(*by, F.col("part").alias("src"), F.col("x").alias("x0"), F.col("y").alias("y0")).join(edges, "src")
    b = keypoints.select(*by, F.col("part").alias("dst"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    return a.join(b, [*by, "dst"]).select(*by, "edge", "src", "dst", distance(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("length"))


def turned(keypoints: DataFrame, cx: str = "cx", cy: str = "cy", angle: str = "angle") -> DataFrame:
    """x and y rotated about the centre by minus the angle."""
    x, y = rotate(F.col("x"), F.col("y"), F.col(cx), F.col(cy), F.col(angle))
    return keypoints.withColumns({"x": x, "y": y})


def flip_votes(keypoints: DataFrame, cx: str = "cx", cy: str = "cy", angle: str = "angle", length: float = 80.0, by: list[str] = FRAME) -> DataFrame:
    """Whether the parts say that a frame is turned by 180 degrees, and how many of the seven agree.

    After rotation each part votes for the side of the centre's extent that is nearer: left -1, right 1. A frame is
    flipped if the front's mean vote is below the rear's.
    """
    rows = turned(keypoints, cx, cy, angle)
    left, right = F.abs(F.col(cx) - length / 2 - F.col("x")), F.abs(F.col(cx) + length / 2 - F.col("x"))
    # a missing distance votes right
    vote = F.when(F.coalesce(left < right, F.lit(False)), F.lit(-1)).otherwise(F.lit(1))
    front, rear = F.col("part").isin(FRONT_PARTS), F.col("part").isin(REAR_PARTS)
    rows = rows.withColumn("q_v", vote)
    out = rows.groupBy(*by).agg(
        F.avg(F.when(front, F.col("q_v"))).alias("front"),
        F.avg(F.when(rear, F.col("q_v"))).alias("rear"),
        F.count_if(front & (F.col("q_v") == -1) | rear & (F.col("q_v") == 1)).alias("q_flip"),
        F.count_if(front & (F.col("q_v") == 1) | rear & (F.col("q_v") == -1)).alias("q_keep"),
    )
    flip = F.col("front") < F.col("rear")
    total = len(FRONT_PARTS) + len(REAR_PARTS)
    return out.withColumns({"flip": flip, "confidence": F.when(flip, F.col("q_flip")).otherwise(F.col("q_keep")) / total}).drop("q_flip", "q_keep")


def alignment(keypoints: DataFrame, by: list[str] = FRAME) -> DataFrame:
    """Share of the ordered pairs of the seven parts before the tail tip that stand as expected: a part nearer to the nose is further east."""
    ranks = F.array(*(F.lit(r) for r in BODY_RANK))
    rank = F.get(ranks, (F.array_position(F.array(*(F.lit(p) for p in BODY_PARTS)), F.col("part")) - 1).cast("int"))
    rows = keypoints.where(F.col("part").isin(BODY_PARTS[:-1])).groupBy(*by).agg(F.collect_list(F.struct(rank.alias("r"), "x")).alias("a"))
    met = F.aggregate(F.col("a"), F.lit(0), lambda n, p: n + F.size(F.filter("a", lambda q: (p["r"] != q["r"]) & (F.signum(p["x"] - q["x"]) == F.signum(q["r"] - p["r"])))))
    pairs = sum(a != b for a in BODY_RANK for b in BODY_RANK)
    return rows.select(*by, (met / pairs).alias("score"))


def systems(keypoints: DataFrame, pixels: str | None = None, width: int = 512, height: int = 424, depth: float = TRUE_DEPTH) -> DataFrame:
    """Each part in four systems: as seen and turned about the centre, in pixels and millimetres, and the height under it.

    Rows need cx, cy, angle and, for z, the frame's pixels as a row-major array.
    """
    x, y, cx, cy, a = (F.col(c) for c in ("x", "y", "cx", "cy", "angle"))
    mx, my = px_to_mm(x, y, depth)
    mcx, mcy = px_to_mm(cx, cy, depth)
    rx, ry = rotate(x, y, cx, cy, a)
    out = keypoints.withColumns({"x_mm": mx, "y_mm": my, "q_cx": mcx, "q_cy": mcy, "rot_x_px": rx - cx, "rot_y_px": ry - cy})
    rmx, rmy = rotate(F.col("x_mm"), F.col("y_mm"), F.col("q_cx"), F.col("q_cy"), a)
    out = out.withColumns({"rot_x_mm": rmx - F.col("q_cx"), "rot_y_mm": rmy - F.col("q_cy")}).drop("q_cx", "q_cy")
    if pixels:
        column = F.greatest(F.lit(0), F.least(F.floor(x).cast("int"), F.lit(width - 1)))
        row = F.greatest(F.lit(0), F.least(F.floor(y).cast("int"), F.lit(height - 1)))
        out = out.withColumn("z_mm", F.get(pixels, row * width + column))
    return out


def wide(keypoints: DataFrame, values: list[str], by: list[str] = FRAME) -> DataFrame:
    """One row for each frame, a column <part>_<value> for each part and value."""
    return keypoints.groupBy(*by).agg(*(F.max(F.when(F.col("part") == p, F.col(v))).alias(f"{p.replace(' ', '')}_{v}") for p in BODY_PARTS for v in values))


def long(table: DataFrame, values: list[str], by: list[str] = FRAME) -> DataFrame:
    """The inverse of ``wide``."""
    rows = F.explode(F.array(*(F.struct(F.lit(p).alias("part"), *(F.col(f"{p.replace(' ', '')}_{v}").alias(v) for v in values)) for p in BODY_PARTS)))
    return table.select(*by, rows.alias("q")).select(*by, "q.*")


def missing_frames(keypoints: DataFrame, by: list[str] = FRAME) -> DataFrame:
    """Frames in which any part has no position (null or NaN)."""
    bad = lambda c: F.col(c).isNull() | F.isnan(c)
    return keypoints.where(bad("x") | bad("y") | bad("score")).select(*by).distinct()


def jumping_frames(keypoints: DataFrame, window: int = 4, threshold: float = 10.0, corrected: bool = False, by: str | list[str] = "session", order: str = "frame_idx") -> DataFrame:
    """Frames in which any part is an outlier by its distance to its moving median.

    The tail tip is left out, and so is the part before it unless ``corrected``.
    """
    from framelake.operators.robust import mark_outliers
    from framelake.operators.temporal import in_order

    parts = BODY_PARTS[:-1] if corrected else BODY_PARTS[:-2]
    keys = [*keyed(by), "part"]
    w = in_order(keys, order).rowsBetween(1 - window, 0)
    rows = keypoints.where(F.col("part").isin(parts)).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x", "y")})
    rows = rows.withColumns({f"q_{c}": F.percentile(c, F.lit(0.5)).over(w) for c in ("x", "y")})
    far = rows.select(*keys, order, distance(F.col("x"), F.col("y"), F.col("q_x"), F.col("q_y")).alias("d"))
    return mark_outliers(far, ["d"], threshold, by=keys).where("outlier").select(*keyed(by), order).distinct()


def polygon_owner(points: DataFrame, polygons: DataFrame, by: str | list[str] = "task") -> DataFrame:
    """For each point of (by, point, x, y) the polygon of (by, polygon, vertices): the first that holds it, else the nearest by a vertex. Tasks have a handful of each."""
    from framelake.functions.geometry import crosses, vertex_distance

    keys = keyed(by)
    both = points.join(polygons, keys).withColumn("q_in", crosses(F.col("x"), F.col("y"), F.col("vertices")))
    cost = F.when(F.col("q_in"), F.struct(F.lit(0).alias("o"), F.lit(0.0).alias("d"))).otherwise(F.struct(F.lit(1).alias("o"), vertex_distance(F.col("x"), F.col("y"), F.col("vertices")).alias("d")))
    best = both.groupBy(*keys, "point").agg(F.min(F.struct(cost.alias("c"), "polygon", F.col("q_in").alias("inside"))).alias("b"))
    return best.select(*keys, "point", F.col("b.polygon").alias("polygon"), F.col("b.inside").alias("inside"))


def rank_instances(instances: DataFrame, score: Column, k: int, by: list[str] = FRAME) -> DataFrame:
    """The k best instances of each frame, best first."""
    w = Window.partitionBy(*by).orderBy(score.desc(), "instance")
    return instances.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
