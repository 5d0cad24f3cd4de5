"""Body parts: geometry, votes, coordinate systems, layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import geometry
from framelake.operators import keypoints as kp
from framelake.operators import temporal
from framelake.queries.registry import POINTS, T, heights, points, query, rounded, trajectory

F_W, F_H = geometry.focal_length(0), geometry.focal_length(1)
MM = f"673.1 * (x - 256) / {F_W!r} AS x_mm, 673.1 * (y - 212) / {F_H!r} AS y_mm"
ANGLES = ", a AS (SELECT *, CAST((frame_idx * 7 + session * 40) % 360 AS DOUBLE) AS angle FROM k)"
TURNED = ANGLES + """, q AS (SELECT *, radians(-angle) AS g FROM a),
r AS (SELECT *, cos(g) * (x - cx) - sin(g) * (y - cy) + cx AS rx, sin(g) * (x - cx) + cos(g) * (y - cy) + cy AS ry FROM q)"""


def angled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).withColumn("angle", ((F.col("frame_idx") * 7 + F.col("session") * 40) % 360).cast("double"))


@query(POINTS + f" SELECT session, frame_idx, part, round(x_mm, 6) + 0.0 AS x_mm, round(y_mm, 6) + 0.0 AS y_mm FROM (SELECT *, {MM} FROM k)")
def px_to_mm(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = geometry.px_to_mm(F.col("x"), F.col("y"))
    return rounded(points(spark, sf_dir).select("session", "frame_idx", "part", x.alias("x_mm"), y.alias("y_mm")), "x_mm", "y_mm")


@query(POINTS + TURNED + " SELECT session, frame_idx, part, round(rx, 6) + 0.0 AS x, round(ry, 6) + 0.0 AS y FROM r")
def rotate_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kp.turned(angled(spark, sf_dir)).select("session", "frame_idx", "part", "x", "y"), "x", "y")


@query(T + " SELECT session, frame_idx, round(a - 360 * floor(a / 360), 6) + 0.0 AS clamped FROM (SELECT *, x * 5 - 700 AS a FROM t)")
def clamp_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trajectory(spark, sf_dir).select("session", "frame_idx", geometry.clamp_degrees(F.col("x") * 5 - 700).alias("clamped")), "clamped")


@query(T + """, d AS (SELECT *, coalesce(lag(angle) OVER (PARTITION BY session ORDER BY frame_idx), angle) AS before FROM t),
m AS (SELECT session, frame_idx, (angle - before) - 360 * floor((angle - before) / 360) AS m FROM d)
SELECT session, frame_idx, round(CASE WHEN m > 180 THEN m - 360 ELSE m END, 6) + 0.0 AS turn FROM m""")
def angle_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = temporal.in_order()
    t = trajectory(spark, sf_dir).withColumn("before", F.coalesce(F.lag("angle").over(w), F.col("angle")))
    return rounded(t.select("session", "frame_idx", geometry.angle_difference(F.col("before"), F.col("angle")).alias("turn")), "turn")


@query(POINTS + """, a AS (SELECT *, degrees(atan2(y, x)) AS raw FROM k), c AS (SELECT *, raw - 360 * floor(raw / 360) AS g FROM a),
l AS (SELECT *, g - coalesce(lag(g) OVER (PARTITION BY session, part ORDER BY frame_idx), g) AS d0 FROM c), m AS (SELECT *, d0 - 360 * floor(d0 / 360) AS m FROM l)
SELECT session, frame_idx, round(median(CASE WHEN m > 180 THEN m - 360 ELSE m END), 6) + 0.0 AS rotation FROM m GROUP BY 1, 2""")
def rotation_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(temporal.rotation(points(spark, sf_dir)), "rotation")


@query(POINTS + TURNED + f""", m AS (SELECT *, {MM}, 673.1 * (cx - 256) / {F_W!r} AS mcx, 673.1 * (cy - 212) / {F_H!r} AS mcy FROM r),
z AS (SELECT label AS session, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_idx, list_transform(embedding, lambda v: CAST(floor(CAST(v AS DOUBLE) * 200) + 60 AS INTEGER)) AS px FROM embeddings)
SELECT session, frame_idx, part, round(x, 5) + 0.0 AS x, round(x_mm, 5) + 0.0 AS x_mm, round(y_mm, 5) + 0.0 AS y_mm, round(rx - cx, 5) + 0.0 AS rot_x_px, round(ry - cy, 5) + 0.0 AS rot_y_px,
  round(cos(g) * (x_mm - mcx) - sin(g) * (y_mm - mcy), 5) + 0.0 AS rot_x_mm, round(sin(g) * (x_mm - mcx) + cos(g) * (y_mm - mcy), 5) + 0.0 AS rot_y_mm,
  px[CAST(greatest(0, least(floor(y), 7)) * 8 + greatest(0, least(floor(x), 7)) AS INTEGER) + 1] AS z_mm
FROM m JOIN z USING (session, frame_idx)""")
def keypoint_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = angled(spark, sf_dir).join(heights(spark, sf_dir).select("session", "frame_idx", "px"), ["session", "frame_idx"])
    names = ["x", "x_mm", "y_mm", "rot_x_px", "rot_y_px", "rot_x_mm", "rot_y_mm"]
    return rounded(kp.systems(rows, "px", 8, 8).select("session", "frame_idx", "part", *names, "z_mm"), *names, digits=5)


@query(POINTS + TURNED + """, v AS (SELECT session, frame_idx, ord, CASE WHEN abs(cx - 10.0 - rx) < abs(cx + 10.0 - rx) THEN -1 ELSE 1 END AS v FROM r),
g AS (SELECT session, frame_idx, avg(v) FILTER (ord < 4) AS front, avg(v) FILTER (ord BETWEEN 4 AND 6) AS rear,
  count(*) FILTER ((ord < 4 AND v = -1) OR (ord BETWEEN 4 AND 6 AND v = 1)) AS f, count(*) FILTER ((ord < 4 AND v = 1) OR (ord BETWEEN 4 AND 6 AND v = -1)) AS k FROM v GROUP BY 1, 2)
SELECT session, frame_idx, round(front, 6) + 0.0 AS front, round(rear, 6) + 0.0 AS rear, front < rear AS flip, round((CASE WHEN front < rear THEN f ELSE k END) / 7, 6) + 0.0 AS confidence FROM g""")
def flip_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kp.flip_votes(angled(spark, sf_dir), length=20.0), "front", "rear", "confidence")


@query(POINTS + TURNED + """, n AS (SELECT session, frame_idx, rx, [0, 1, 1, 2, 3, 3, 4][ord + 1] AS rank FROM r WHERE ord < 7)
SELECT a.session, a.frame_idx, round(count(*) FILTER (a.rank <> b.rank AND sign(a.rx - b.rx) = sign(b.rank - a.rank)) / 38, 6) + 0.0 AS score
FROM n a JOIN n b ON a.session = b.session AND a.frame_idx = b.frame_idx GROUP BY 1, 2""")
def alignment_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kp.alignment(kp.turned(angled(spark, sf_dir))), "score")


@query(POINTS + """ SELECT a.session, a.frame_idx, a.part AS part_a, b.part AS part_b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) + 0.0 AS distance
FROM k a JOIN k b ON a.session = b.session AND a.frame_idx = b.frame_idx""")
def keypoint_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kp.distances(points(spark, sf_dir)), "distance")


@query(POINTS + """ SELECT a.session, a.frame_idx, a.part AS part_a, b.part AS part_b, round(a.x - b.x, 6) + 0.0 AS distance FROM k a JOIN k b ON a.session = b.session AND a.frame_idx = b.frame_idx""")
def keypoint_distances_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kp.distances(points(spark, sf_dir), "x"), "distance")


EDGES = ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(kp.SKELETON))


@query(POINTS + f""", s AS (SELECT * FROM (VALUES {EDGES}) s(edge, src, dst))
SELECT a.session, a.frame_idx, edge, src, dst, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) + 0.0 AS length
FROM s JOIN k a ON a.part = src JOIN k b ON b.part = dst AND a.session = b.session AND a.frame_idx = b.frame_idx""")
def skeleton_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kp.edge_lengths(points(spark, sf_dir)), "length")


@query(POINTS + """, s AS (SELECT * FROM k WHERE (session + frame_idx + ord) % 5 <> 0), f AS (SELECT DISTINCT session, frame_idx FROM s)
SELECT f.session, f.frame_idx, string_agg(concat(n.part, ':', CASE WHEN s.x IS NULL THEN '0' WHEN s.x > 0 THEN '+' ELSE '-' END), ',' ORDER BY n.ord) AS parts, round(sum(coalesce(s.x, 0) * n.ord), 6) + 0.0 AS weighted
FROM f CROSS JOIN names n LEFT JOIN s ON s.session = f.session AND s.frame_idx = f.frame_idx AND s.ord = n.ord GROUP BY 1, 2""")
def canonical_keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in canonical order; those that are missing are filled with 0."""
    some = points(spark, sf_dir).where((F.col("session") + F.col("frame_idx") + F.col("ord")) % 5 != 0)
    g = kp.gathered(some)
    sign = lambda x: F.when(x == 0, F.lit("0")).when(x > 0, F.lit("+")).otherwise(F.lit("-"))
    names = F.array_join(F.transform("kp", lambda p: F.concat(p["part"], F.lit(":"), sign(p["x"]))), ",")
    weighted = F.aggregate(F.transform("kp", lambda p, i: p["x"] * i), F.lit(0.0), lambda a, x: a + x)
    return rounded(g.select("session", "frame_idx", names.alias("parts"), weighted.alias("weighted")), "weighted")


WIDE = ", ".join(f"max({v}) FILTER (part = '{p}') AS {p.replace(' ', '')}_{v}" for p in kp.BODY_PARTS for v in ("x", "y"))


@query(POINTS + f" SELECT session, frame_idx, {WIDE} FROM k GROUP BY 1, 2")
def keypoints_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kp.wide(points(spark, sf_dir), ["x", "y"])


@query(POINTS + " SELECT session, frame_idx, part, x, y FROM k")
def keypoints_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kp.long(kp.wide(points(spark, sf_dir), ["x", "y"]), ["x", "y"])


@query(POINTS + """, n AS (SELECT session, frame_idx, CASE WHEN x > -40 THEN x END AS x, y, score FROM k) SELECT DISTINCT session, frame_idx FROM n WHERE x IS NULL""")
def nan_keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = points(spark, sf_dir).withColumn("x", F.when(F.col("x") > -40, F.col("x")).otherwise(F.lit(float("nan"))))
    return kp.missing_frames(rows)


JUMPING = POINTS + """, m AS (SELECT session, frame_idx, part, x, y, median(x) OVER w AS mx, median(y) OVER w AS my FROM k WHERE ord < {parts} WINDOW w AS (PARTITION BY session, part ORDER BY frame_idx ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
d AS (SELECT session, frame_idx, part, sqrt((x - mx) * (x - mx) + (y - my) * (y - my)) AS d FROM m), c AS (SELECT session, part, median(d) AS med FROM d GROUP BY 1, 2),
z AS (SELECT d.session, frame_idx, d.part, abs(d - med) AS e FROM d JOIN c USING (session, part)), a AS (SELECT session, part, median(e) AS mad FROM z GROUP BY 1, 2)
SELECT DISTINCT z.session, frame_idx FROM z JOIN a USING (session, part) WHERE CASE WHEN mad > 0 THEN 0.6745 * e / mad > 2.5 ELSE e > 0 END"""


@query(JUMPING.format(parts=6))
def jumping_keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kp.jumping_frames(points(spark, sf_dir), 4, 2.5)


@query(JUMPING.format(parts=7))
def jumping_keypoints_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kp.jumping_frames(points(spark, sf_dir), 4, 2.5, corrected=True)


@query(POINTS + """, boxes AS (SELECT session, frame_idx, p AS polygon, cx + 12 * p - 12 AS px, cy AS py, 3 + 2 * p AS half FROM center, range(3) g(p)),
j AS (SELECT k.session, k.frame_idx, ord, polygon, x > px - half AND x <= px + half AND y > py - half AND y <= py + half AS inside,
  least(sqrt((x - (px - half)) * (x - (px - half)) + (y - (py - half)) * (y - (py - half))), sqrt((x - (px + half)) * (x - (px + half)) + (y - (py - half)) * (y - (py - half))),
        sqrt((x - (px + half)) * (x - (px + half)) + (y - (py + half)) * (y - (py + half))), sqrt((x - (px - half)) * (x - (px - half)) + (y - (py + half)) * (y - (py + half)))) AS d
  FROM k JOIN boxes USING (session, frame_idx)),
o AS (SELECT *, row_number() OVER (PARTITION BY session, frame_idx, ord ORDER BY CASE WHEN inside THEN 0 ELSE 1 END, CASE WHEN inside THEN 0 ELSE d END, polygon) AS rn FROM j)
SELECT session, frame_idx, ord AS point, polygon, inside FROM o WHERE rn = 1""")
def assign_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts to the first of three squares that holds them, else the one with the nearest corner."""
    k = points(spark, sf_dir)
    c = k.select("session", "frame_idx", "cx", "cy").distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("polygon"))
    px, half = F.col("cx") + 12 * F.col("polygon") - 12, 3 + 2 * F.col("polygon")
    corner = lambda sx, sy: F.struct((px + sx * half).alias("x"), (F.col("cy") + sy * half).alias("y"))
    squares = c.select("session", "frame_idx", "polygon", F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1)).alias("vertices"))
    return kp.polygon_owner(k.select("session", "frame_idx", F.col("ord").alias("point"), "x", "y"), squares, ["session", "frame_idx"])
