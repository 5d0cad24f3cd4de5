"""Estimators over sessions and whole plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.operators import tracking
from framelake.plans import audit
from framelake.plans import calibrate as calibration
from framelake.plans import extract as extraction
from framelake.queries.keypoints import angled
from framelake.queries import images as _images  # noqa: F401  its SQL is part of that below
from framelake.queries.registry import FRAMES, SIDE, SQL, T, frames, points, query, rounded, table, trajectory
from framelake.schema import BODY_PARTS, SCALARS


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four embeddings of a label as the instances of a frame: session, frame_idx, instance, mask, score."""
    e = table(spark, sf_dir, "embeddings").withColumn("n", (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("long"))
    mask = F.transform("embedding", lambda v: (v.cast("double") > 0.05).cast("int"))
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    box = F.array(at(0) * 100, at(1) * 100, at(0) * 100 + 20 + at(2) * 10, at(1) * 100 + 20 + at(3) * 10)
    parts = F.array(*(F.struct((at(2 * i) * 100).alias("x"), (at(2 * i + 1) * 100).alias("y")) for i in range(8)))
    return e.select(F.col("label").alias("session"), F.floor(F.col("n") / 4).alias("frame_idx"), (F.col("n") % 4).alias("instance"), mask.alias("mask"), at(0).alias("score"), box.alias("box"), parts.alias("points"))


INSTANCES = """WITH n AS (SELECT label AS session, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS n, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings),
i AS (SELECT session, n // 4 AS frame_idx, n % 4 AS instance, e, e[1] AS score FROM n),
m AS (SELECT session, frame_idx, instance, score, g, CASE WHEN e[g + 1] > 0.05 THEN 1 ELSE 0 END AS v FROM i, range(64) t(g)),
s AS (SELECT session, frame_idx, instance, any_value(score) AS score, sum(v) AS area FROM m GROUP BY 1, 2, 3),
b AS (SELECT a.session, a.frame_idx, a.instance AS a, b.instance AS b, sum(a.v * b.v) AS both_ FROM m a JOIN m b ON a.session = b.session AND a.frame_idx = b.frame_idx AND a.g = b.g AND a.instance <> b.instance GROUP BY 1, 2, 3, 4),
o AS (SELECT b.session, b.frame_idx, b.a, b.b, both_ / nullif(x.area + y.area - both_, 0) AS iou, x.score AS sa, y.score AS sb, x.area AS na, y.area AS nb
  FROM b JOIN s x ON x.session = b.session AND x.frame_idx = b.frame_idx AND x.instance = b.a JOIN s y ON y.session = b.session AND y.frame_idx = b.frame_idx AND y.instance = b.b)"""


@query(INSTANCES + """, gone AS (SELECT DISTINCT session, frame_idx, a FROM o WHERE nb > 0 AND iou > 0.25 AND (sb > sa OR sb = sa AND b > a))
SELECT s.session, s.frame_idx, s.instance, CAST(row_number() OVER (PARTITION BY s.session, s.frame_idx ORDER BY score DESC, s.instance DESC) AS INTEGER) AS rank
FROM s LEFT JOIN gone ON gone.session = s.session AND gone.frame_idx = s.frame_idx AND gone.a = s.instance WHERE area > 0 AND gone.a IS NULL""")
def nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.suppressed(instances(spark, sf_dir), threshold=0.25).select("session", "frame_idx", "instance", "rank")


@query(INSTANCES + """, r AS (SELECT *, row_number() OVER (PARTITION BY session, frame_idx ORDER BY score DESC, instance DESC) AS r FROM s WHERE area > 0),
p AS (SELECT x.session, x.frame_idx, x.r AS a, y.r AS b FROM o JOIN r x ON x.session = o.session AND x.frame_idx = o.frame_idx AND x.instance = o.a JOIN r y ON y.session = o.session AND y.frame_idx = o.frame_idx AND y.instance = o.b WHERE iou > 0.25),
k AS (SELECT r.session, r.frame_idx, coalesce(bool_or(a = 1 AND b = 2), false) AS o12, coalesce(bool_or(a = 1 AND b = 3), false) AS o13, coalesce(bool_or(a = 1 AND b = 4), false) AS o14, coalesce(bool_or(a = 2 AND b = 3), false) AS o23, coalesce(bool_or(a = 2 AND b = 4), false) AS o24, coalesce(bool_or(a = 3 AND b = 4), false) AS o34
  FROM (SELECT DISTINCT session, frame_idx FROM r) r LEFT JOIN p ON p.session = r.session AND p.frame_idx = r.frame_idx GROUP BY 1, 2),
k2 AS (SELECT *, NOT o12 AS k2 FROM k), k3 AS (SELECT *, NOT (o13 OR k2 AND o23) AS k3 FROM k2), k4 AS (SELECT *, NOT (o14 OR k2 AND o24 OR k3 AND o34) AS k4 FROM k3)
SELECT r.session, r.frame_idx, r.instance, CAST(row_number() OVER (PARTITION BY r.session, r.frame_idx ORDER BY r.r) AS INTEGER) AS rank
FROM r JOIN k4 ON k4.session = r.session AND k4.frame_idx = r.frame_idx WHERE CASE r.r WHEN 1 THEN true WHEN 2 THEN k2 WHEN 3 THEN k3 ELSE k4 END""")
def nms_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.suppressed(instances(spark, sf_dir), threshold=0.25, corrected=True).select("session", "frame_idx", "instance", "rank")


@query(T + ", k AS (SELECT session, frame_idx // 10 AS frame_idx, frame_idx AS track, x AS age, row_number() OVER (PARTITION BY session, frame_idx // 10 ORDER BY x DESC, frame_idx) AS rank FROM t WHERE state <> 'error') SELECT * FROM k WHERE rank <= 2")
def topk_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trajectory(spark, sf_dir).select("session", F.floor(F.col("frame_idx") / 10).alias("frame_idx"), F.col("frame_idx").alias("track"), F.col("x").alias("age"), "state")
    return tracking.oldest(t, 2, live=F.col("state") != "error").select("session", "frame_idx", "track", "age", "rank")


@query()
def track_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user, four to a frame, as detections."""
    t = trajectory(spark, sf_dir).select("session", F.floor(F.col("frame_idx") / 4).alias("frame_idx"), (F.col("frame_idx") % 4).alias("instance"), "x", "y")
    return tracking.tracked(t)


@query()
def kalman_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracking.smoothed(points(spark, sf_dir), BODY_PARTS, chunk=40, rounds=2), "x", "y", digits=4)


@query()
def kalman_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trajectory(spark, sf_dir).select("session", "frame_idx", "angle", (F.col("y") / 100).alias("score"), F.lit(False).alias("flip"))
    return rounded(tracking.corrected_angles(t, chunk=50), "angle_out", digits=4)


@query()
def plane_ransac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floor plane, region and depth of each session."""
    c = calibration.calibrate(frames(spark, sf_dir), SIDE, every=1, depth_range=(40, 80), tolerance=3, rounds=200, dilate=3)
    return c.select("session", F.transform("plane", lambda v: F.round(v, 6)).alias("plane"), F.aggregate("roi", F.lit(0), lambda a, v: a + v).alias("roi_area"), F.round("true_depth", 4).alias("true_depth"))


CORNERS = "e[1] * 100 AS x0, e[2] * 100 AS y0, e[1] * 100 + 20 + e[3] * 10 AS x1, e[2] * 100 + 20 + e[4] * 10 AS y1"


@query(INSTANCES + f""", c AS (SELECT session, frame_idx, instance, e, {CORNERS} FROM i),
d AS (SELECT a.session, a.frame_idx, greatest(0.0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0.0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS w, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS u,
  list_sum(list_transform(range(8), lambda q: sqrt((a.e[2 * q + 1] * 100 - b.e[2 * q + 1] * 100) ** 2 + (a.e[2 * q + 2] * 100 - b.e[2 * q + 2] * 100) ** 2))) AS kd
  FROM c a JOIN c b ON a.session = b.session AND a.frame_idx = b.frame_idx AND a.instance = 0 AND b.instance = 1),
t AS (SELECT session, frame_idx, count(*) AS n_instances, sum(score) AS total FROM i GROUP BY 1, 2)
SELECT t.session, t.frame_idx, round(coalesce(w / (u - w), 0), 6) + 0.0 AS box_iou, round(coalesce(iou, 0), 6) + 0.0 AS mask_jaccard, round(coalesce(kd, 0), 6) + 0.0 AS keypoint_distance, CAST(n_instances AS INTEGER) AS n_instances, round(total, 6) + 0.0 AS total
FROM t LEFT JOIN d ON d.session = t.session AND d.frame_idx = t.frame_idx LEFT JOIN o ON o.session = t.session AND o.frame_idx = t.frame_idx AND o.a = 0 AND o.b = 1""")
def instance_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tracking.instance_log(instances(spark, sf_dir))
    total = F.aggregate("scores", F.lit(0.0), lambda a, v: a + v)
    names = ["box_iou", "mask_jaccard", "keypoint_distance"]
    return rounded(log.select("session", "frame_idx", *names, F.size("scores").alias("n_instances"), total.alias("total")), *names, "total")


@query(f"""WITH jumping AS ({SQL["jumping_keypoints"]}), flips AS (SELECT session, frame_idx FROM ({SQL["flip_votes"]}) WHERE flip),
tagged AS (SELECT session, 'jumping' AS kind, frame_idx FROM jumping UNION ALL SELECT session, 'flips', frame_idx FROM flips UNION ALL SELECT session, 'combined', frame_idx FROM jumping),
g AS (SELECT *, frame_idx - row_number() OVER (PARTITION BY session, kind ORDER BY frame_idx) AS g FROM tagged)
SELECT session, kind, min(frame_idx) AS start, count(*) AS length, printf('%d - %d', min(frame_idx), min(frame_idx) + count(*)) AS line FROM g GROUP BY session, kind, g""")
def find_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All outlier tests over keypoints, as ranges. No part is missing here."""
    return audit.find_outliers(angled(spark, sf_dir), 4, 2.5, length=20.0)


@query()
def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extraction plan over 8 x 8 frames and their keypoints."""
    out = extraction.extract(frames(spark, sf_dir), points(spark, sf_dir), SIDE, 5, 100, length=20.0)
    return rounded(out, *(c for c in SCALARS if c != "area_px"), "confidence", "alignment", digits=4)


@query()
def extract_untracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with angles from votes and the angle filter."""
    out = extraction.extract(frames(spark, sf_dir), points(spark, sf_dir), SIDE, 5, 100, length=20.0, track=False)
    return rounded(out, *(c for c in SCALARS if c != "area_px"), "confidence", "alignment", digits=4)


@query()
def crop_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turned window about each frame's centre of mass, as its sum and its middle pixel."""
    from framelake.operators import pixels
    from framelake.queries.registry import heights

    m = pixels.moments(heights(spark, sf_dir), "h", SIDE).withColumn("angle", F.col("orientation"))
    w = pixels.cropped_and_turned(m, "h", "w", SIDE, (6, 6))
    return rounded(w.select("session", "frame_idx", F.aggregate("w", F.lit(0.0), lambda a, v: a + v).alias("total"), F.get("w", F.lit(21)).alias("middle")), "total", "middle", digits=4)


SAME = "b.session = a.session AND b.frame_idx = a.frame_idx"
CROSS = "abs(b.r - a.r) + abs(b.c - a.c) <= 1"


@query(FRAMES + f""", n AS (SELECT a.session, a.frame_idx, a.r, a.c, median(b.v) AS v FROM p a, range(-1, 2) i(dr), range(-1, 2) j(dc), p b WHERE {SAME} AND b.r = least(7, greatest(0, a.r + dr)) AND b.c = least(7, greatest(0, a.c + dc)) GROUP BY 1, 2, 3, 4),
er AS (SELECT a.session, a.frame_idx, a.r, a.c, min(b.v) AS v FROM n a JOIN n b ON {SAME} AND {CROSS} GROUP BY 1, 2, 3, 4),
op AS (SELECT a.session, a.frame_idx, a.r, a.c, max(b.v) AS v FROM er a JOIN er b ON {SAME} AND {CROSS} GROUP BY 1, 2, 3, 4),
w AS (SELECT session, frame_idx, list(v) OVER (PARTITION BY session, r, c ORDER BY frame_idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS a FROM op)
SELECT session, frame_idx, round(sum(list_sort(list_concat(a, list_resize([0.0::DOUBLE], 3 - len(a), 0.0::DOUBLE)))[2]), 4) + 0.0 AS total FROM w GROUP BY 1, 2""")
def clean_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blurred, opened and smoothed over time, as each frame's sum."""
    from framelake.operators import pixels

    c = pixels.cleaned(frames(spark, sf_dir), "px", "c", SIDE, (3,), 3, temporal=3)
    return rounded(c.select("session", "frame_idx", F.aggregate("c", F.lit(0.0), lambda a, v: a + v).alias("total")), "total", digits=4)


@query()
def frame_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contour features of each frame's largest component."""
    from framelake.operators import pixels

    f = pixels.shape_features(frames(spark, sf_dir), "px", SIDE, 62)
    return rounded(f.select("session", "frame_idx", F.size("contour").alias("n_points"), "cx", "cy", "major", "minor"), "cx", "cy", "major", "minor", digits=4)


@query(SQL["largest_component"].rpartition("\nSELECT")[0] + """, big AS (SELECT lab.* FROM lab JOIN best ON best.session = lab.session AND best.frame_idx = lab.frame_idx AND best.label = lab.label AND rn = 1),
box AS (SELECT session, frame_idx, min(c) AS x0, min(r) AS y0, max(c) AS x1, max(r) AS y1, count(*) AS n FROM big GROUP BY 1, 2)
SELECT session, frame_idx, 0 AS instance, round(n / 64, 6) + 0.0 AS score, x0 + 0.0::DOUBLE AS x0, y0 + 0.0::DOUBLE AS y0, x1 + 0.0::DOUBLE AS x1, y1 + 0.0::DOUBLE AS y1, 8 AS n_keypoints, round(4.0 * (x0 + x1), 6) + 0.0::DOUBLE AS total_x FROM box""")
def infer_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances by a model that the caller supplies, here a threshold: score, box and keypoints between its corners."""
    from framelake.plans.infer import infer, threshold_model

    found = infer(frames(spark, sf_dir), threshold_model(65), SIDE)
    corners = [F.get("box", F.lit(i)).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))]
    total = F.aggregate("keypoints", F.lit(0.0), lambda a, p: a + F.get(p, F.lit(0)))
    return rounded(found.select("session", "frame_idx", "instance", "score", *corners, F.size("keypoints").alias("n_keypoints"), total.alias("total_x")), "score", "total_x")


@query("""WITH p AS (SELECT source, doc_id % 7 AS k, doc_id FROM documents), s AS (SELECT DISTINCT source, k FROM p)
SELECT concat('session_', k) AS session, concat('/data/', source, '/session_', k) AS folder, concat('/data/', source, '/session_', k, '/depth.dat') AS path FROM s WHERE k <> 2 AND k <> 4""")
def discover_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings with metadata (all but the second) and without a status (the fourth has one)."""
    from framelake.sources.files import unextracted

    s = table(spark, sf_dir, "documents").select("source", (F.col("doc_id") % 7).alias("k")).distinct()
    at = lambda name: F.format_string(f"/data/%s/session_%d/{name}", "source", "k")
    listed = F.array_compact(F.array(at("depth.dat"), F.when(F.col("k") != 2, at("metadata.json")), F.when(F.col("k") == 4, at("proc/results_00.yaml"))))
    return unextracted(s.select(F.explode(listed).alias("path")))


@query("WITH s AS (SELECT DISTINCT source FROM documents), d AS (SELECT DISTINCT source FROM documents WHERE doc_id % 40 = 1) SELECT source AS path, concat('sbatch --wrap \"extract --in \\\"', source, '\\\"\"') AS command FROM s WHERE source NOT IN (SELECT source FROM d)")
def plan_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return audit.plan_batch(d.select(F.col("source").alias("path")).distinct(), d.where("doc_id % 40 = 1").select(F.col("source").alias("path")).distinct(), 'extract --in "{path}"')


@query()
def dataset_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framelake.operators import annotations
    from framelake.queries.labelling import tasks

    images = frames(spark, sf_dir).select("px")
    out = audit.dataset_info(images, annotations.parse(tasks(spark, sf_dir)))
    return rounded(out, *(c for c, t in out.dtypes if t == "double"))
