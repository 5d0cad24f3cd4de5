"""Frames: preparation, background, moments, scalars, masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import arrays, geometry
from framelake.operators import pixels
from framelake.queries.registry import BACKGROUND, FRAMES, SIDE, background, frames, heights, query, rounded, table


def by_pixel(df: DataFrame, array: str, into: str = "v") -> DataFrame:
    """A row for each pixel, so that both engines compare plain numbers."""
    return df.select("session", "frame_idx", F.posexplode(array).alias("i", into))


@query(FRAMES + BACKGROUND + " SELECT session, r * 8 + c AS i, bg FROM b")
def background_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return background(frames(spark, sf_dir)).select("session", F.posexplode("bg").alias("i", "bg"))


@query(FRAMES + BACKGROUND + ", n AS (SELECT session, bg FROM b WHERE (r - 3.5) * (r - 3.5) + (c - 3.5) * (c - 3.5) <= 9) SELECT session, median(bg) AS true_depth FROM n GROUP BY session")
def true_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.true_depth(background(frames(spark, sf_dir)), arrays.ring(SIDE, SIDE, 3.5, 3.5, 3.0))


@query(FRAMES + BACKGROUND + " SELECT session, frame_idx, r * 8 + c AS i, v FROM h")
def frame_prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_pixel(heights(spark, sf_dir), "h")


@query(FRAMES + BACKGROUND + " SELECT session, frame_idx, r * 8 + c AS i, CAST(floor(v * (255 / 100) + 0) AS INTEGER) AS v FROM h")
def scale_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_pixel(heights(spark, sf_dir).withColumn("s", arrays.scale(F.col("h"), 0, 100)), "s")


@query(FRAMES + " SELECT session, frame_idx, count(*) FILTER (v % 9 = 0) AS n_invalid FROM p GROUP BY 1, 2")
def invalid_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    zeroed = F.transform("px", lambda v: v % 9)
    bad = arrays.invalid(zeroed)
    return frames(spark, sf_dir).select("session", "frame_idx", F.aggregate(bad, F.lit(0).cast("long"), lambda a, v: a + v).alias("n_invalid"))


@query(FRAMES + BACKGROUND + " SELECT session, frame_idx, min(r) AS y0, min(c) AS x0, max(r) AS y1, max(c) AS x1, max(r) - min(r) AS size_y, max(c) - min(c) AS size_x FROM h WHERE v > 20 GROUP BY 1, 2")
def roi_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = F.transform("h", lambda v: (v > 20).cast("int"))
    b = heights(spark, sf_dir).withColumn("b", arrays.bbox(mask, SIDE)).where("b is not null").select("session", "frame_idx", "b.*")
    return b.withColumns({"size_y": F.col("y1") - F.col("y0"), "size_x": F.col("x1") - F.col("x0")})


CROP = FRAMES + BACKGROUND + """, m AS (SELECT session, frame_idx, min(r) AS y0, min(c) AS x0, max(r) + {add} AS y1, max(c) + {add} AS x1 FROM h WHERE v > 20 GROUP BY 1, 2)
SELECT m.session, m.frame_idx, count(v) AS n, coalesce(sum(v), 0) AS total FROM m LEFT JOIN h ON h.session = m.session AND h.frame_idx = m.frame_idx AND r >= y0 AND r < y1 AND c >= x0 AND c < x1 GROUP BY 1, 2"""


def cropped(spark: SparkSession, sf_dir: str, add: int) -> DataFrame:
    mask = F.transform("h", lambda v: (v > 20).cast("int"))
    b = heights(spark, sf_dir).withColumn("b", arrays.bbox(mask, SIDE)).where("b is not null")
    c = arrays.crop(F.col("h"), SIDE, F.col("b.y0"), F.col("b.y1") + add, F.col("b.x0"), F.col("b.x1") + add)
    return b.withColumn("c", c).select("session", "frame_idx", F.size("c").cast("long").alias("n"), arrays.total(F.col("c")).alias("total"))


@query(CROP.format(add=0))
def roi_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box's last row and column are left out."""
    return cropped(spark, sf_dir, 0)


@query(CROP.format(add=1))
def roi_crop_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cropped(spark, sf_dir, 1)


MOMENTS = """, q AS (SELECT session, frame_idx, sum(v) AS m00, sum(v * c) AS m10, sum(v * r) AS m01, sum(v * c * c) AS m20, sum(v * c * r) AS m11, sum(v * r * r) AS m02 FROM h GROUP BY 1, 2),
u AS (SELECT *, m10 / m00 AS cx, m01 / m00 AS cy, m20 - m10 / m00 * m10 AS u20, m02 - m01 / m00 * m01 AS u02, m11 - m10 / m00 * m01 AS u11 FROM q WHERE m00 > 0),
o AS (SELECT *, sqrt(4 * u11 * u11 + (u20 - u02) * (u20 - u02)) AS common FROM u),
z AS (SELECT *, degrees(-0.5 * atan2(2 * u11, u20 - u02)) AS orientation, 2 * sqrt(2) * sqrt(greatest(0, u20 + u02 + common) / m00) AS major, 2 * sqrt(2) * sqrt(greatest(0, u20 + u02 - common) / m00) AS minor FROM o)"""


@query(FRAMES + BACKGROUND + MOMENTS + " SELECT session, frame_idx, round(cx, 5) + 0.0 AS cx, round(cy, 5) + 0.0 AS cy, round(orientation, 4) + 0.0 AS orientation, round(major, 5) + 0.0 AS major, round(minor, 4) + 0.0 AS minor FROM z")
def pixel_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = pixels.moments(heights(spark, sf_dir), "h", SIDE).where("cx is not null").select("session", "frame_idx", "cx", "cy", "orientation", "major", "minor")
    return rounded(rounded(m, "cx", "cy", "major", digits=5), "orientation", "minor", digits=4)


WM, HM = f"673.1 * 1 / {geometry.focal_length(0)!r}", f"673.1 * 1 / {geometry.focal_length(1)!r}"


@query(FRAMES + BACKGROUND + MOMENTS + f""", a AS (SELECT session, frame_idx, count(*) FILTER (v > 10 AND v < 100) AS area_px, coalesce(avg(v) FILTER (v > 10 AND v < 100), 0) AS hm FROM h GROUP BY 1, 2),
s AS (SELECT session, frame_idx, cx, cy, least(major, minor) AS wd, greatest(major, minor) AS ln, area_px, hm, radians(orientation) AS angle, 673.1 * (cx - 256) / {geometry.focal_length(0)!r} AS mx, 673.1 * (cy - 212) / {geometry.focal_length(1)!r} AS my FROM z JOIN a USING (session, frame_idx)),
d AS (SELECT *, cx - coalesce(lag(cx) OVER w, cx) AS dx, cy - coalesce(lag(cy) OVER w, cy) AS dy, hm - coalesce(lag(hm) OVER w, hm) AS dz, mx - coalesce(lag(mx) OVER w, mx) AS dmx, my - coalesce(lag(my) OVER w, my) AS dmy FROM s WINDOW w AS (PARTITION BY session ORDER BY frame_idx))
SELECT session, frame_idx, round(cx, 4) + 0.0 AS centroid_x_px, round(cy, 4) + 0.0 AS centroid_y_px, round(sqrt(dx * dx + dy * dy), 4) + 0.0 AS velocity_2d_px, round(sqrt(dx * dx + dy * dy + dz * dz), 4) + 0.0 AS velocity_3d_px,
  round(wd, 4) + 0.0 AS width_px, round(ln, 4) + 0.0 AS length_px, area_px, round(mx, 4) + 0.0 AS centroid_x_mm, round(my, 4) + 0.0 AS centroid_y_mm, round(sqrt(dmx * dmx + dmy * dmy), 4) + 0.0 AS velocity_2d_mm,
  round(sqrt(dmx * dmx + dmy * dmy + dz * dz), 4) + 0.0 AS velocity_3d_mm, round(wd * ({HM}), 4) + 0.0 AS width_mm, round(ln * ({WM}), 4) + 0.0 AS length_mm, round(area_px * (({WM}) + ({HM})) / 2, 4) + 0.0 AS area_mm,
  round(hm, 4) + 0.0 AS height_ave_mm, round(angle, 4) + 0.0 AS angle, round(atan2(round(dmy, 9), round(dmx, 9)), 4) + 0.0 AS velocity_theta FROM d""")
def frame_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = pixels.moments(heights(spark, sf_dir), "h", SIDE).where("cx is not null")
    from framelake.schema import SCALARS

    return rounded(pixels.scalars(m, "h").select("session", "frame_idx", *SCALARS), *(c for c in SCALARS if c != "area_px"), digits=4)


@query(FRAMES + " SELECT session, frame_idx, (7 - r) * 8 + 7 - c AS i, v FROM p")
def rot180(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_pixel(frames(spark, sf_dir).withColumn("t", arrays.rotate_180(F.col("px"))), "t")


@query(FRAMES + " SELECT session, frame_idx, (7 - r) * 8 + c AS i, v FROM p")
def flip_vertical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_pixel(frames(spark, sf_dir).withColumn("t", arrays.flip_rows(F.col("px"), SIDE, SIDE)), "t")


@query(FRAMES + """, n AS (SELECT a.session, a.frame_idx, a.r, a.c, b.v FROM p a, range(-1, 2) i(dr), range(-1, 2) j(dc), p b
  WHERE b.session = a.session AND b.frame_idx = a.frame_idx AND b.r = least(7, greatest(0, a.r + dr)) AND b.c = least(7, greatest(0, a.c + dc)))
SELECT session, frame_idx, r * 8 + c AS i, median(v) AS v FROM n GROUP BY session, frame_idx, r, c""")
def median_blur3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_pixel(pixels.median_blur(frames(spark, sf_dir), "px", "m", SIDE), "m")


@query(FRAMES + """, e AS (SELECT a.session, a.frame_idx, a.r, a.c, min(b.v) AS v FROM p a JOIN p b ON b.session = a.session AND b.frame_idx = a.frame_idx AND abs(b.r - a.r) <= 1 AND abs(b.c - a.c) <= 1 GROUP BY 1, 2, 3, 4)
SELECT a.session, a.frame_idx, a.r * 8 + a.c AS i, CAST(max(b.v) AS DOUBLE) AS v FROM e a JOIN e b ON b.session = a.session AND b.frame_idx = a.frame_idx AND abs(b.r - a.r) <= 1 AND abs(b.c - a.c) <= 1 GROUP BY a.session, a.frame_idx, a.r, a.c""")
def morph_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_pixel(pixels.opened(frames(spark, sf_dir), "px", "m", SIDE), "m")


@query("WITH RECURSIVE " + FRAMES.removeprefix("WITH ") + """, on_ AS (SELECT session, frame_idx, r, c FROM p WHERE v > 65),
reach AS (SELECT session, frame_idx, r, c, r * 8 + c AS root FROM on_ UNION SELECT o.session, o.frame_idx, o.r, o.c, x.root FROM reach x JOIN on_ o ON o.session = x.session AND o.frame_idx = x.frame_idx AND abs(o.r - x.r) + abs(o.c - x.c) = 1 AND x.root < 64),
lab AS (SELECT session, frame_idx, r, c, min(root) AS label FROM reach GROUP BY 1, 2, 3, 4), sz AS (SELECT session, frame_idx, label, count(*) AS n FROM lab GROUP BY 1, 2, 3),
best AS (SELECT *, row_number() OVER (PARTITION BY session, frame_idx ORDER BY n DESC, label) AS rn FROM sz)
SELECT lab.session, lab.frame_idx, count(*) AS n, sum(r * 8 + c) AS places FROM lab JOIN best ON best.session = lab.session AND best.frame_idx = lab.frame_idx AND best.label = lab.label AND rn = 1 GROUP BY 1, 2""")
def largest_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).withColumn("m", F.transform("px", lambda v: (v > 65).cast("int")))
    out = pixels.largest_component(f, "m", "big", SIDE)
    places = F.filter(F.transform("big", lambda v, i: F.when(v > 0, i)), lambda i: i.isNotNull())
    out = out.select("session", "frame_idx", F.size(places).cast("long").alias("n"), F.aggregate(places, F.lit(0).cast("long"), lambda a, i: a + i).alias("places"))
    return out.where("n > 0")


@query(FRAMES + ", s AS (SELECT session, frame_idx, avg(v) AS m, stddev_pop(v) AS sd FROM p GROUP BY 1, 2) SELECT session, count(*) AS n_images, round(avg(m), 6) + 0.0 AS mean, round(avg(sd), 6) + 0.0 AS std FROM s GROUP BY session")
def pixel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over images of each image's mean and standard deviation."""
    n = F.size("px")
    mean = arrays.total(F.col("px")) / n
    f = frames(spark, sf_dir).withColumn("m", mean)
    sd = F.sqrt(F.aggregate("px", F.lit(0.0), lambda a, v: a + (v - F.col("m")) * (v - F.col("m"))) / n)
    return rounded(f.withColumn("sd", sd).groupBy("session").agg(F.count("*").alias("n_images"), F.avg("m").alias("mean"), F.avg("sd").alias("std")), "mean", "std")


@query(FRAMES + """, b AS (SELECT session, frame_idx, max(c) - min(c) AS w, max(r) - min(r) AS h FROM p WHERE v > 75 GROUP BY 1, 2),
a AS (SELECT *, greatest(w, h) / least(w, h) AS aspect FROM b WHERE w > 0 AND h > 0)
SELECT session, min(w) AS w_min, max(w) AS w_max, round(avg(w), 6) + 0.0 AS w_mean, median(w) AS w_median, round(stddev_pop(w), 6) + 0.0 AS w_std, min(h) AS h_min, max(h) AS h_max, round(avg(h), 6) + 0.0 AS h_mean, median(h) AS h_median, round(stddev_pop(h), 6) + 0.0 AS h_std,
  round(min(aspect), 6) + 0.0 AS a_min, round(max(aspect), 6) + 0.0 AS a_max, round(avg(aspect), 6) + 0.0 AS a_mean, round(median(aspect), 6) + 0.0 AS a_median, round(stddev_pop(aspect), 6) + 0.0 AS a_std FROM a GROUP BY session""")
def bbox_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framelake.operators.annotations import box_statistics

    b = frames(spark, sf_dir).withColumn("b", arrays.bbox(F.transform("px", lambda v: (v > 75).cast("int")), SIDE)).where("b is not null")
    out = box_statistics(b.select("session", (F.col("b.x1") - F.col("b.x0")).alias("w"), (F.col("b.y1") - F.col("b.y0")).alias("h")))
    return rounded(out, *(f"{p}_{s}" for p in "wh" for s in ("mean", "std")), *(f"a_{s}" for s in ("min", "max", "mean", "median", "std")))


@query("SELECT p_brand, min(p_size) AS size_min, max(p_size) AS size_max FROM part GROUP BY p_brand")
def size_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_size").alias("size_min"), F.max("p_size").alias("size_max"))


@query("""WITH r AS (SELECT p_brand AS session, p_partkey AS label, CAST(p_size AS DOUBLE) AS area, p_retailprice AS extent, CAST(p_partkey % 17 AS DOUBLE) AS distance FROM part),
k AS (SELECT *, count(*) OVER (PARTITION BY session ORDER BY -area RANGE UNBOUNDED PRECEDING) AS rank_area, count(*) OVER (PARTITION BY session ORDER BY -extent RANGE UNBOUNDED PRECEDING) AS rank_extent, count(*) OVER (PARTITION BY session ORDER BY distance RANGE UNBOUNDED PRECEDING) AS rank_distance FROM r)
SELECT session, label, rank_area, rank_extent, rank_distance, row_number() OVER (PARTITION BY session ORDER BY (rank_area * CAST(1.0 AS DOUBLE) + rank_extent * CAST(0.1 AS DOUBLE) + rank_distance * CAST(1.0 AS DOUBLE)) / 3, label) AS place FROM k""")
def region_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "part").select(F.col("p_brand").alias("session"), F.col("p_partkey").alias("label"), F.col("p_size").cast("double").alias("area"), F.col("p_retailprice").alias("extent"), (F.col("p_partkey") % 17).cast("double").alias("distance"))
    return pixels.rank_regions(r).select("session", "label", "rank_area", "rank_extent", "rank_distance", "place")


@query(FRAMES + ", q AS (SELECT session, frame_idx, (r // 4) * 2 + c // 4 AS i, avg(v) AS v FROM p GROUP BY 1, 2, 3) SELECT session, frame_idx, i, round(v, 6) + 0.0 AS v FROM q")
def downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(by_pixel(frames(spark, sf_dir).withColumn("s", pixels.block_mean(F.col("px"), SIDE, SIDE, 4)), "s"), "v")


@query(FRAMES + """, s AS (SELECT session, frame_idx, r, c, v, lead(v) OVER (PARTITION BY session, r, c ORDER BY frame_idx) AS w FROM p)
SELECT session, frame_idx, sum(greatest(v, w)) AS blended, sum(CASE WHEN w > 70 THEN w ELSE v END) AS over, count(*) FILTER ((r - 3) * (r - 3) + (c - 4) * (c - 4) <= 9 AND (r - 3) * (r - 3) + (c - 4) * (c - 4) >= 4 AND v > 60) AS on_ring FROM s WHERE w IS NOT NULL GROUP BY 1, 2""")
def blend_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame blended with the next, and its pixels on a ring."""
    from framelake.operators.temporal import in_order

    f = frames(spark, sf_dir).withColumn("nx", F.lead("px").over(in_order())).where("nx is not null")
    add = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, v: s + v)
    ring = arrays.ring(SIDE, SIDE, 4.0, 3.0, 3.0, 1.0)
    on = F.zip_with("px", ring, lambda v, m: F.when((m > 0) & (v > 60), F.lit(1)).otherwise(F.lit(0)))
    return f.select("session", "frame_idx", add(arrays.blend_max(F.col("px"), F.col("nx"))).alias("blended"), add(arrays.blend_over(F.col("px"), F.col("nx"), 70)).alias("over"), add(on).alias("on_ring"))


@query(FRAMES + """, s AS (SELECT * FROM (VALUES (0, 0, 0), (1, 6, 1), (2, 5, 6), (3, 1, 7)) v(o, x, y)),
c AS (SELECT DISTINCT session, frame_idx FROM f),
v AS (SELECT session, frame_idx, o, CAST(x + (frame_idx + session) % 3 AS DOUBLE) AS x, CAST(y + frame_idx % 2 AS DOUBLE) AS y FROM c, s),
e AS (SELECT a.session, a.frame_idx, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1 FROM v a JOIN v b ON b.session = a.session AND b.frame_idx = a.frame_idx AND b.o = (a.o + 1) % 4)
SELECT session, frame_idx, round(sum(x0 * y1 - x1 * y0) / 2, 6) + 0.0 AS m00, round(sum((x0 * y1 - x1 * y0) * (x0 + x1)) / 6, 6) + 0.0 AS m10, round(sum((x0 * y1 - x1 * y0) * (y0 + y1)) / 6, 6) + 0.0 AS m01 FROM e GROUP BY 1, 2""")
def contour_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    corner = lambda x, y: F.struct((x + (F.col("frame_idx") + F.col("session")) % 3).cast("double").alias("x"), (y + F.col("frame_idx") % 2).cast("double").alias("y"))
    f = frames(spark, sf_dir).withColumn("v", F.array(corner(F.lit(0), F.lit(0)), corner(F.lit(6), F.lit(1)), corner(F.lit(5), F.lit(6)), corner(F.lit(1), F.lit(7))))
    m = pixels.contour_moments(F.col("v"))
    return rounded(f.select("session", "frame_idx", *(m[k].alias(k) for k in ("m00", "m10", "m01"))), "m00", "m10", "m01")
