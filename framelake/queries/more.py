"""False colours, composites, names, similarity of keypoints, image files, throughput and settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import colour
from framelake.operators import augment, composites, evaluation
from framelake.plans import progress
from framelake.queries.registry import FRAMES, POINTS, SIDE, T, frames, points, query, rounded, table, trajectory
from framelake.schema import BODY_PARTS
from framelake.sources import images


def _ramp(points_: list[tuple[float, float]]) -> str:
    cases = " ".join(f"WHEN x < {x1!r} THEN {y0!r}::DOUBLE + (x - {x0!r}::DOUBLE) * {(y1 - y0) / (x1 - x0)!r}::DOUBLE" for (x0, y0), (x1, y1) in zip(points_, points_[1:], strict=False))
    return f"CAST(floor((CASE {cases} ELSE {points_[-1][1]!r}::DOUBLE END) * 255) AS INTEGER)"


@query(FRAMES + """, s AS (SELECT session, frame_idx, r * 8 + c AS i, least(floor(greatest(0.0, least(1.0, (CAST(v AS DOUBLE) - 20) / 100)) * 256), 255) / 255.0::DOUBLE AS x FROM p)
SELECT session, frame_idx, i, """ + ", ".join(f"{_ramp(colour.JET[c])} AS {c}" for c in "rgb") + " FROM s")
def colourise(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select("session", "frame_idx", F.posexplode(colour.colourise(F.col("px"), 20, 120)).alias("i", "k"))
    return f.select("session", "frame_idx", "i", "k.*")


@query(FRAMES + """, d AS (SELECT session, frame_idx, r * 12 + c AS i, CAST(v AS DOUBLE) AS v FROM p UNION ALL SELECT session, frame_idx, (8 + r // 2) * 12 + 8 + c // 2, avg(v) FROM p GROUP BY session, frame_idx, r // 2, c // 2),
z AS (SELECT session, frame_idx, i FROM f, range(144) g(i)) SELECT z.session, z.frame_idx, z.i, coalesce(round(d.v, 6) + 0.0, 0.0) AS v FROM z LEFT JOIN d ON d.session = z.session AND d.frame_idx = z.frame_idx AND d.i = z.i""")
def stack_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame and itself at half the size, diagonally."""
    from framelake.operators.pixels import block_mean

    f = frames(spark, sf_dir).withColumn("s", block_mean(F.col("px"), SIDE, SIDE, 2))
    whole, _, _ = composites.stacked([(F.col("px"), SIDE, SIDE), (F.col("s"), SIDE // 2, SIDE // 2)], "diagonal")
    return rounded(f.select("session", "frame_idx", F.posexplode(whole).alias("i", "v")), "v")


@query("""WITH f AS (SELECT source AS session, len(string_split(text, ' ')) % 3 + 1 AS n FROM documents)
SELECT session, count(DISTINCT n) AS n_sizes, CASE WHEN count(DISTINCT n) > 1 THEN printf('frames have %d to %d pixels', min(n), max(n)) END AS fault FROM f GROUP BY session""")
def frame_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("session"), F.array_repeat(F.lit(1), F.size(F.split("text", " ")) % 3 + 1).alias("px"))
    return composites.uniform_sizes(d)


@query("""WITH t AS (SELECT DISTINCT source, doc_id % 9 AS k FROM documents WHERE doc_id % 9 <> 4), s AS (SELECT DISTINCT source FROM documents), g AS (SELECT source, i FROM s, range(0, 12) g(i)),
free AS (SELECT g.source, g.i FROM g LEFT JOIN t ON t.source = g.source AND t.k = g.i WHERE t.k IS NULL),
base AS (SELECT source, max(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS held FROM t GROUP BY source)
SELECT source, CASE WHEN coalesce(held, 0) = 0 THEN '/out/run.v2.h5' ELSE concat('/out/run.v2-', (SELECT min(i) FROM free WHERE free.source = s.source AND i >= 1), '.h5') END AS dashed,
  CASE WHEN coalesce(held, 0) = 0 THEN '/out/run.v2.h5' ELSE concat('/out/run.v2.backup-', 1, '.h5') END AS backup FROM s LEFT JOIN base USING (source)""")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First free names where some numbered ones are taken."""
    d = table(spark, sf_dir, "documents").withColumn("k", F.col("doc_id") % 9)
    name = F.when(F.col("k") == 0, F.lit("/out/run.v2.h5")).otherwise(F.format_string("/out/run.v2-%d.h5", "k"))
    taken = d.groupBy("source").agg(F.collect_set(F.when(F.col("k") != 4, name)).alias("taken"))
    wanted = F.lit("/out/run.v2.h5")
    return taken.select("source", composites.free_name(wanted, F.col("taken")).alias("dashed"), composites.free_name(wanted, F.col("taken"), ".backup-").alias("backup"))


SIGMA = ", ".join(f"({i}, {s!r}::DOUBLE)" for i, s in enumerate(evaluation.SIGMAS))
OKS = POINTS + f""", sg AS (SELECT * FROM (VALUES {SIGMA}) s(ord, sigma)),
d AS (SELECT session, frame_idx, ord, CASE WHEN (session + frame_idx + ord) % 11 <> 0 THEN (score * 9) * (score * 9) + (frame_idx % 5) * (frame_idx % 5) END AS d2 FROM k),
o AS (SELECT session, frame_idx, avg(coalesce(exp(-d2 / (2 * 2500.0::DOUBLE * (2 * sigma) * (2 * sigma))), 0.0)) AS oks FROM d JOIN sg USING (ord) GROUP BY 1, 2)"""


def _similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points against themselves moved a little; some aren't predicted."""
    k = points(spark, sf_dir)
    moved = k.where((F.col("session") + F.col("frame_idx") + F.col("ord")) % 11 != 0).select("session", "frame_idx", "part", (F.col("x") + F.col("score") * 9).alias("x"), (F.col("y") + F.col("frame_idx") % 5).alias("y"))
    return evaluation.similarity(moved, k, F.lit(2500.0))


@query(OKS + " SELECT session, frame_idx, round(oks, 6) + 0.0 AS oks FROM o")
def keypoint_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_similar(spark, sf_dir), "oks")


@query(OKS + """, s AS (SELECT session, frame_idx, round(oks, 6) AS oks, ((session * 31 + frame_idx * 17) % 97) / 97.0::DOUBLE AS score FROM o), n AS (SELECT count(*) + 20 AS n FROM s),
t AS (SELECT round(0.5::DOUBLE + 0.05::DOUBLE * i, 2) AS threshold FROM range(10) g(i)),
r AS (SELECT threshold, CASE WHEN oks >= threshold THEN 1 ELSE 0 END AS hit, sum(CASE WHEN oks >= threshold THEN 1 ELSE 0 END) OVER w AS hits, row_number() OVER w AS rank FROM s, t WINDOW w AS (PARTITION BY threshold ORDER BY score DESC, session, frame_idx ROWS UNBOUNDED PRECEDING)),
l AS (SELECT threshold, i AS level FROM t, range(101) g(i)),
b AS (SELECT l.threshold, l.level, coalesce(max(hits / rank) FILTER (hits > 0 AND floor(hits * 100 / n) >= l.level), 0) AS p FROM l, n, r WHERE r.threshold = l.threshold GROUP BY 1, 2)
SELECT threshold, round(avg(p), 6) + 0.0 AS ap FROM b GROUP BY threshold""")
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = rounded(_similar(spark, sf_dir), "oks").withColumn("score", (F.col("session") * 31 + F.col("frame_idx") * 17) % 97 / 97.0)
    return rounded(evaluation.average_precision(s, s.count() + 20), "ap")


@query(T + " SELECT session, count(*) AS n_frames, round((max(ts_ms) - min(ts_ms)) / 1000, 6) + 0.0 AS seconds, round(count(*) / nullif((max(ts_ms) - min(ts_ms)) / 1000, 0), 6) + 0.0 AS rate FROM t GROUP BY session")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(progress.throughput(trajectory(spark, sf_dir), "ts_ms"), "seconds", "rate")


@query("SELECT * FROM (VALUES ('depth', '673.1'), ('every', '1'), ('high', '100'), ('length', '80.0'), ('low', '10'), ('smooth', 'False'), ('track', 'True')) v(name, value)")
def default_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(k, str(v)) for k, v in sorted(progress.default_settings().items())], "name string, value string")


@query(FRAMES + """, t AS (SELECT session, frame_idx, 65535 // max(v) AS k FROM p GROUP BY 1, 2), n AS (SELECT session, frame_idx, r, c, greatest(v, 0) AS v FROM p)
SELECT session, frame_idx, r * 8 + c AS i, CAST(k AS VARCHAR) AS factor, CAST(v * k AS INTEGER) AS stored, CAST(v AS DOUBLE) AS depth FROM n JOIN t USING (session, frame_idx)""")
def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames as scaled 16-bit image files, read again: what was stored and what it stands for."""
    f = frames(spark, sf_dir)
    px, factor = images.scaled(F.col("px"))
    f = f.withColumns({"q_px": px, "q_factor": factor, "path": F.format_string("%d/%d", "session", "frame_idx")})
    png = images.decoded(images.encoded(f.where("frame_idx % 2 = 0"), "q_px", SIDE, "q_factor"))
    tiff = images.decoded(images.encoded(f.where("frame_idx % 2 = 1"), "q_px", SIDE, "q_factor", form="tiff"))
    back = png.unionByName(tiff).withColumn("factor", F.get_json_object("description", "$.scale_factor"))
    back = back.withColumn("depth", images.unscaled(F.col("px"), F.col("factor"), F.col("bits")))
    rows = back.select(F.split("path", "/").alias("k"), "factor", F.posexplode(F.arrays_zip("px", "depth")).alias("i", "x"))
    return rows.select(F.get("k", F.lit(0)).cast("int").alias("session"), F.get("k", F.lit(1)).cast("long").alias("frame_idx"), "i", "factor", F.col("x.px").alias("stored"), "x.depth")


@query()
def random_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the frames with a random field added."""
    out = augment.blended(frames(spark, sf_dir), "px", SIDE, seed=3)
    added = F.zip_with("augmented", "px", lambda a, v: a - v)
    return rounded(out.select("session", "frame_idx", F.array_max(added).alias("most"), F.array_min(added).alias("least")), "most", "least")


assert len(evaluation.SIGMAS) == len(BODY_PARTS)
