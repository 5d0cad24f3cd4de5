"""Edits of results."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import editing
from framelake.queries.joins import RANGES, error_ranges
from framelake.queries.registry import FRAMES, T, frames, query, rounded, trajectory


@query(RANGES + f""", m AS (SELECT t.session, t.frame_idx, bool_or(r.start IS NOT NULL) AS f FROM t LEFT JOIN r ON r.session = t.session AND t.frame_idx >= r.start AND t.frame_idx < r.stop GROUP BY 1, 2),
a AS (SELECT t.session, t.frame_idx, radians(angle) AS a, f, (frame_idx % 5 = 0) <> f AS flip FROM t JOIN m USING (session, frame_idx))
SELECT session, frame_idx, flip, round(CASE WHEN f THEN (a + {math.pi!r}) - {2 * math.pi!r} * floor((a + {math.pi!r}) / {2 * math.pi!r}) ELSE a END, 6) + 0.0 AS angle FROM a""")
def apply_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trajectory(spark, sf_dir).select("session", "frame_idx", F.radians("angle").alias("angle"), (F.col("frame_idx") % 5 == 0).alias("flip"))
    return rounded(editing.flipped(t, error_ranges(spark, sf_dir), angle="angle").select("session", "frame_idx", "flip", "angle"), "angle")


@query(FRAMES + " SELECT session, frame_idx, CASE WHEN frame_idx BETWEEN 3 AND 7 THEN 63 - (r * 8 + c) ELSE r * 8 + c END AS i, v FROM p")
def apply_flips_to_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    ranges = f.select("session").distinct().select("session", F.lit(3).cast("long").alias("start"), F.lit(8).cast("long").alias("stop"))
    return editing.flipped(f, ranges, pixels="px").select("session", "frame_idx", F.posexplode("px").alias("i", "v"))


@query(T + ", r AS (SELECT session, frame_idx, unnest([frame_idx % 2 = 0, frame_idx % 3 = 0, state = 'error']) AS flip FROM t) SELECT session, frame_idx, bit_xor(CAST(flip AS INTEGER)) = 1 AS flip FROM r GROUP BY 1, 2")
def flip_xor(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trajectory(spark, sf_dir)
    revisions = t.select("session", "frame_idx", F.explode(F.array(F.col("frame_idx") % 2 == 0, F.col("frame_idx") % 3 == 0, F.col("state") == "error")).alias("flip"))
    return editing.combined_flips(revisions)


@query(T + ", s AS (SELECT session, x AS sx FROM t WHERE frame_idx = 4) SELECT session, frame_idx, CASE WHEN frame_idx = 9 AND sx IS NOT NULL THEN sx ELSE x END AS x FROM t LEFT JOIN s USING (session)")
def copy_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editing.copied(trajectory(spark, sf_dir).select("session", "frame_idx", "x"), 4, 9, ["x"])


@query(T + " SELECT session, frame_idx - 10 AS frame_idx, x FROM t WHERE frame_idx >= 10 AND frame_idx < 30")
def trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editing.trimmed(trajectory(spark, sf_dir).select("session", "frame_idx", "x"), 10, 30)


@query(T + ", n AS (SELECT session, max(frame_idx) + 1 AS n FROM t GROUP BY session) SELECT session, frame_idx - 10 AS frame_idx, x FROM t JOIN n USING (session) WHERE frame_idx >= 10 AND frame_idx < n - 5")
def trim_from_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editing.trimmed(trajectory(spark, sf_dir).select("session", "frame_idx", "x"), 10, -5)
