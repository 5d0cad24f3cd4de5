"""Samples and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import sampling
from framelake.queries.registry import T, frames, query, table, trajectory


@query("SELECT doc_id FROM documents ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 50")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_rows(table(spark, sf_dir, "documents").select("doc_id"), 50, 7, "doc_id")


@query(T + ", n AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY md5('3:' || CAST(session AS VARCHAR) || ':' || CAST(frame_idx AS VARCHAR)), frame_idx) AS n FROM t) SELECT session, frame_idx FROM n WHERE n <= 5")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.per_group(trajectory(spark, sf_dir), 5, 3, "session", "frame_idx").select("session", "frame_idx")


@query(T + ", c AS (SELECT session, greatest(1, count(*) // 6) AS step FROM t GROUP BY session) SELECT session, frame_idx FROM t JOIN c USING (session) WHERE frame_idx >= step AND frame_idx % step = 0")
def uniform_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.uniform(trajectory(spark, sf_dir), 6).select("session", "frame_idx")


@query(T + ", l AS (SELECT * FROM (VALUES (0, 9), (1, 2), (2, 40), (3, 2)) l(place, frame_idx)) SELECT session, frame_idx, place, x FROM t JOIN l USING (frame_idx)")
def index_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.listed(trajectory(spark, sf_dir), [9, 2, 40, 2]).select("session", "frame_idx", "place", "x")


@query(T + " SELECT session, frame_idx FROM (SELECT * FROM t WHERE frame_idx IN (1, 3, 5, 8, 13, 21, 34)) ORDER BY md5('5:' || CAST(session AS VARCHAR) || ':' || CAST(frame_idx AS VARCHAR)), session, frame_idx LIMIT 40")
def restricted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = sampling.listed(trajectory(spark, sf_dir), [1, 3, 5, 8, 13, 21, 34])
    return sampling.random_rows(allowed, 40, 5, "session", "frame_idx").select("session", "frame_idx")


@query("WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('11:' || CAST(doc_id AS VARCHAR)), doc_id) AS n, count(*) OVER () AS c FROM documents) SELECT doc_id, CASE WHEN n <= floor(c * 0.9) THEN 'train' ELSE 'test' END AS fold FROM r")
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split(table(spark, sf_dir, "documents").select("doc_id"), 0.9, 11, "doc_id")


@query("SELECT source, CAST(ceil(500 / (SELECT count(DISTINCT source) FROM documents)) AS BIGINT) AS n FROM documents GROUP BY source")
def per_file_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of 500 samples each file gives."""
    sources = table(spark, sf_dir, "documents").select("source").distinct()
    count = sources.agg(F.count("*").alias("c"))
    return sources.crossJoin(F.broadcast(count)).select("source", sampling.per_file(500, F.col("c")).cast("long").alias("n"))


@query(T + ", c AS (SELECT session, least(count(*), 25) AS n FROM t GROUP BY session) SELECT session, n FROM c")
def capped_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory(spark, sf_dir).groupBy("session").agg(F.least(F.count("*"), F.lit(25).cast("long")).alias("n"))


@query()
def kmeans_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three random frames of each of eight clusters."""
    return sampling.diverse(frames(spark, sf_dir), "px", 24, 8, 1).select("session", "frame_idx", "cluster")
