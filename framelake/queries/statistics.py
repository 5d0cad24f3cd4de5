"""Statistics: confusion, pivots, histograms, ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import statistics
from framelake.queries.registry import T, query, rounded, table, trajectory

CONFUSION = """WITH j AS (SELECT d.doc_id, toxic = 1 AS a, n_chars, l.x AS cut FROM documents d JOIN labels USING (doc_id), (VALUES (500), (1000), (2000), (4000)) l(x)),
c AS (SELECT cut, count(*) FILTER (a AND n_chars > cut) AS tp, count(*) FILTER (NOT a AND n_chars > cut) AS fp, count(*) FILTER (NOT a AND n_chars <= cut) AS tn, count(*) FILTER (a AND n_chars <= cut) AS fn FROM j GROUP BY cut),
s AS (SELECT cut, tp, fp, tn, fn, round(tp / nullif(tp + fn, 0), 6) + 0.0 AS sensitivity, round(tn / nullif(tn + fp, 0), 6) + 0.0 AS specificity, round(tp / nullif(tp + fp, 0), 6) + 0.0 AS precision, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) + 0.0 AS f1 FROM c)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id")
    d = d.withColumn("cut", F.explode(F.array(*(F.lit(x) for x in (500, 1000, 2000, 4000)))))
    return rounded(statistics.confusion(d, F.col("toxic") == 1, F.col("n_chars") > F.col("cut"), "cut"), "sensitivity", "specificity", "precision", "f1")


@query(CONFUSION + " SELECT * FROM s")
def confusion_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir)


@query(CONFUSION + " SELECT * FROM s WHERE f1 IS NOT NULL ORDER BY f1 DESC, cut LIMIT 1")
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.best(scored(spark, sf_dir), "f1", "cut")


@query("""SELECT o_orderpriority, coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END), 0) AS "F", coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN 1 END), 0) AS "O", coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN 1 END), 0) AS "P" FROM orders GROUP BY 1""")
def problem_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.pivot(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(T + " SELECT state, CAST(least(floor((x - 0) / 10.0), 19) AS BIGINT) AS bin, count(*) AS n FROM t WHERE x BETWEEN 0 AND 200 GROUP BY 1, 2")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.histogram(trajectory(spark, sf_dir), "x", 0, 200, 20, "state")


@query(T + " SELECT session, round(avg(CASE WHEN state <> 'error' THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS reviewed FROM t GROUP BY session")
def reviewed_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trajectory(spark, sf_dir).groupBy("session").agg(F.avg((F.col("state") != "error").cast("double")).alias("reviewed")), "reviewed")


@query("SELECT count(DISTINCT o_orderstatus) AS n_o_orderstatus, count(DISTINCT o_orderpriority) AS n_o_orderpriority, false AS consistent FROM orders")
def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.consistent(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query(T + ", g AS (SELECT session, ts_ms - lag(ts_ms) OVER (PARTITION BY session ORDER BY frame_idx) AS gap FROM t) SELECT session, count(*) FILTER (gap > 600000) AS over_10_min, count(*) FILTER (gap <= 10000) AS under_10_s, median(CAST(gap AS DOUBLE)) AS median_gap FROM g WHERE gap IS NOT NULL GROUP BY session")
def gap_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pauses between a user's events against ten minutes and ten seconds."""
    from framelake.operators.temporal import in_order

    g = trajectory(spark, sf_dir).withColumn("gap", F.col("ts_ms") - F.lag("ts_ms").over(in_order())).where("gap is not null")
    return g.groupBy("session").agg(F.count_if(F.col("gap") > 600000).alias("over_10_min"), F.count_if(F.col("gap") <= 10000).alias("under_10_s"), F.percentile("gap", F.lit(0.5)).alias("median_gap"))


@query(T + ", c AS (SELECT session, date_trunc('hour', make_timestamp_ms(ts_ms)) AS hour, count(*) AS n, round(sum(x), 6) + 0.0 AS total FROM t GROUP BY 1, 2) SELECT session, epoch_ms(hour) AS hour_ms, n, total FROM c")
def tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extension: counts by hour of event time."""
    t = trajectory(spark, sf_dir).withColumn("hour_ms", F.floor(F.col("ts_ms") / 3_600_000) * 3_600_000)
    return rounded(t.groupBy("session", "hour_ms").agg(F.count("*").alias("n"), F.sum("x").alias("total")), "total")
