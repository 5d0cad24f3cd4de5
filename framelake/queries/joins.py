"""Joins: nearest times, ranges, overlaps, unprocessed sessions, set lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import asof, editing, intervals, statistics
from framelake.queries.registry import T, query, rounded, table, trajectory
from framelake.queries.series import OUTLIERS, jumps


@query(T + """, q AS (SELECT session, frame_idx, ts_ms FROM t WHERE state = 'click'), r AS (SELECT session, frame_idx AS i, CAST(ts_ms AS DOUBLE) AS rt FROM t WHERE state = 'view'),
j AS (SELECT q.session, q.frame_idx, i, rt, row_number() OVER (PARTITION BY q.session, q.frame_idx ORDER BY abs(rt - ts_ms), i) AS rn FROM q LEFT JOIN r ON r.session = q.session)
SELECT session, frame_idx, i AS nearest, rt AS nearest_time FROM j WHERE rn = 1""")
def nearest_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each click the view nearest in time."""
    t = trajectory(spark, sf_dir)
    return asof.nearest(t.where("state = 'click'").select("session", "frame_idx", "ts_ms"), t.where("state = 'view'").select("session", "frame_idx", "ts_ms")).drop("ts_ms")


def error_ranges(spark: SparkSession, sf_dir: str, length: int = 3) -> DataFrame:
    return trajectory(spark, sf_dir).where("state = 'error'").select("session", F.col("frame_idx").alias("start"), (F.col("frame_idx") + length).alias("stop"))


RANGES = T + ", r AS (SELECT session, frame_idx AS start, frame_idx + 3 AS stop FROM t WHERE state = 'error')"


@query(RANGES + " SELECT t.session, t.frame_idx, bool_or(r.start IS NOT NULL) AS flip FROM t LEFT JOIN r ON r.session = t.session AND t.frame_idx >= r.start AND t.frame_idx < r.stop GROUP BY 1, 2")
def range_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.mark(trajectory(spark, sf_dir).select("session", "frame_idx"), error_ranges(spark, sf_dir), "flip")


@query(RANGES + " SELECT a.session, a.start AS start_a, a.stop AS stop_a, b.start AS start_b, b.stop AS stop_b FROM r a JOIN r b ON a.session = b.session AND a.start < b.start AND greatest(a.start, b.start) < least(a.stop, b.stop)")
def range_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlaps(error_ranges(spark, sf_dir), span=16)


@query(RANGES + """, m AS (SELECT session, max(frame_idx) + 1 AS n FROM t GROUP BY session)
SELECT r.session, printf('range (%d, %d) stops over %d', start, stop, n) AS fault FROM r JOIN m USING (session) WHERE stop > n
UNION ALL SELECT a.session, printf('range (%d, %d) overlaps range (%d, %d)', a.start, a.stop, b.start, b.stop) FROM r a JOIN r b ON a.session = b.session AND a.start < b.start AND greatest(a.start, b.start) < least(a.stop, b.stop)""")
def verify_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trajectory(spark, sf_dir)
    r = error_ranges(spark, sf_dir).join(t.groupBy("session").agg((F.max("frame_idx") + 1).alias("n")), "session")
    single = intervals.faults(r, 0, F.col("n"))
    return single


@query("SELECT c_custkey, c_nationkey FROM customer c WHERE EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey AND n.n_regionkey < 3) AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')")
def unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with metadata (a nation of some regions) and without a finished order: a semi and an anti join."""
    n = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"))
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(n, "c_nationkey", "left_semi").join(done, "c_custkey", "left_anti").select("c_custkey", "c_nationkey")


@query("""SELECT p_partkey, p_name FROM part WHERE list_has_any(list_distinct(list_filter(list_transform(string_split(replace(p_name, ' ', chr(13) || chr(10)), chr(13) || chr(10)), lambda x: trim(x)), lambda x: x <> '' AND x <> 'nan')), ['ring', 'widget', 'bolt'])""")
def class_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose list of name words has any of some words."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    words = statistics.listed_values(F.replace("p_name", F.lit(" "), F.lit("\r\n")))
    return statistics.matching(p, words, ["ring", "widget", "bolt"])


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def static_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lookups in small tables; Spark broadcasts them by their size."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query(T + """, a AS (SELECT session, row_number() OVER (PARTITION BY session ORDER BY frame_idx) AS n, frame_idx AS task FROM t WHERE state = 'view'), b AS (SELECT session, row_number() OVER (PARTITION BY session ORDER BY frame_idx) AS n, frame_idx AS prediction FROM t WHERE state = 'click')
SELECT session, n, task, prediction FROM a JOIN b USING (session, n)""")
def positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The n-th view of a user with the n-th click."""
    from pyspark.sql import Window

    t = trajectory(spark, sf_dir)
    n = F.row_number().over(Window.partitionBy("session").orderBy("frame_idx")).cast("long").alias("n")
    a = t.where("state = 'view'").select("session", n, F.col("frame_idx").alias("task"))
    b = t.where("state = 'click'").select("session", n, F.col("frame_idx").alias("prediction"))
    return a.join(b, ["session", "n"])


@query(OUTLIERS + """, e2 AS (SELECT session, frame_idx FROM t WHERE state = 'error') SELECT session, frame_idx FROM o INTERSECT SELECT session, frame_idx FROM e2""")
def index_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jumps(spark, sf_dir).intersect(trajectory(spark, sf_dir).where("state = 'error'").select("session", "frame_idx"))


@query(OUTLIERS + """, e2 AS (SELECT session, frame_idx FROM t WHERE state = 'error') SELECT session, frame_idx FROM o EXCEPT SELECT session, frame_idx FROM e2""")
def index_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jumps(spark, sf_dir).subtract(trajectory(spark, sf_dir).where("state = 'error'").select("session", "frame_idx"))


@query(OUTLIERS + """, e2 AS (SELECT session, frame_idx FROM t WHERE state = 'error'), u AS (SELECT *, 1 AS s FROM o UNION ALL SELECT *, 2 FROM e2) SELECT session, frame_idx FROM u GROUP BY 1, 2 HAVING count(*) = 1""")
def index_symmetric_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editing.symmetric_difference(jumps(spark, sf_dir), trajectory(spark, sf_dir).where("state = 'error'").select("session", "frame_idx"))


@query(OUTLIERS + """, n AS (SELECT session, frame_idx FROM t WHERE y > 95) SELECT session, frame_idx FROM o UNION SELECT session, frame_idx FROM n""")
def outlier_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames that any of two tests finds, each once."""
    return jumps(spark, sf_dir).unionByName(trajectory(spark, sf_dir).where("y > 95").select("session", "frame_idx")).distinct()


@query("SELECT count(*) AS n_a, count(*) AS n_b, true AS equal FROM lineitem")
def roundtrip_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items against themselves dealt anew: the same rows, each as often."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    return editing.same_rows(items, items.repartition("l_partkey"))


MASKS = """WITH f AS (SELECT vec_id, label AS session, embedding AS e FROM embeddings), m AS (SELECT session, vec_id, row_number() OVER (PARTITION BY session ORDER BY vec_id) - 1 AS n, list_transform(e, lambda v: CASE WHEN v > 0.05 THEN 1 ELSE 0 END) AS mask FROM f),
i AS (SELECT session, n // 4 AS frame_idx, n % 4 AS instance, mask FROM m)"""


@query(MASKS + """, x AS (SELECT a.session, a.frame_idx, a.instance AS a, b.instance AS b, list_sum(list_transform(list_zip(a.mask, b.mask), lambda z: z[1] * z[2])) AS inter, list_sum(list_transform(list_zip(a.mask, b.mask), lambda z: greatest(z[1], z[2]))) AS uni
  FROM i a JOIN i b ON a.session = b.session AND a.frame_idx = b.frame_idx AND a.instance < b.instance)
SELECT session, frame_idx, a, b, round(inter / uni, 6) + 0.0 AS iou FROM x""")
def mask_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of each two instances of a frame."""
    from framelake.operators.tracking import mask_iou as iou
    from framelake.queries.models import instances

    return rounded(iou(instances(spark, sf_dir)), "iou")
