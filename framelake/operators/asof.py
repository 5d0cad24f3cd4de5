"""Nearest-timestamp joins between streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.operators.temporal import keyed


def nearest(queries: DataFrame, reference: DataFrame, time: str = "ts_ms", index: str = "frame_idx", by: str | list[str] = "session", into: str = "nearest") -> DataFrame:
    """For each query row the reference row of its session with the nearest time, as ``into`` (index) and ``into``_time.

    Ties go to the lower index. Both streams are merged in time order and each query looks back and ahead to the next
    reference row: one sort, whatever the sizes, in place of a pairwise comparison.
    """
    keys = keyed(by)
    # of reference rows at one time the first counts
    ref = reference.groupBy(*keys, F.col(time).cast("double").alias("q_t")).agg(F.min(index).alias("q_i"))
    rows = queries.withColumn("q_t", F.col(time).cast("double"))
    both = rows.withColumn("q_ref", F.lit(None).cast("struct<t:double,i:bigint>")).unionByName(ref.withColumn("q_ref", F.struct(F.col("q_t").alias("t"), F.col("q_i").cast("bigint").alias("i"))).drop("q_i"), allowMissingColumns=True)
    both = both.withColumn("q_query", F.when(F.col("q_ref").isNull(), 1).otherwise(0))
    order = Window.partitionBy(*keys).orderBy("q_t", "q_query")
    back = F.last("q_ref", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("q_ref", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    found = both.withColumns({"q_back": back, "q_ahead": ahead}).where("q_query = 1")
    b, a, t = F.col("q_back"), F.col("q_ahead"), F.col("q_t")
    to_b, to_a = F.abs(t - b["t"]), F.abs(a["t"] - t)
    take_b = a.isNull() | (to_b < to_a) | ((to_b == to_a) & (b["i"] <= a["i"]))
    best = F.when(b.isNull(), a).when(take_b, b).otherwise(a)
    return found.withColumn("q_best", best).select(*queries.columns, F.col("q_best.i").alias(into), F.col("q_best.t").alias(f"{into}_time"))
