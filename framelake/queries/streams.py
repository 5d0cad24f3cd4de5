"""Streams: the driver's events replayed through streaming queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.queries.registry import query, table
from framelake.session import shared_folder
from framelake.streaming import trackers


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", "true").parquet(sf_dir)


def state_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's shared one."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


@query()
def stream_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user, each a detection, tracked by a stateful stream."""
    e = event_stream(spark, sf_dir).select(F.col("user_id").alias("session"), F.col("event_id").alias("frame_idx"), F.lit(0).cast("long").alias("instance"), F.col("value").alias("x"), F.get_json_object("props", "$.k").cast("double").alias("y"))
    return trackers.replay(trackers.tracked(e), state_folder(spark))


@query("SELECT epoch_ms(date_trunc('hour', ts)) AS start_ms, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by hour of event time, from a stream run to its end."""
    e = event_stream(spark, sf_dir).withColumn("time", F.col("ts").cast("timestamp"))
    out = trackers.replay(trackers.window_counts(e, "time", "event_type"), state_folder(spark), "complete")
    return out.select(F.unix_millis("start").alias("start_ms"), "event_type", "n")
