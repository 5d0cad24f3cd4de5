"""Streaming twins of the stateful operators, and event-time windows."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from framelake.operators.tracking import Tracker
from framelake.session import share_code


def tracked(detections: DataFrame, reach: float = 50.0, most_hits: int = 3, by: str = "session", order: str = "frame_idx") -> DataFrame:
    """A stream of (session, frame_idx, instance, x, y) with tracks and ages; a session's tracks are its state.

    Rows of a trigger are put in frame order; a frame that comes after a later one was seen is taken as it comes.
    """
    share_code(detections.sparkSession)
    kind = detections.schema[by].dataType.simpleString()

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracks, after = pickle.loads(state.get[0]) if state.exists else ([], 0)
        tracker = Tracker(reach, most_hits, tracks, after)
        rows = pd.concat(list(parts)).sort_values([order, "instance"], ignore_index=True)
        out = []
        for frame, own in rows.groupby(order, sort=True):
            found = tracker.step(list(zip(own["x"], own["y"], strict=True)))
            out.append(pd.DataFrame({by: key[0], order: frame, "instance": own["instance"].to_numpy(), "track": np.array([t for t, _ in found], np.int32), "age": np.array([a for _, a in found], np.int32)}))
        state.update((pickle.dumps((tracker.tracks, tracker.after)),))
        yield pd.concat(out)

    return detections.groupBy(by).applyInPandasWithState(run, f"{by} {kind}, {order} long, instance long, track int, age int", "state binary", "append", GroupStateTimeout.NoTimeout)


def window_counts(events: DataFrame, time: str, key: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by key and tumbling window of event time; windows close when the watermark passes."""
    return events.withWatermark(time, late).groupBy(F.window(time, length).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def session_counts(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by key and session, which a gap ends."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def replay(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """All that a stream has now, through its query, into a Parquet folder; the rows that came out.

    ``folder`` must be shared by driver and executors.
    """
    spark: SparkSession = stream.sparkSession
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
    else:

        def put(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/out")

        query = stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{folder}/state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
