"""How far and how fast a run is, and what it ran with."""

from __future__ import annotations

import inspect
import json
import platform
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from framelake.plans import extract as extraction


class Meter:
    """Counts the rows that pass through a table while it's computed: ``rate`` is rows a second once the action is over."""

    def __init__(self, name: str = "rows"):
        self.seen, self.began = Observation(name), time.monotonic()

    def through(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, F.count("*").alias("n"))

    def rate(self) -> tuple[int, float]:
        """Rows and rows a second; waits for the action."""
        n = self.seen.get["n"]
        return n, n / max(time.monotonic() - self.began, 1e-9)


def with_status(spark: SparkSession, action: Callable[[], object], status: Callable[[dict], None], every: float = 30.0, wait: float = 3.0) -> object:
    """Runs an action and calls ``status`` now and then with the numbers of running stages and tasks, and once at its end.

    Errors of the action are raised here, after the last status; an error of ``status`` ends the reports, not the action.
    """
    tracker, over = spark.sparkContext.statusTracker(), threading.Event()

    def report(state: str) -> None:
        stages = [s for s in map(tracker.getStageInfo, tracker.getActiveStageIds()) if s]
        status({"state": state, "stages": len(stages), "tasks": sum(s.numTasks for s in stages), "done": sum(s.numCompletedTasks for s in stages), "failed": sum(s.numFailedTasks for s in stages)})

    def loop() -> None:
        while not over.wait(every):
            report("running")

    thread = threading.Thread(target=loop, daemon=True)
    thread.start()
    try:
        out = action()
    except BaseException:
        over.set()
        thread.join(wait)
        report("failed")
        raise
    over.set()
    thread.join(wait)
    report("done")
    return out


def throughput(frames: DataFrame, time: str, by: str = "session") -> DataFrame:
    """(by, n_frames, seconds, rate): frames a second of each recording by its first and last time in milliseconds; null without a duration."""
    found = frames.groupBy(by).agg(F.count("*").alias("n_frames"), ((F.max(time) - F.min(time)) / 1000).alias("seconds"))
    return found.withColumn("rate", F.try_divide(F.col("n_frames"), F.col("seconds")))


def default_settings() -> dict[str, object]:
    """The extraction plan's settings and their defaults, as a configuration file holds them."""
    found = inspect.signature(extraction.extract).parameters.values()
    return {p.name: p.default for p in found if p.default is not inspect.Parameter.empty and not callable(p.default) and p.default is not None}


def write_settings(path: str, **changed: object) -> dict[str, object]:
    """Writes a configuration file with the defaults, and what differs from them; an unknown name raises an error."""
    settings = default_settings()
    if unknown := set(changed) - set(settings):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    settings |= changed
    with open(path, "w") as f:
        json.dump(settings, f, indent=2)
    return settings


def system(spark: SparkSession) -> dict[str, str]:
    """Versions, master and the settings that decide how a run is spread."""
    import numpy
    import pyarrow

    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.files.maxPartitionBytes", "spark.executor.memory", "spark.driver.memory")
    return {"python": platform.python_version(), "platform": platform.platform(), "spark": spark.version, "numpy": numpy.__version__, "pyarrow": pyarrow.__version__, "master": spark.sparkContext.master} | {n: str(spark.conf.get(n, None) or "") for n in names}
