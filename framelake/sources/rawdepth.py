"""Raw depth recordings as a Spark data source: headerless frames of little-endian 16-bit pixels, one file for each session.

``spark.read.format("rawdepth").option("width", 512).option("height", 424).load(folder)`` gives (session, frame_idx,
height, width, pixels). Partitions are ranges of frames, so a long recording is read by many tasks with one seek each;
filters on frame_idx and session cut the ranges before anything is read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from framelake.schema import FRAMES

BYTES = 2


@dataclass
class Frames(InputPartition):
    path: str
    session: str
    start: int
    stop: int


def frame_count(size: int, width: int, height: int) -> int:
    """Whole frames in a file of a size."""
    return size // (width * height * BYTES)


def runs(indices: list[int]) -> list[tuple[int, int]]:
    """Sorted distinct indices as half-open runs, so that one read serves neighbours."""
    out: list[list[int]] = []
    for i in sorted(set(indices)):
        if out and out[-1][1] == i:
            out[-1][1] = i + 1
        else:
            out.append([i, i + 1])
    return [(a, b) for a, b in out]


class RawDepthReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.width, self.height = int(options.get("width", 512)), int(options.get("height", 424))
        self.per_partition = int(options.get("framesPerPartition", 1000))
        self.low, self.high = 0, None
        self.listed: set[int] | None = None
        self.sessions: set[str] | None = None

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            name, value = ".".join(f.attribute) if hasattr(f, "attribute") else "", getattr(f, "value", None)
            if name == "frame_idx" and isinstance(f, GreaterThan):
                self.low = max(self.low, value + 1)
            elif name == "frame_idx" and isinstance(f, GreaterThanOrEqual):
                self.low = max(self.low, value)
            elif name == "frame_idx" and isinstance(f, LessThan):
                self.high = value if self.high is None else min(self.high, value)
            elif name == "frame_idx" and isinstance(f, LessThanOrEqual):
                self.high = value + 1 if self.high is None else min(self.high, value + 1)
            elif name == "frame_idx" and isinstance(f, EqualTo | In):
                wanted = set(value) if isinstance(f, In) else {value}
                self.listed = wanted if self.listed is None else self.listed & wanted
            elif name == "session" and isinstance(f, EqualTo | In):
                wanted = set(value) if isinstance(f, In) else {value}
                self.sessions = wanted if self.sessions is None else self.sessions & wanted
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        found = []
        files = [self.folder] if os.path.isfile(self.folder) else sorted(os.path.join(d, f) for d, _, names in os.walk(self.folder) for f in names if f.endswith(".dat"))
        for path in files:
            session = os.path.basename(os.path.dirname(path)) if os.path.basename(path) == "depth.dat" else os.path.splitext(os.path.basename(path))[0]
            if self.sessions is not None and session not in self.sessions:
                continue
            n = frame_count(os.path.getsize(path), self.width, self.height)
            low, high = self.low, n if self.high is None else min(n, self.high)
            wanted = [(low, high)] if self.listed is None else runs([i for i in self.listed if low <= i < high])
            for a, b in wanted:
                found += [Frames(path, session, x, min(x + self.per_partition, b)) for x in range(a, b, self.per_partition)]
        return found or [Frames("", "", 0, 0)]

    def read(self, partition: Frames) -> Iterator[tuple]:
        if partition.stop <= partition.start:
            return
        size = self.width * self.height * BYTES
        with open(partition.path, "rb") as f:
            f.seek(partition.start * size)
            for i in range(partition.start, partition.stop):
                yield partition.session, i, self.height, self.width, f.read(size)


class RawDepth(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rawdepth"

    def schema(self) -> StructType:
        return FRAMES

    def reader(self, schema: StructType) -> DataSourceReader:
        return RawDepthReader(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RawDepth)


def unpack(frames, into: str = "px"):
    """Packed pixels as an array of ints."""
    from collections.abc import Iterator as It

    import numpy as np
    import pandas as pd
    from pyspark.sql import functions as F

    from framelake.session import share_code

    share_code(frames.sparkSession)

    def run(parts: It[pd.Series]) -> It[pd.Series]:
        for part in parts:
            yield pd.Series([np.frombuffer(x, "<i2").astype("int32") for x in part], index=part.index)

    run.__annotations__ = {"parts": It[pd.Series], "return": It[pd.Series]}
    return frames.withColumn(into, F.pandas_udf(run, "array<int>")("pixels"))
