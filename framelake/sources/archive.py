"""Recordings inside gzip tar archives, read without unpacking. An archive can't be split: one task reads one."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from framelake.session import share_code
from framelake.sources.rawdepth import BYTES, frame_count


def frames(spark: SparkSession, pattern: str, width: int, height: int, member: str = "depth.dat", batch: int = 100) -> DataFrame:
    """(session, frame_idx, height, width, pixels) of the archives that match; the files come through Spark's own reader."""
    share_code(spark)
    files = spark.read.format("binaryFile").load(pattern).select("path", "content")
    size = width * height * BYTES

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                name = path.rsplit("/", 1)[-1].removesuffix(".tar.gz").removesuffix(".tgz")
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as tar:
                    inside = next((m for m in tar.getmembers() if m.name.rsplit("/", 1)[-1] == member), None)
                    if inside is None:
                        continue
                    data, n = tar.extractfile(inside), frame_count(inside.size, width, height)
                    for a in range(0, n, batch):
                        k = min(batch, n - a)
                        block = data.read(k * size)
                        yield pd.DataFrame({"session": name, "frame_idx": range(a, a + k), "height": height, "width": width, "pixels": [block[i * size : (i + 1) * size] for i in range(k)]})

    return files.mapInPandas(run, "session string, frame_idx long, height int, width int, pixels binary")
