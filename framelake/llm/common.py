"""What the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of spark.checkpoint.dir; a session in one process (tests) may do without and gets a folder of its own."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder: its lineage ends there and survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffles(rdd: JavaObject) -> set[int]:
    """Ids of the shuffles that ``rdd`` comes from, as far as what is persisted or checkpointed."""
    found: set[int] = set()
    seen: set[int] = set()
    rest = [rdd]
    while rest:
        at = rest.pop()
        if at.id() in seen or at.getStorageLevel().isValid():
            continue
        seen.add(at.id())
        some = at.dependencies()
        for dependency in (some.apply(i) for i in range(some.size())):
            if dependency.getClass().getSimpleName() == "ShuffleDependency":
                found.add(dependency.shuffleId())
            rest.append(dependency.rdd())
    return found


def checkpointed_alone(df: DataFrame) -> DataFrame:
    """As ``checkpointed``; the files of the shuffles that led there go at once, not when the driver happens to collect garbage.

    What fed a broadcast is small and stays. ``df`` itself is not to be read again.
    """
    out = checkpointed(df)
    cleaner = df.sparkSession.sparkContext._jsc.sc().cleaner()
    if cleaner.isDefined():
        for shuffle in shuffles(df._jdf.queryExecution().executedPlan().execute()):
            cleaner.get().doCleanupShuffle(shuffle, True)
    return out


#: A table is broadcast if it has been counted to hold so many values at most (some MB).
MOST_BROADCAST = 500_000


def counted(df: DataFrame, values: Column | None = None) -> DataFrame:
    """``df`` written, and marked for broadcast if it is small: its rows, or the sum of ``values`` over them, are counted while it is written."""
    told = Observation()
    out = checkpointed(df.observe(told, F.coalesce(F.sum(F.lit(1) if values is None else values), F.lit(0)).alias("n")))
    return F.broadcast(out) if told.get["n"] <= MOST_BROADCAST else out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Join or cut Arrow batches so that ``column`` has about ``most`` bytes in each; a longer row stands alone."""
    held: list[pa.RecordBatch] = []
    total = 0

    def sizes(batch: pa.RecordBatch) -> list[int]:
        return pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()

    def cut() -> Iterator[pa.RecordBatch]:
        for batch in pa.Table.from_batches(held).combine_chunks().to_batches() if len(held) > 1 else held:
            start = size = 0
            for i, n in enumerate(sizes(batch)):
                if i > start and size + n > most:
                    yield batch.slice(start, i - start)
                    start, size = i, 0
                size += n
            yield batch.slice(start)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        total += sum(sizes(batch))
        if total >= most:
            yield from cut()
            held, total = [], 0
    if held:
        yield from cut()


def groups(texts: list[str | None], most: int = 8 << 20) -> Iterator[list[str | None]]:
    """Cut a list of texts so that each part has about ``most`` characters; a longer text stands alone."""
    start = total = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and total + n > most:
            yield texts[start:i]
            start, total = i, 0
        total += n
    if start < len(texts):
        yield texts[start:]


def release(*caches: dict) -> None:
    """Empties caches and gives memory back at a task's end: Python workers live on and serve other operators."""
    for cache in caches:
        cache.clear()
    pa.default_memory_pool().release_unused()
