"""Result stores: Parquet by session, with provenance, and tab-separated exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder for each session; an append adds chunks, an overwrite replaces only the sessions that it has."""
    writer = results.repartition("session").sortWithinPartitions("session", "frame_idx").write.partitionBy("session")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.mode(mode).parquet(path)


def describe(results: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Columns with comments, which Parquet keeps."""
    return results.select(*(F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in results.columns))


def read(spark, path: str, session: str | None = None) -> DataFrame:
    found = spark.read.parquet(path)
    return found.where(F.col("session") == session) if session else found


def write_table(rows: DataFrame, path: str) -> None:
    """Tab-separated files with a header."""
    rows.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def upsert(results: DataFrame, chunk: DataFrame, keys: tuple[str, ...] = ("session", "frame_idx")) -> DataFrame:
    """Results with a chunk's rows in place of those with the same keys."""
    return results.join(chunk.select(*keys), list(keys), "left_anti").unionByName(chunk)
