"""Outliers by the median absolute deviation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.operators.temporal import keyed

FACTOR = 0.6745


def modified_z(df: DataFrame, values: list[str], into: str = "z", by: str | list[str] = "session") -> DataFrame:
    """Distance from the medians in units of its median. Where that median is 0 the score is infinite or, at 0, null.

    Medians are grouped aggregates joined back, not windows: each has one row per group.
    """
    keys = keyed(by)
    medians = df.groupBy(*keys).agg(*(F.percentile(v, F.lit(0.5)).alias(f"q_m{i}") for i, v in enumerate(values)))
    total = sum((F.coalesce((F.col(v) - F.col(f"q_m{i}")) * (F.col(v) - F.col(f"q_m{i}")), F.lit(0.0)) for i, v in enumerate(values)), F.lit(0.0))
    far = df.join(medians, keys).withColumn("q_d", F.sqrt(total)).drop(*(f"q_m{i}" for i in range(len(values))))
    mad = far.groupBy(*keys).agg(F.percentile("q_d", F.lit(0.5)).alias("q_mad"))
    score = F.when(F.col("q_mad") > 0, F.lit(FACTOR) * F.col("q_d") / F.col("q_mad")).when(F.col("q_d") > 0, F.lit(float("inf")))
    return far.join(mad, keys).withColumn(into, score).drop("q_d", "q_mad")


def mark_outliers(df: DataFrame, values: list[str], threshold: float = 3.5, into: str = "outlier", by: str | list[str] = "session") -> DataFrame:
    """True where the modified z-score is above a threshold."""
    return modified_z(df, values, "q_z", by).withColumn(into, F.coalesce(F.col("q_z") > threshold, F.lit(False))).drop("q_z")


def extent(df: DataFrame, value: str, threshold: float = 3.5, by: str | list[str] = "session") -> DataFrame:
    """Least and greatest value and count of rows that aren't outliers."""
    kept = mark_outliers(df, [value], threshold, "q_out", by).where(~F.col("q_out"))
    return kept.groupBy(*keyed(by)).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n_kept"))
