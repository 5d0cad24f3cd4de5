"""Counts, histograms, pivots and scores of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.operators.temporal import keyed


def confusion(df: DataFrame, actual: Column, predicted: Column, by: str | list[str]) -> DataFrame:
    """Counts and scores; a score without a denominator is null."""
    out = df.groupBy(*keyed(by)).agg(
        F.count_if(actual & predicted).alias("tp"), F.count_if(~actual & predicted).alias("fp"), F.count_if(~actual & ~predicted).alias("tn"), F.count_if(actual & ~predicted).alias("fn")
    )
    c = F.col
    scored = out.withColumns({"sensitivity": F.try_divide(c("tp"), c("tp") + c("fn")), "specificity": F.try_divide(c("tn"), c("tn") + c("fp")), "precision": F.try_divide(c("tp"), c("tp") + c("fp"))})
    return scored.withColumn("f1", F.try_divide(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")))


def best(scores: DataFrame, score: str, *names: str) -> DataFrame:
    """The row with the highest score, of equals the first by name."""
    return scores.where(F.col(score).isNotNull()).orderBy(F.desc(score), *names).limit(1)


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, by: str | list[str] = ()) -> DataFrame:
    """Counts by equal bins of [low, high]; the last has its upper end."""
    place = F.least(F.floor((F.col(value) - low) / ((high - low) / bins)), F.lit(bins - 1).cast("long"))
    return df.where(F.col(value).between(low, high)).groupBy(*keyed(by) if by else (), place.alias("bin")).agg(F.count("*").alias("n"))


def pivot(df: DataFrame, row: str, column: str, values: list[str], counted: Column | None = None) -> DataFrame:
    """Sums (or counts) by row and column; the columns are named, so no pass over the data looks for them."""
    return df.groupBy(row).agg(*(F.coalesce(F.sum(F.when(F.col(column) == v, counted if counted is not None else F.lit(1))), F.lit(0)).alias(v) for v in values))


def matching(df: DataFrame, values: Column, wanted: list[str]) -> DataFrame:
    """Rows whose list of values has any of the wanted ones."""
    return df.where(F.arrays_overlap(values, F.array(*(F.lit(w) for w in wanted))))


def listed_values(text: Column, separator: str = "\r\n") -> Column:
    """A text's distinct values between separators, without empty ones and "nan"."""
    return F.array_distinct(F.filter(F.transform(F.split(text, separator), F.trim), lambda v: (v != "") & (v != "nan")))


def consistent(df: DataFrame, *columns: str) -> DataFrame:
    """Whether each column has one value only."""
    return df.agg(*(F.count_distinct(c).alias(f"n_{c}") for c in columns)).withColumn("consistent", F.array_max(F.array(*(F.col(f"n_{c}") for c in columns))) <= 1)
