"""Edits of extracted results: flips, copies, trims; and set operations over index sets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.arrays import rotate_180
from framelake.functions.geometry import clamp_radians
from framelake.operators.intervals import mark
from framelake.operators.temporal import keyed


def combined_flips(revisions: DataFrame, flip: str = "flip", by: str | list[str] = ("session", "frame_idx")) -> DataFrame:
    """All revisions' flips, one over the other."""
    return revisions.groupBy(*keyed(by)).agg((F.bit_xor(F.col(flip).cast("int")) == 1).alias(flip))


def flipped(results: DataFrame, ranges: DataFrame, pixels: str | None = None, angle: str | None = None, mask: str | None = None, flip: str = "flip", by: str = "session", order: str = "frame_idx") -> DataFrame:
    """Results with the frames in ranges turned: images by half a turn, angles (radians) by pi, the flip inverted."""
    out = mark(results, ranges, "q_flip", by, order)
    new = {c: F.when(F.col("q_flip"), rotate_180(F.col(c))).otherwise(F.col(c)) for c in (pixels, mask) if c}
    if angle:
        new[angle] = F.when(F.col("q_flip"), clamp_radians(F.col(angle) + math.pi)).otherwise(F.col(angle))
    if flip in results.columns:
        new[flip] = F.col(flip) != F.col("q_flip")
    else:
        new[flip] = F.col("q_flip")
    return out.withColumns(new).drop("q_flip")


def copied(results: DataFrame, source: int, target: int, values: list[str], by: str = "session", order: str = "frame_idx") -> DataFrame:
    """Results in which a frame has the values of another of its session."""
    taken = results.where(F.col(order) == source).select(by, *(F.col(v).alias(f"q_{v}") for v in values))
    out = results.join(taken.withColumn("q_has", F.lit(True)), by, "left")
    here = (F.col(order) == target) & F.col("q_has").isNotNull()
    return out.withColumns({v: F.when(here, F.col(f"q_{v}")).otherwise(F.col(v)) for v in values}).drop("q_has", *(f"q_{v}" for v in values))


def trimmed(results: DataFrame, start: int, stop: int, by: str = "session", order: str = "frame_idx") -> DataFrame:
    """Frames [start, stop), numbered anew from 0; a negative stop counts from the end."""
    if stop < 0:
        sizes = results.groupBy(by).agg((F.max(order) + 1).alias("q_n"))
        kept = results.join(sizes, by).where((F.col(order) >= start) & (F.col(order) < F.col("q_n") + stop)).drop("q_n")
    else:
        kept = results.where((F.col(order) >= start) & (F.col(order) < stop))
    return kept.withColumn(order, F.col(order) - start)


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """(n_a, n_b, equal): whether two tables have the same rows, each as often. One pass over both, no sort."""
    both = a.withColumn("q_s", F.lit(1)).unionByName(b.withColumn("q_s", F.lit(-1)))
    counted = both.groupBy(*a.columns).agg(F.sum("q_s").alias("q_d"), F.count_if(F.col("q_s") == 1).alias("q_a"), F.count_if(F.col("q_s") == -1).alias("q_b"))
    return counted.agg(F.coalesce(F.sum("q_a"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("q_b"), F.lit(0)).alias("n_b"), (F.coalesce(F.sum(F.abs("q_d")), F.lit(0)) == 0).alias("equal"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b).unionByName(b.exceptAll(a))


def substitute(template: str, **values: Column) -> Column:
    """A template's {names} replaced by columns."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def batch_command(command: Column, prefix: str = "sbatch", wrap: bool = True) -> Column:
    """A command for a batch system, its quotes escaped."""
    return F.concat(F.lit(f'{prefix} --wrap "'), F.replace(command, F.lit('"'), F.lit('\\"')), F.lit('"')) if wrap else command


def merged_settings(*levels: Column) -> Column:
    """Maps merged, later ones over earlier ones, with the first one's keys only."""
    def over(low: Column, high: Column) -> Column:
        known = F.map_filter(high, lambda k, _: F.array_contains(F.map_keys(levels[0]), k))
        return F.map_concat(F.map_filter(low, lambda k, _: ~F.array_contains(F.map_keys(known), k)), known)

    out = levels[0]
    for level in levels[1:]:
        out = over(out, level)
    return out
