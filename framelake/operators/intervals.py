"""Half-open ranges of frames: parsing, checking, marking and writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.operators.temporal import collapse_runs, keyed


def parse_lines(lines: DataFrame, line: str = "line", number: str | None = None) -> DataFrame:
    """Lines "start-stop" as (start, stop). Blank lines and comments from # on are skipped; anything else raises an error."""
    text = F.trim(F.regexp_replace(F.trim(F.col(line)), "#.*", ""))
    out = lines.withColumn("q_text", text).where(F.length("q_text") > 0)
    parts = F.transform(F.split("q_text", "-"), lambda p: F.trim(p).try_cast("bigint"))
    where = F.concat(F.lit("line "), F.col(number).cast("string"), F.lit(": ")) if number else F.lit("")
    good = (F.size(parts) == 2) & ~F.exists(parts, lambda p: p.isNull())
    checked = F.when(good, parts).otherwise(F.raise_error(F.concat(where, F.lit("expected two whole numbers, got "), F.col("q_text"))).cast("array<bigint>"))
    return out.withColumn("q_parts", checked).withColumns({"start": F.get("q_parts", F.lit(0)), "stop": F.get("q_parts", F.lit(1))}).drop("q_text", "q_parts")


def mark(frames: DataFrame, ranges: DataFrame, into: str, by: str | list[str] = "session", order: str = "frame_idx", span: int = 1000) -> DataFrame:
    """True for frames in any [start, stop).

    Ranges are cut at multiples of ``span`` and meet frames by key and span: an equi-join, whatever the ranges' length.
    """
    keys = keyed(by)
    cut = ranges.where("stop > start").select(*keys, F.col("start").alias("q_start"), F.col("stop").alias("q_stop"), F.explode(F.sequence(F.floor(F.col("start") / span), F.floor((F.col("stop") - 1) / span))).alias("q_span"))
    held = frames.select(*keys, order).withColumn("q_span", F.floor(F.col(order) / span)).join(cut, [*keys, "q_span"]).where((F.col(order) >= F.col("q_start")) & (F.col(order) < F.col("q_stop")))
    hits = held.select(*keys, order).distinct().withColumn(into, F.lit(True))
    return frames.drop(into).join(hits, [*keys, order], "left").withColumn(into, F.coalesce(F.col(into), F.lit(False)))


def overlaps(ranges: DataFrame, by: str | list[str] = "session", span: int = 1000) -> DataFrame:
    """Pairs of ranges that overlap, each once, found span by span."""
    keys = keyed(by)
    cut = ranges.withColumn("q_span", F.explode(F.sequence(F.floor(F.least("start", "stop") / span), F.floor(F.greatest("start", "stop") / span))))
    a = cut.select(*keys, "q_span", F.col("start").alias("start_a"), F.col("stop").alias("stop_a"))
    b = cut.select(*keys, "q_span", F.col("start").alias("start_b"), F.col("stop").alias("stop_b"))
    first = (F.col("start_a") < F.col("start_b")) | ((F.col("start_a") == F.col("start_b")) & (F.col("stop_a") < F.col("stop_b")))
    return a.join(b, [*keys, "q_span"]).where(first & (F.greatest("start_a", "start_b") < F.least("stop_a", "stop_b"))).drop("q_span").distinct()


def faults(ranges: DataFrame, low: int = 0, high: int | Column | None = None, by: str | list[str] = "session") -> DataFrame:
    """What is wrong with ranges, a row for each fault; none if all are valid."""
    keys = keyed(by)
    name = lambda a, b: F.format_string("(%d, %d)", F.col(a), F.col(b))
    checks = [
        F.when(F.col("stop") < F.col("start"), F.concat(F.lit("range "), name("start", "stop"), F.lit(" stops before it starts"))),
        F.when(F.col("start") < low, F.concat(F.lit("range "), name("start", "stop"), F.lit(f" starts under {low}"))),
    ]
    if high is not None:
        limit = F.lit(high) if isinstance(high, int) else high
        checks.append(F.when(F.col("stop") > limit, F.concat(F.lit("range "), name("start", "stop"), F.lit(" stops over "), limit.cast("string"))))
    single = ranges.select(*keys, F.explode(F.array_compact(F.array(*checks))).alias("fault"))
    pairs = overlaps(ranges, by).select(*keys, F.concat(F.lit("range "), name("start_a", "stop_a"), F.lit(" overlaps range "), name("start_b", "stop_b")).alias("fault"))
    return single.unionByName(pairs)


def write_lines(indices: DataFrame, value: str, by: str | list[str] = "session") -> DataFrame:
    """Indices as lines "start - stop" of their runs (stop is not part of a run)."""
    return collapse_runs(indices, value, by).withColumn("line", F.format_string("%d - %d", F.col("start"), F.col("start") + F.col("length")))


def expand_text(text: Column) -> Column:
    """All numbers that a text's "a-b" ranges (half-open) and single numbers name, as an array."""
    found = F.regexp_extract_all(text, F.lit(r"(\d+-\d+|\d+)"), F.lit(1))

    def numbers(p: Column) -> Column:
        ends = F.transform(F.split(p, "-"), lambda x: x.cast("bigint"))
        a, b = F.get(ends, F.lit(0)), F.get(ends, F.lit(1))
        return F.when(b.isNull(), F.array(a)).when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))

    return F.flatten(F.transform(found, numbers))
