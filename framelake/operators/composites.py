"""Frames side by side, checks that frames belong together, and names that are still free."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stacked(parts: list[tuple[Column, int, int]], orientation: str = "horizontal", fill: float = 0.0) -> tuple[Column, int, int]:
    """Images (pixels, height, width) beside, below or diagonally below each other, padded: the pixels, height and width of the whole."""
    if orientation not in ("horizontal", "vertical", "diagonal"):
        raise ValueError(f"unknown orientation {orientation}")
    if not parts:
        raise ValueError("at least one image is needed")
    across, down = orientation != "vertical", orientation != "horizontal"
    height = sum(h for _, h, _ in parts) if down else max(h for _, h, _ in parts)
    width = sum(w for _, _, w in parts) if across else max(w for _, _, w in parts)

    def pixel(i: Column) -> Column:
        row, column, out = F.floor(i / width).cast("int"), (i % width).cast("int"), F.lit(fill)
        top = left = 0
        for px, h, w in parts:
            inside = (row >= top) & (row < top + h) & (column >= left) & (column < left + w)
            out = F.when(inside, F.get(px, (row - top) * w + column - left).cast("double")).otherwise(out)
            top, left = top + h * down, left + w * across
        return out

    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), pixel), height, width


def uniform_sizes(frames: DataFrame, pixels: str = "px", by: str = "session") -> DataFrame:
    """(by, n_sizes, fault): how many sizes a recording's frames have, and what is wrong if it isn't one."""
    sizes = frames.groupBy(by).agg(F.min(F.size(pixels)).alias("q_low"), F.max(F.size(pixels)).alias("q_high"), F.count_distinct(F.size(pixels)).alias("n_sizes"))
    return sizes.select(by, "n_sizes", F.when(F.col("n_sizes") > 1, F.format_string("frames have %d to %d pixels", "q_low", "q_high")).alias("fault"))


def free_name(name: Column, taken: Column, style: str = "-") -> Column:
    """``name`` if it isn't among ``taken``, else the first free one: "a-1.b", with style ".backup-" "a.backup-1.b", with "_" "a.b_0"."""
    stem, ending = F.regexp_extract(name, r"^(.*[^/])(\.[^./]*)$", 1), F.regexp_extract(name, r"^(.*[^/])(\.[^./]*)$", 2)
    stem = F.when(stem == "", name).otherwise(stem)
    numbers = F.sequence(F.lit(0 if style == "_" else 1), F.size(taken) + 1)
    tries = F.transform(numbers, lambda i: F.concat(name, F.lit("_"), i.cast("string")) if style == "_" else F.concat(stem, F.lit(style), i.cast("string"), ending))
    # of one name more than are taken, one is free
    return F.when(~F.array_contains(taken, name), name).otherwise(F.get(F.filter(tries, lambda t: ~F.array_contains(taken, t)), F.lit(0)))
