"""Annotation tasks: two JSON dialects, polygons and keypoints in percent, dataset statistics, task writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE = "struct<points:array<array<double>>,x:double,y:double,keypointlabels:array<string>,polygonlabels:array<string>>"
RESULT = f"array<struct<type:string,original_width:int,original_height:int,value:{VALUE}>>"
TASK = f"struct<id:bigint,data:struct<image:string,depth_image:string>,task_path:string,annotations:array<struct<result:{RESULT}>>,completions:array<struct<result:{RESULT}>>>"


def parse(tasks: DataFrame, text: str = "json") -> DataFrame:
    """JSON tasks as (id, path, width, height, results). Of several annotations the first counts; ``completions`` is the older name."""
    t = tasks.withColumn("q", F.from_json(text, TASK))
    first = F.get(F.coalesce("q.annotations", "q.completions"), F.lit(0))["result"]
    sized = F.get(F.filter(first, lambda r: r["original_width"].isNotNull() & r["original_height"].isNotNull()), F.lit(0))
    path = F.coalesce("q.task_path", "q.data.image", "q.data.depth_image")
    return t.select(F.col("q.id").alias("id"), clean_path(path).alias("path"), sized["original_width"].alias("width"), sized["original_height"].alias("height"), first.alias("results"))


def clean_path(path: Column) -> Column:
    """A path whose file name has lost its "word-" prefixes."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.concat(F.substring(path, F.lit(1), F.length(path) - F.length(name)), F.regexp_replace(name, r"([\p{L}\p{N}_]+-)", ""))


def polygons(parsed: DataFrame, corrected: bool = False) -> DataFrame:
    """(id, polygon, vertices) in pixels. Widths scale y and heights x unless ``corrected``: on square images that is the same."""
    of = F.filter("results", lambda r: r["type"] == "polygonlabels")
    sx, sy = (("width", "height") if corrected else ("height", "width"))
    rows = parsed.select("id", "width", "height", F.posexplode(of).alias("polygon", "r"))
    vertices = F.transform("r.value.points", lambda p: F.struct((F.get(p, F.lit(0)) / 100 * F.col(sx)).alias("x"), (F.get(p, F.lit(1)) / 100 * F.col(sy)).alias("y")))
    return rows.select("id", "polygon", vertices.alias("vertices"))


def keypoints(parsed: DataFrame) -> DataFrame:
    """(id, point, part, x, y) in pixels."""
    of = F.filter("results", lambda r: r["type"] == "keypointlabels")
    rows = parsed.select("id", "width", "height", F.posexplode(of).alias("point", "r"))
    return rows.select("id", "point", F.get("r.value.keypointlabels", F.lit(0)).alias("part"), (F.col("r.value.x") / 100 * F.col("width")).alias("x"), (F.col("r.value.y") / 100 * F.col("height")).alias("y"))


def box(vertices: Column) -> Column:
    """The box about a polygon."""
    at = lambda f, c: f(F.transform(vertices, lambda p: p[c]))
    return F.struct(at(F.array_min, "x").alias("x0"), at(F.array_min, "y").alias("y0"), at(F.array_max, "x").alias("x1"), at(F.array_max, "y").alias("y1"))


def box_statistics(boxes: DataFrame, by: str = "session") -> DataFrame:
    """Least, greatest, mean, median and population deviation of widths, heights and long-to-short ratios; boxes without an area are left out."""
    b = boxes.where("w > 0 and h > 0").withColumn("a", F.greatest("w", "h") / F.least("w", "h"))
    return b.groupBy(by).agg(*(f(c).alias(f"{c}_{n}") for c in ("w", "h", "a") for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("median", lambda x: F.percentile(x, F.lit(0.5))), ("std", F.stddev_pop))))


def rewrite_paths(path: Column, rules: list[tuple[str, str]]) -> Column:
    """Replacements in order."""
    for old, new in rules:
        path = F.replace(path, F.lit(old), F.lit(new))
    return path


def to_tasks(frames: DataFrame, image: Column, depth: Column | None = None) -> DataFrame:
    """Frames as JSON tasks for an annotator."""
    data = F.struct(image.alias("image"), *([depth.alias("depth_image")] if depth is not None else []))
    return frames.select(F.to_json(F.struct(data.alias("data"))).alias("json"))


def append_tasks(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """New tasks after those that a file already has."""
    return new if old is None else old.unionByName(new)


def missing_files(parsed: DataFrame, files: DataFrame) -> DataFrame:
    """Annotations whose image isn't there."""
    return parsed.join(files.select(F.col("path")), "path", "left_anti")
