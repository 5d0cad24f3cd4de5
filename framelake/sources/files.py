"""Text, JSON and tabular files of recordings, and finding sessions to extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators.intervals import parse_lines

METADATA = "DepthResolution array<int>, ColorResolution array<int>, SubjectName string, SessionName string, StartTime string"


def timestamps(spark: SparkSession, path: str, column: int = 0, factor: float = 1.0) -> DataFrame:
    """(file, line, ts): a column of white-space separated numbers, in milliseconds after ``factor``."""
    lines = spark.read.text(path).withColumn("file", F.input_file_name())
    value = F.get(F.split(F.trim("value"), r"\s+"), F.lit(column)).cast("double") * factor
    return lines.where(F.trim("value") != "").select("file", F.monotonically_increasing_id().alias("line"), value.alias("ts"))


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """A recording's metadata files, one row each."""
    return spark.read.schema(METADATA).option("multiLine", True).json(path).withColumn("file", F.input_file_name())


def flips(spark: SparkSession, path: str) -> DataFrame:
    """Ranges of a flips file."""
    return parse_lines(spark.read.text(path), "value").select("start", "stop")


def indices(text: Column) -> Column:
    """A comma or line separated list of numbers, sorted."""
    return F.array_sort(F.transform(F.filter(F.split(text, r"[,\s]+"), lambda x: x != ""), lambda x: x.cast("bigint")))


def tables(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Numbered tab-separated files as one table, ``part`` from the number in the file's name."""
    rows = spark.read.schema(schema).option("header", True).option("sep", "\t").csv(pattern)
    return rows.withColumn("part", F.regexp_extract(F.input_file_name(), r"(\d+)\D*$", 1).cast("int"))


def session_name(path: Column) -> Column:
    """A recording's name: the folder of a depth.dat, or an archive's name without its ending."""
    archive = F.regexp_extract(path, r"(session_\d+)\.(?:tgz|tar\.gz)$", 1)
    folder = F.regexp_extract(path, r"([^/]+)/depth\.dat$", 1)
    return F.when(archive != "", archive).when(folder != "", folder)


def unextracted(files: DataFrame, path: str = "path", skipped: Column | None = None) -> DataFrame:
    """(session, folder, path) of recordings among files that have metadata and no status yet."""
    f = files.select(F.col(path).alias("path"), F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("folder"))
    found = f.withColumn("session", session_name(F.col("path"))).where("session is not null")
    if skipped is not None:
        found = found.where(~skipped)
    archive = F.col("path").rlike(r"\.(tgz|tar\.gz)$")
    meta = f.where(F.col("path").rlike(r"/metadata\.json$")).select("folder")
    status = f.where(F.col("path").rlike(r"/(proc/)?results_\d+\.ya?ml$")).select(F.regexp_replace("folder", "/proc$", "").alias("folder"))
    with_meta = found.where(archive).unionByName(found.where(~archive).join(meta, "folder", "left_semi").select(*found.columns))
    return with_meta.join(status, "folder", "left_anti").select("session", "folder", "path")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """All files under a folder, by Spark's own listing."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
