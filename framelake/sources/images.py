"""Image files: read into rows, written from rows, with the factor or range that their numbers were scaled by."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import images
from framelake.session import share_code

SCHEMA = "path string, height int, width int, channels int, bits int, px array<int>, description string"


def decoded(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, height, width, channels, bits, px, description) of PNG and TIFF bytes; rows in order, channels last."""
    share_code(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                image, info = images.decode(data)
                rows.append((name, *image.shape[:2], 1 if image.ndim == 2 else 3, 8 * image.dtype.itemsize, image.ravel().astype(np.int32), json.dumps(info)))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names=names)

    return files.select(path, content).mapInArrow(run, SCHEMA)


def read(spark: SparkSession, pattern: str) -> DataFrame:
    """Image files with ``depth``, their numbers before they were scaled."""
    files = decoded(spark.read.format("binaryFile").load(pattern))
    return files.withColumn("depth", unscaled(F.col("px"), F.get_json_object("description", "$.scale_factor"), F.col("bits")))


def _range(factor: Column) -> tuple[Column, Column, Column]:
    """Whether a factor's text is a range "(low, high)", and its ends."""
    ends = F.transform(F.split(F.regexp_replace(factor, r"[()\s]", ""), ","), lambda x: x.try_cast("double"))
    return F.size(ends) == 2, F.get(ends, F.lit(0)), F.get(ends, F.lit(1))


def unscaled(px: Column, factor: Column, bits: Column) -> Column:
    """Numbers divided by a factor, or spread over a range "(low, high)"; as they are without one."""
    spread, low, high = _range(factor)
    top = F.pow(F.lit(2.0), bits) - 1
    plain = F.transform(px, lambda v: v.cast("double"))
    return F.when(factor.isNull(), plain).when(spread, F.transform(px, lambda v: v / top * (high - low) + low)).otherwise(F.transform(px, lambda v: v / factor.try_cast("double")))


def scaled(px: Column, bits: int = 16, low: float | None = None, high: float | None = None) -> tuple[Column, Column]:
    """Numbers for an image of so many bits, and the text of the factor: a range stretched, else the whole factor that the greatest number allows. Negative ones become 0."""
    top = (1 << bits) - 1
    if low is not None and high is not None:
        out = F.transform(px, lambda v: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - low) / (high - low))) * top).cast("int"))
        return out, F.lit(f"({low}, {high})")
    whole = lambda v: F.greatest(v.cast("int"), F.lit(0))
    most = F.array_max(F.transform(px, whole))
    factor = F.when(most > 0, F.floor(F.lit(top) / most)).otherwise(F.lit(1)).cast("int")
    return F.transform(px, lambda v: whole(v) * factor), factor.cast("string")


def encoded(rows: DataFrame, px: str, width: int, factor: str | None = None, into: str = "content", bits: int = 16, form: str = "png", compress: int = 6) -> DataFrame:
    """Adds the image file's bytes; ``factor`` is a column with the text of the scale factor."""
    share_code(rows.sparkSession)
    kind = np.uint16 if bits == 16 else np.uint8
    write = {"png": images.to_png, "tiff": images.to_tiff}[form]

    @F.udf("binary", useArrow=True)
    def pack(values, text):
        image = np.asarray(values).astype(kind).reshape(-1, width)
        return write(image, {"scale_factor": text} if text is not None else None, compress)

    return rows.withColumn(into, pack(F.col(px), F.col(factor) if factor else F.lit(None).cast("string")))


def write(files: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """Writes each row's bytes to ``folder`` (any address that Arrow knows and all executors share) and gives (name, n_bytes).

    A file appears under its name when it's whole, so a task that runs twice leaves the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        system.create_dir(base, recursive=True)
        for batch in batches:
            sizes = []
            for one, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = f"{base}/.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(data)
                system.move(part, f"{base}/{one}")
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["name", "n_bytes"])

    return files.select(F.col(name).alias("name"), content).mapInArrow(run, "name string, n_bytes long")
