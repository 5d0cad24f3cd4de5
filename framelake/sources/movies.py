"""Recordings by kind of file: raw depth by this library, compressed movies by a reader that the caller supplies, and what a movie's header says."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from framelake.session import share_code

RAW, COMPRESSED = (".dat",), (".avi", ".mp4", ".mkv")
HEADER = 1 << 16
PROBE = "path string, n_bytes long, codec string, width int, height int, fps double, n_frames long"


def read(spark: SparkSession, path: str, compressed: Callable[[SparkSession, str], DataFrame] | None = None, **options: str) -> DataFrame:
    """Frames of a recording; a file of unknown kind, or a compressed one without a reader for it, raises an error."""
    low = path.lower()
    if low.endswith(RAW):
        from framelake.sources.rawdepth import RawDepth

        spark.dataSource.register(RawDepth)
        reader = spark.read.format(RawDepth.name())
        for key, value in options.items():
            reader = reader.option(key, value)
        return reader.load(path)
    if low.endswith(COMPRESSED):
        if compressed is None:
            raise ValueError(f"{path}: compressed movies need a reader, none is given")
        return compressed(spark, path)
    raise ValueError(f"{path}: unknown kind of recording, expected one of {', '.join(RAW + COMPRESSED)}")


def avi_header(data: bytes) -> dict:
    """Codec, size, frame rate and number of frames from the first bytes of an AVI file."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    main = data.find(b"avih")
    stream = data.find(b"strh", main)
    while stream >= 0 and data[stream + 8 : stream + 12] != b"vids":
        stream = data.find(b"strh", stream + 4)
    if main < 0 or stream < 0:
        raise ValueError("no video stream in the AVI header")
    step, _, _, _, frames, _, _, _, width, height = struct.unpack_from("<10I", data, main + 8)
    scale, rate = struct.unpack_from("<2I", data, stream + 28)
    length = struct.unpack_from("<I", data, stream + 40)[0]
    codec = data[stream + 12 : stream + 16].decode("ascii", "replace").strip("\0 ")
    return {"codec": codec, "width": width, "height": height, "fps": rate / scale if scale else 1e6 / step if step else None, "n_frames": length or frames}


def probe(files: DataFrame, width: int = 512, height: int = 424, fps: float = 30.0) -> DataFrame:
    """A row for each file (path, length): raw files by their length, AVI files by their header; of others only the length is told.

    Tasks read the first ``HEADER`` bytes alone, through Arrow's file systems.
    """
    share_code(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        names = [c.split(" ")[0] for c in PROBE.split(", ")]
        for batch in batches:
            rows = []
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {}
                if path.lower().endswith(RAW):
                    found = {"codec": "raw", "width": width, "height": height, "fps": fps, "n_frames": size // (2 * width * height)}
                elif path.lower().endswith(".avi"):
                    address = path if "://" in path else "file://" + path.removeprefix("file:")
                    system, name = fs.FileSystem.from_uri(address)
                    with system.open_input_stream(name) as f:
                        found = avi_header(f.read(HEADER))
                rows.append({"path": path, "n_bytes": size, **{k: found.get(k) for k in names[2:]}})
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return files.select("path", "length").mapInArrow(run, PROBE)
