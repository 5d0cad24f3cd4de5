"""Noise that looks like smooth random fields, for training images."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from framelake.session import share_code


def random_field(shape: tuple[int, int], power: float, rng: np.random.Generator, scale: float = 1.0) -> np.ndarray:
    """A Gaussian field whose spectrum falls as the wave number to the power ``power``."""
    waves = np.hypot(np.fft.fftfreq(shape[0])[:, None] * shape[0], np.fft.fftfreq(shape[1])[None, :] * shape[1])
    noise = rng.normal(0, scale, shape) + 1j * rng.normal(0, scale, shape)
    return np.fft.ifft2(noise * np.sqrt((waves + np.finfo(float).eps) ** -power * (waves > 0))).real


def blended(frames: DataFrame, pixels: str, width: int, seed: int, share: float = 0.5, power: tuple[float, float] = (1.0, 4.0), most: tuple[float, float] = (10.0, 60.0), mask: str | None = None, keys: tuple[str, ...] = ("session", "frame_idx"), into: str = "augmented") -> DataFrame:
    """A share of the frames with a random field added, where ``mask`` is 0; draws follow from seed and keys, so reruns agree."""
    share_code(frames.sparkSession)
    schema = T.StructType([*(f for f in frames.schema.fields if f.name != into), T.StructField(into, T.ArrayType(T.DoubleType()))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in keys]
            masks = batch.column(mask).to_pylist() if mask else [None] * batch.num_rows
            out = []
            for *key, px, m in zip(*columns, batch.column(pixels).to_pylist(), masks, strict=True):
                rng = np.random.default_rng(xxhash.xxh3_64_intdigest(repr((seed, *key)).encode()))
                image = np.asarray(px, float).reshape(-1, width)
                if rng.random() < share:
                    field = np.abs(random_field(image.shape, rng.uniform(*power), rng) * (1 if m is None else 1 - np.asarray(m, float).reshape(image.shape)))
                    top = field.max() - field.min()
                    image = image + np.floor((field - field.min()) * (int(rng.uniform(*most)) / top) if top else 0 * field)
                out.append(image.ravel())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(out, pa.list_(pa.float64()))], names=names)

    return frames.drop(into).mapInArrow(run, schema)
