"""Image files, movie headers, composites' limits, progress, settings and stacked filters."""

import json
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framelake.functions import images as codec
from framelake.functions.kalman import AngleTracker, correct_together
from framelake.operators import augment, batches, composites, tracking
from framelake.plans import progress
from framelake.sources import images, movies


@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (17, 4), (6, 7, 3)])
@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
def test_png_round_trip(shape, kind):
    image = np.random.default_rng(0).integers(0, np.iinfo(kind).max, shape, dtype=kind)
    back, info = codec.from_png(codec.to_png(image, {"scale_factor": "7"}))
    assert back.dtype == kind and (back == image).all() and info == {"scale_factor": "7"}


def test_png_row_filters():
    """Rows stored by each of the five differences come back as they were."""
    import zlib

    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (5, 6), dtype=np.uint8)
    rows, before = [], np.zeros(6, int)
    for kind, row in enumerate(image.astype(int)):
        left, corner = np.concatenate(([0], row[:-1])), np.concatenate(([0], before[:-1]))
        p = left + before - corner
        paeth = [min((a, b, c), key=lambda x: abs(q - x)) for a, b, c, q in zip(left, before, corner, p, strict=True)]
        guess = [np.zeros(6, int), left, before, (left + before) // 2, np.array(paeth)][kind]
        rows.append(bytes([kind]) + ((row - guess) % 256).astype(np.uint8).tobytes())
        before = row
    plain = codec.to_png(image)
    at = plain.index(b"IDAT") - 4
    body = zlib.compress(b"".join(rows))
    data = plain[:at] + struct.pack(">I", len(body)) + b"IDAT" + body + struct.pack(">I", zlib.crc32(b"IDAT" + body)) + plain[-12:]
    assert (codec.from_png(data)[0] == image).all()


@pytest.mark.parametrize("compress", [0, 6])
def test_tiff_round_trip(compress):
    image = np.random.default_rng(0).integers(0, 65535, (9, 4), dtype=np.uint16)
    back, info = codec.decode(codec.to_tiff(image, {"scale_factor": "(0, 100)"}, compress))
    assert (back == image).all() and info["scale_factor"] == "(0, 100)"
    assert codec.from_tiff(codec.to_tiff(image))[1] == {}
    with pytest.raises(ValueError):
        codec.decode(b"neither")


def test_image_files_on_disk(spark, tmp_path):
    rows = [(f"f{i}.png", [10 * i, 20, 30 + i, 40, 50, 60]) for i in range(4)]
    df = spark.createDataFrame(rows, "name string, px array<int>")
    px, factor = images.scaled(F.col("px"), low=0.0, high=100.0)
    files = images.encoded(df.withColumns({"s": px, "f": factor}), "s", 3, "f")
    assert {r.name for r in images.write(files, str(tmp_path / "out")).collect()} == {n for n, _ in rows}
    back = {r.path.rsplit("/", 1)[1]: r for r in images.read(spark, str(tmp_path / "out" / "*.png")).collect()}
    for name, values in rows:
        assert (back[name].height, back[name].width) == (2, 3) and np.allclose(back[name].depth, values, atol=100 / 65535)
    assert images.encoded(df.limit(0), "px", 3).count() == 0


def avi(width, height, frames, rate, scale, codec_name):
    main = struct.pack("<10I", 1000000 * scale // rate, 0, 0, 0, frames, 0, 1, 0, width, height) + bytes(16)
    sound = b"auds" + bytes(52)
    video = b"vids" + codec_name + struct.pack("<IHHI", 0, 0, 0, 0) + struct.pack("<4I", scale, rate, 0, frames) + bytes(24)
    part = lambda name, body: name + struct.pack("<I", len(body)) + body
    body = b"AVI " + b"LIST" + struct.pack("<I", 400) + b"hdrl" + part(b"avih", main) + part(b"strh", sound) + part(b"strh", video)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_probe(spark, tmp_path):
    (tmp_path / "a.avi").write_bytes(avi(512, 424, 900, 30, 1, b"FFV1"))
    (tmp_path / "depth.dat").write_bytes(bytes(2 * 8 * 4 * 3))
    (tmp_path / "b.mp4").write_bytes(b"x")
    files = spark.createDataFrame([(str(p), p.stat().st_size) for p in sorted(tmp_path.iterdir())], "path string, length long")
    out = {r.path.rsplit("/", 1)[1]: r for r in movies.probe(files, 8, 4).collect()}
    assert (out["a.avi"].codec, out["a.avi"].width, out["a.avi"].height, out["a.avi"].fps, out["a.avi"].n_frames) == ("FFV1", 512, 424, 30.0, 900)
    assert out["depth.dat"].n_frames == 3 and out["b.mp4"].codec is None and out["b.mp4"].n_bytes == 1
    with pytest.raises(ValueError):
        movies.avi_header(b"RIFFxxxxWAVE")


def test_kinds_of_recordings(spark):
    with pytest.raises(ValueError, match="unknown kind"):
        movies.read(spark, "/data/x.gif")
    with pytest.raises(ValueError, match="need a reader"):
        movies.read(spark, "/data/x.avi")
    assert movies.read(spark, "/data/X.MP4", lambda s, p: p) == "/data/X.MP4"


def test_composites(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [9, 8])], "a array<int>, b array<int>")
    for orientation, want in (("horizontal", [1, 2, 9, 8, 3, 4, 0, 0]), ("vertical", [1, 2, 3, 4, 9, 8]), ("diagonal", [1, 2, 0, 0, 3, 4, 0, 0, 0, 0, 9, 8])):
        px, h, w = composites.stacked([(F.col("a"), 2, 2), (F.col("b"), 1, 2)], orientation)
        assert df.select(px.alias("x")).first().x == want and h * w == len(want)
    with pytest.raises(ValueError):
        composites.stacked([(F.col("a"), 2, 2)], "upwards")
    with pytest.raises(ValueError):
        composites.stacked([])


def test_free_names(spark):
    taken = ["/d.x/run", "/d.x/run-1", "/d.x/run_0", "a.tar.gz", "a.tar-1.gz", ".hidden", "a.tar.backup-1.gz"]
    rows = spark.createDataFrame([("/d.x/run",), ("a.tar.gz",), (".hidden",), ("new.txt",)], "name string")
    held = F.array(*(F.lit(t) for t in taken))
    out = rows.select("name", composites.free_name(F.col("name"), held).alias("d"), composites.free_name(F.col("name"), held, ".backup-").alias("b"), composites.free_name(F.col("name"), held, "_").alias("u")).collect()
    assert [tuple(r)[1:] for r in out] == [("/d.x/run-2", "/d.x/run.backup-1", "/d.x/run_1"), ("a.tar-2.gz", "a.tar.backup-2.gz", "a.tar.gz_0"), (".hidden-1", ".hidden.backup-1", ".hidden_0"), ("new.txt",) * 3]


def test_random_fields():
    rng, powers = np.random.default_rng(0), []
    for power in (1.0, 3.0):
        field = np.mean([np.abs(np.fft.fft2(augment.random_field((64, 64), power, rng))) ** 2 for _ in range(40)], axis=0)
        powers.append(np.log(field[0, 4] / field[0, 16]) / np.log(4))
        assert abs(powers[-1] - power) < 0.5


def test_augmentation_repeats_and_keeps_masked_pixels(spark):
    df = spark.createDataFrame([(1, i, [5.0] * 16, [1] * 8 + [0] * 8) for i in range(30)], "session int, frame_idx long, px array<double>, mask array<int>")
    one, two = ({r.frame_idx: r.augmented for r in augment.blended(df.repartition(n), "px", 4, 7, mask="mask").collect()} for n in (2, 5))
    assert one == two
    changed = [a for a in one.values() if a != [5.0] * 16]
    assert 5 < len(changed) < 25 and all(len(set(a[:8])) == 1 for a in changed)


def test_meter_and_status(spark):
    meter, told = progress.Meter(), []
    n = progress.with_status(spark, lambda: meter.through(spark.range(1000)).count(), told.append, every=0.05)
    assert n == 1000 and meter.rate()[0] == 1000 and meter.rate()[1] > 0 and told[-1]["state"] == "done"

    def fails():
        raise KeyError("inside")

    with pytest.raises(KeyError):
        progress.with_status(spark, fails, told.append)
    assert told[-1]["state"] == "failed"


def test_settings(spark, tmp_path):
    path = str(tmp_path / "c.json")
    assert progress.write_settings(path, low=7)["low"] == 7 and json.load(open(path))["track"] is True
    with pytest.raises(ValueError):
        progress.write_settings(path, nothing=1)
    assert progress.system(spark)["spark"] == spark.version


def test_angles_together_are_those_one_by_one():
    """Missing angles, series of one frame, weak alignments and half turns."""
    rng, series = np.random.default_rng(3), []
    for n in (1, 2, 40, 7, 75, 75, 13):
        a = np.cumsum(rng.normal(0, 6, n)) % 360
        a[rng.random(n) < 0.1] += 180
        a = a % 360
        a[rng.random(n) < 0.08] = np.nan
        series.append((a, rng.random(n), rng.random(n) < 0.2))
    series.append((np.full(5, np.nan), np.ones(5), np.zeros(5, bool)))
    for (a, s, f), got in zip(series, correct_together(series, 30), strict=True):
        tracker, parts = AngleTracker(), []
        for k in range(0, len(a), 30):
            parts.append(tracker.correct(a[k : k + 30], s[k : k + 30], f[k : k + 30]))
        for want, have in zip((np.concatenate(x) for x in zip(*parts, strict=True)), got, strict=True):
            assert np.allclose(want, have, atol=1e-6, equal_nan=True)


def test_whole_groups():
    rng = np.random.default_rng(0)
    keys = np.sort(rng.integers(0, 40, 500))
    table = pa.table({"k": pa.array([None if k == 0 else int(k) for k in keys]), "i": np.arange(500)})
    for together in (1, 7, 50, 10_000):
        seen = []
        for part, ends in batches.whole_groups(table.to_batches(max_chunksize=11), ["k"], together):
            assert ends[0] == 0 and ends[-1] == part.num_rows
            seen += [part.slice(a, b - a).column("i").to_pylist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert seen == [np.flatnonzero(keys == k).tolist() for k in np.unique(keys)]


def test_no_rows(spark):
    df = spark.createDataFrame([], "session int, frame_idx long, instance long, x double, y double, mask array<int>, score double")
    assert tracking.tracked(df).count() == 0 and tracking.suppressed(df).count() == 0
    angles = spark.createDataFrame([], "session int, frame_idx long, angle double, score double, flip boolean")
    assert tracking.corrected_angles(angles).count() == 0
