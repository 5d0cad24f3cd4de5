"""Sources, sinks, plans and streams on files made here."""

import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from framelake.operators import tracking
from framelake.plans import audit, calibrate
from framelake.sources import files, rawdepth, results
from framelake.streaming import trackers


def test_raw_depth(spark, tmp_path):
    rng = np.random.default_rng(0)
    px = rng.integers(0, 900, (25, 4, 6)).astype("<i2")
    (tmp_path / "session_1").mkdir()
    (tmp_path / "session_1" / "depth.dat").write_bytes(px.tobytes() + b"\0" * 7)
    rawdepth.register(spark)
    df = spark.read.format("rawdepth").option("width", 6).option("height", 4).option("framesPerPartition", 10).load(str(tmp_path))
    out = rawdepth.unpack(df).orderBy("frame_idx").collect()
    assert len(out) == 25 and out[0]["session"] == "session_1"
    assert all(r["px"] == px[r["frame_idx"]].ravel().tolist() for r in out)
    some = df.where("frame_idx >= 20 and frame_idx < 23")
    assert sorted(r.frame_idx for r in some.collect()) == [20, 21, 22]
    assert sorted(r.frame_idx for r in df.where(F.col("frame_idx").isin(3, 4, 17)).collect()) == [3, 4, 17]
    assert df.where("session = 'other'").count() == 0


def test_runs():
    assert rawdepth.runs([5, 1, 2, 2, 9]) == [(1, 3), (5, 6), (9, 10)]


def test_text_files(spark, tmp_path):
    (tmp_path / "ts.txt").write_text("0 1.5\n33.3  2\n\n66.6 9\n")
    assert sorted(r.ts for r in files.timestamps(spark, str(tmp_path / "ts.txt")).collect()) == [0, 33.3, 66.6]
    (tmp_path / "m.json").write_text(json.dumps({"DepthResolution": [512, 424], "ColorResolution": [1, 2], "Other": 3}, indent=1))
    assert files.metadata(spark, str(tmp_path / "m.json")).first()["DepthResolution"] == [512, 424]
    (tmp_path / "flips.txt").write_text("# c\n3-5\n\n7 - 9 # x\n")
    assert sorted(tuple(r) for r in files.flips(spark, str(tmp_path / "flips.txt")).collect()) == [(3, 5), (7, 9)]
    df = spark.createDataFrame([("5, 2\n11",)], "t string")
    assert df.select(files.indices(df.t)).first()[0] == [2, 5, 11]


def test_discovery(spark):
    paths = ["/a/s1/depth.dat", "/a/s1/metadata.json", "/a/s2/depth.dat", "/a/s3/depth.dat", "/a/s3/metadata.json", "/a/s3/proc/results_00.yaml", "/a/session_77.tar.gz", "/a/x.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert sorted(r.session for r in files.unextracted(df).collect()) == ["s1", "session_77"]


def test_result_store(spark, tmp_path):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(5)] + [("b", i, 1.0) for i in range(3)], "session string, frame_idx long, x double")
    results.write(results.describe(df, {"x": "position"}), str(tmp_path / "r"))
    assert results.read(spark, str(tmp_path / "r"), "a").count() == 5
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    results.write(df.where("session = 'b' and frame_idx < 2"), str(tmp_path / "r"))
    back = results.read(spark, str(tmp_path / "r"))
    assert back.where("session = 'a'").count() == 5 and back.where("session = 'b'").count() == 2
    assert back.schema["x"].metadata == {"comment": "position"}
    new = spark.createDataFrame([("a", 2, 9.0), ("a", 7, 7.0)], "session string, frame_idx long, x double")
    assert results.upsert(df, new).where("session = 'a'").count() == 6
    results.write_table(df, str(tmp_path / "t"))
    assert files.tables(spark, str(tmp_path / "t" / "*.csv"), "session string, frame_idx long, x double").count() == 8


def test_stream_is_batch(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(f"s{s}", f, k, float(40 * k + f + rng.normal()), float(k)) for s in range(3) for f in range(12) for k in range(2)]
    schema = "session string, frame_idx long, instance long, x double, y double"
    for part in range(3):
        spark.createDataFrame([r for r in rows if r[1] // 4 == part], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{part}"))
    batch = tracking.tracked(spark.createDataFrame(rows, schema)).select("session", "frame_idx", "instance", "track", "age")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    out = trackers.replay(trackers.tracked(stream), str(tmp_path / "s"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_calibration_and_outliers(spark):
    y, x = np.mgrid[:10, :12]
    base = 700 + 0.1 * x
    rows = [("s", i, (base + (i % 3)).ravel().astype(int).tolist()) for i in range(9)]
    df = spark.createDataFrame(rows, "session string, frame_idx long, px array<int>")
    c = calibrate.calibrate(df, 12, every=1, rounds=100, dilate=3).first()
    assert abs(c["true_depth"] - 701) < 3 and sum(c["roi"]) == 120
    assert calibrate.inside(df, calibrate.calibrate(df, 12, every=1, rounds=50)).count() == 9
    kp = []
    for i in range(40):
        for p in ("Nose", "Left Ear", "Right Ear", "Neck", "Left Hip", "Right Hip", "TailBase", "TailTip"):
            far = 500.0 if i == 20 and p == "Nose" else 0.0
            kp.append(("s", i, p, i * 0.1 + far + (0.01 * (i % 5)), float("nan") if i == 5 and p == "Neck" else 1.0 + 0.01 * (i % 3), 1.0, 2.0, 1.0, 0.0))
    k = spark.createDataFrame(kp, "session string, frame_idx long, part string, x double, y double, score double, cx double, cy double, angle double")
    found = {(r.kind, r.line) for r in audit.find_outliers(k, threshold=1000.0).collect()}
    assert ("NaNs", "5 - 6") in found and ("combined", "5 - 6") in found and any(kind == "jumping" and line.startswith("20 -") for kind, line in found)


def test_batch_plan_and_dataset(spark):
    paths = spark.createDataFrame([("/b",), ("/a",), ("/c",)], "path string")
    done = spark.createDataFrame([("/c",)], "path string")
    out = [r.command for r in audit.plan_batch(paths, done, 'extract "{path}"').collect()]
    assert out == ['sbatch --wrap "extract \\"/a\\""', 'sbatch --wrap "extract \\"/b\\""']
    frames = spark.createDataFrame([(f"s{i % 2}", i, [i, 2, 3, 4]) for i in range(40)], "session string, frame_idx long, px array<int>")
    assert audit.sample_dataset(frames, 10).count() == 10
    assert audit.sample_dataset(frames, 6, "kmeans", clusters=3).count() <= 6
    assert isinstance(frames.limit(1).toPandas(), pd.DataFrame)


def test_archives(spark, tmp_path):
    import io
    import tarfile

    from framelake.sources import archive

    px = np.arange(5 * 12, dtype="<i2").reshape(5, 3, 4)
    with tarfile.open(tmp_path / "session_9.tar.gz", "w:gz") as tar:
        for name, data in (("x/metadata.json", b"{}"), ("x/depth.dat", px.tobytes())):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    out = rawdepth.unpack(archive.frames(spark, str(tmp_path / "*.tar.gz"), 4, 3, batch=2)).orderBy("frame_idx").collect()
    assert [r.px for r in out] == [f.ravel().tolist() for f in px] and {r.session for r in out} == {"session_9"}


def test_inference_and_windows(spark):
    from framelake.operators import pixels
    from framelake.plans.infer import infer, threshold_model

    image = np.zeros((8, 10))
    image[2:6, 3:8] = 50
    df = spark.createDataFrame([("s", 0, image.ravel().tolist()), ("s", 1, [0.0] * 80)], "session string, frame_idx long, px array<double>")
    found = infer(df, threshold_model(10), 10).collect()
    assert len(found) == 1 and found[0].box == [3, 2, 7, 5] and sum(found[0]["mask"]) == 20
    f = {r.frame_idx: r for r in pixels.shape_features(df, "px", 10, 10).collect()}
    assert abs(f[0].cx - 5) < 1e-9 and abs(f[0].cy - 3.5) < 1e-9 and f[0].major > f[0].minor and f[1].cx is None
    posed = df.selectExpr("*", "cast(5 as double) as cx", "cast(3.5 as double) as cy", "cast(if(frame_idx = 0, 90, null) as double) as angle")
    w = pixels.cropped_and_turned(posed, "px", "w", 10, (8, 8))
    sums = {r.frame_idx: sum(r.w) for r in w.collect()}
    assert abs(sums[0] - 1000) < 120 and sums[1] == 0
    back = pixels.uncropped(w, "w", "b", (8, 8), (8, 10)).where("frame_idx = 0").first()
    assert np.reshape(back.b, (8, 10))[3, 5] > 40
