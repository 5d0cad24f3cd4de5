"""Small cases with known answers, and properties, of the series and range operators."""

import itertools
import math

import numpy as np
import pytest

from framelake.operators import asof, editing, intervals, sampling, temporal


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def series(spark, values, name="v"):
    return spark.createDataFrame([("s", i, None if v is None else float(v)) for i, v in enumerate(values)], f"session string, frame_idx long, {name} double")


def runs_of(values):
    """(first, length) of the runs of consecutive numbers, one value at a time."""
    out = []
    for v in sorted(values):
        if out and v == out[-1][0] + out[-1][1]:
            out[-1] = (out[-1][0], out[-1][1] + 1)
        else:
            out.append((v, 1))
    return out


def test_collapse_consecutive(spark):
    rng = np.random.default_rng(8)
    sets = {"many": sorted({int(x) for x in rng.integers(-30, 90, 70)}), "one": [5], "apart": [-7, 100, 1000]}
    df = spark.createDataFrame([(k, v) for k, s in sets.items() for v in s], "session string, v long").orderBy(df_order())
    found = rows(temporal.collapse_runs(df, "v"), "session", "start", "length")
    assert sorted(found) == sorted((k, *r) for k, s in sets.items() for r in runs_of(s))
    assert temporal.collapse_runs(df.limit(0), "v").count() == 0


def df_order():
    from pyspark.sql import functions as F

    return F.md5(F.col("v").cast("string"))


def test_collapse_equal(spark):
    values = [4, 4, 4, -2, 9, 9, -2, -2, 0.5]
    found = sorted(rows(temporal.collapse_equal(series(spark, values), "v"), "start", "v", "length"))
    assert [(v, n) for _, v, n in found] == [(v, len([*g])) for v, g in itertools.groupby(values)]
    assert temporal.collapse_equal(series(spark, []), "v").count() == 0


def test_expand_and_reduce(spark):
    rng = np.random.default_rng(9)
    gaps = [int(x) for x in rng.choice([1, 1, 1, 2, 5], 25)]
    at = np.cumsum([2, *gaps]).tolist()
    df = spark.createDataFrame([("s", i, float(v), n) for i, (v, n) in enumerate(zip(at, [None, *gaps], strict=True))], "session string, frame_idx long, v double, steps long")
    full = temporal.expand_missing(df, "steps", ["v"])
    assert [v for _, v in sorted(rows(full, "step", "v"))] == [v if v in at else None for v in range(at[0], at[-1] + 1)]
    assert [v for _, v in sorted(rows(temporal.reduce_missing(full), "step", "v"))] == at


def test_interpolation_holds_ends(spark):
    df = series(spark, [None, 1.0, None, None, 4.0, None])
    assert [v for _, v in sorted(rows(temporal.interpolate(df, "v", "x"), "frame_idx", "x"))] == [1, 1, 2, 3, 4, 4]


def test_unwrap_is_numpys(spark):
    rng = np.random.default_rng(3)
    a = rng.uniform(0, 360, 60)
    found = [v for _, v in sorted(rows(temporal.unwrap(series(spark, a.tolist()), "v", "u"), "frame_idx", "u"))]
    assert np.allclose(found, np.unwrap(a, period=360))


def test_unwrap_once_moves_half_turns(spark):
    a = [10.0, 190.0, 10.0, 350.0, 950.0]
    find = lambda **k: [v for _, v in sorted(rows(temporal.unwrap(series(spark, a), "v", "u", **k), "frame_idx", "u"))]
    assert find() == np.unwrap(a, period=360).tolist() == [10, 190, 10, -10, -130]
    assert find(once=True) == [10, -170, 10, -10, 230]


def test_angle_filter_rests(spark):
    a = [10.0, 12, 191, 13, 192, 193, 14]
    out = temporal.filter_angles_to_rest(series(spark, a), "v", "u", "f")
    again = temporal.filter_angles_to_rest(out.select("session", "frame_idx", out["u"].alias("v")), "v", "u", "f")
    assert [r[1] for r in sorted(rows(out, "frame_idx", "u"))] == [r[1] for r in sorted(rows(again, "frame_idx", "u"))]
    assert all(math.isclose(abs(u - v), 180) == f for u, v, f in rows(out, "u", "v", "f"))


def test_chunks_apply_the_offset_twice(spark):
    df = series(spark, [0.0] * 80)
    found = rows(temporal.chunks(df, 30, 0, 10), "frame_idx")
    assert min(found)[0] == 20 and max(found)[0] == 79
    assert min(rows(temporal.chunks(df, 30, 0, 10, corrected=True), "frame_idx"))[0] == 10


def test_nearest_prefers_the_lower_index(spark):
    q = spark.createDataFrame([("s", 0, 5.0), ("s", 1, 100.0), ("t", 0, 1.0)], "session string, frame_idx long, ts_ms double")
    r = spark.createDataFrame([("s", 7, 0.0), ("s", 3, 10.0), ("s", 9, 10.0)], "session string, frame_idx long, ts_ms double")
    found = {(s, i): n for s, i, n in rows(asof.nearest(q, r), "session", "frame_idx", "nearest")}
    assert found == {("s", 0): 3, ("s", 1): 3, ("t", 0): None}


def test_flip_lines(spark):
    lines = spark.createDataFrame([("# note",), ("",), ("0 - 6",), ("8-10 # why",)], "line string")
    assert sorted(rows(intervals.parse_lines(lines), "start", "stop")) == [(0, 6), (8, 10)]
    with pytest.raises(Exception, match="expected two whole numbers"):
        intervals.parse_lines(spark.createDataFrame([("1-2-3",)], "line string")).collect()


def test_faults(spark):
    good = spark.createDataFrame([("s", 0, 6), ("s", 8, 10)], "session string, start long, stop long")
    assert intervals.faults(good, 0, 10).count() == 0
    bad = spark.createDataFrame([("s", 0, 6), ("s", 5, 10), ("s", 9, 3), ("s", -1, 0)], "session string, start long, stop long")
    assert intervals.faults(bad, 0, 9).count() >= 4


def test_expand_text(spark):
    df = spark.createDataFrame([("3-6, 9 and 12-12",)], "t string")
    assert df.select(intervals.expand_text(df.t)).first()[0] == [3, 4, 5, 9]


def test_turning_twice_is_nothing(spark):
    df = spark.createDataFrame([("s", i, [i, 2, 3, 4], 0.5 * i, False) for i in range(5)], "session string, frame_idx long, px array<int>, angle double, flip boolean")
    r = spark.createDataFrame([("s", 1, 4)], "session string, start long, stop long")
    once = editing.flipped(df, r, "px", "angle")
    twice = editing.flipped(once, r, "px", "angle")
    assert sorted(rows(once, "frame_idx", "flip")) == [(i, 1 <= i < 4) for i in range(5)]
    back = sorted(rows(twice, "frame_idx", "px", "angle", "flip"))
    assert [(i, p, f) for i, p, _, f in back] == [(i, [i, 2, 3, 4], False) for i in range(5)]
    assert np.allclose([a for _, _, a, _ in back], [0.5 * i for i in range(5)])


def test_same_rows(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert editing.same_rows(a, a.repartition(3)).first()["equal"]
    assert not editing.same_rows(a, a.distinct()).first()["equal"]


def test_split_is_exact(spark):
    df = spark.range(1000)
    out = sampling.split(df, 0.9, 1, "id")
    assert out.where("fold = 'train'").count() == 900 and out.count() == 1000


def test_samples_do_not_depend_on_partitions(spark):
    a = {r.id for r in sampling.random_rows(spark.range(200), 20, 5, "id").collect()}
    b = {r.id for r in sampling.random_rows(spark.range(200).repartition(7), 20, 5, "id").collect()}
    assert a == b and len(a) == 20
