"""Small fixtures with values worked out by hand, and analytic truth for the kernels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.functions import geometry, signal, time, traces
from fathomline.operators import aggregates, kernels, windows
from fathomline.plans import catalog
from fathomline.sources import binary
from fathomline.streaming import stacks


def track(spark, values, name="v"):
    return spark.createDataFrame([("p", i, float(v)) for i, v in enumerate(values)], f"k string, i long, {name} double")


def test_running_mean(spark):
    out = windows.centred_mean(track(spark, [1, 4, 9, 16, 25]), "k", "i", "v", 3, "m").orderBy("i").collect()
    assert [r["m"] for r in out] == pytest.approx([0, 14 / 3, 29 / 3, 50 / 3, 0])


def test_windows_do_not_depend_on_chunks(spark, monkeypatch):
    df = track(spark, [(i * 37) % 101 for i in range(50)])
    run = lambda: [(r["i"], round(r["m"], 9), round(r["s"], 9)) for r in windows.prefix_sum(windows.centred_mean(df, "k", "i", "v", 7, "m", edge="repeat"), "k", "i", "v", "s").orderBy("i").collect()]
    whole = run()
    monkeypatch.setattr(windows, "CHUNK", 5)
    assert run() == whole


def test_chunks(spark):
    d = windows.distance_chunks(track(spark, [0, 10, 20, 31, 40, 62, 63], "d"), "k", "i", "d").orderBy("i")
    assert [r["chunk"] for r in d.collect()] == [0, 0, 0, 1, 1, 1, 1]
    n = windows.fixed_chunks(spark.range(1030).select(F.lit("p").alias("k"), F.col("id").alias("i")), "k", "i")
    assert sorted(map(tuple, n.groupBy("chunk").count().collect())) == [(0, 512), (1, 518)]
    with pytest.raises(Exception, match="backwards"):
        windows.distance_chunks(track(spark, [5, 3], "d"), "k", "i", "d").collect()


def test_islands(spark):
    out = windows.islands(track(spark, [0, 0, 0, 10, 10, 10]), "k", "i", "v").orderBy("t").collect()
    assert [(r["value"], r["t"]) for r in out] == [(0, 1), (10, 4)]
    out = windows.islands(track(spark, [7, 7, 7]), "k", "i", "v").orderBy("t").collect()
    assert [(r["value"], r["t"]) for r in out] == [(7, 0), (7, 1)]


def test_outliers(spark):
    out = aggregates.outliers(track(spark, [1, 2, 3, 100]), ["k"], "v", 1.0).orderBy("v").collect()
    assert [r["outlier"] for r in out] == [True, False, False, True]


def test_scalars(spark):
    one = spark.range(1)
    p = one.select(signal.parabola3(1, 2, 1).alias("p")).first()["p"]
    assert tuple(p) == (0, 2, -1)
    assert one.select(signal.static_scale(4, 8), signal.static_scale(3, 8)).first()[:] == (1, pytest.approx(4 / 3))
    assert one.select(traces.unpack4(F.lit(bytearray([0x7F, 0x80])))).first()[0] == [7, -1, -8, 0]
    assert one.select(traces.roll(F.lit([1, 2, 3, 4]), 1)).first()[0] == [4, 1, 2, 3]
    assert one.select(time.parse_iso(F.lit("2000-01-01T12:00:00.000")), time.parse_iso(F.lit("2000-001T12:00:01"))).first()[:] == (0, 1)
    with pytest.raises(Exception, match="not a timestamp"):
        one.select(time.parse_iso(F.lit("yesterday"))).collect()
    lat, lon, h = geometry.to_spherical(*geometry.to_cartesian(12.5, 200.25, 3396.0))
    assert one.select(lat, lon, h).first()[:] == pytest.approx((12.5, 200.25, 3396.0), abs=1e-5)


def test_catalog(spark):
    one = spark.createDataFrame([("/x/e_1920301_001_ss04_700_a_a.dat",)], "p string")
    assert one.select(catalog.product_of("p")).first()[0] == "e_1920301_001_ss04_700_a"
    files = spark.createDataFrame([("a", "in", 5), ("a", "out", 5), ("b", "in", 4), ("b", "out", 5), ("c", "in", None), ("c", "out", 9)], "product_id string, role string, mtime long")
    got = {r[0]: tuple(r)[1:] for r in catalog.status(files).collect()}
    assert got == {"a": ("input_ok", "output_stale"), "b": ("input_ok", "output_ok"), "c": ("input_missing", "output_exists")}
    assert catalog.stages_for(["rsr", "foc"]) == ["cmp", "alt", "srf", "rsr", "foc"]


def test_kernels():
    n = np.arange(256)
    wave = lambda d: np.sin(2 * np.pi * 5 * (n - d) / 256)
    for d in (0.25, 1.5, 3.0):
        assert np.abs(kernels.delayed(wave(0)[None], np.array([d]))[0].real - wave(d)).max() < 1e-6
    fine = kernels.upsampled(wave(0)[None], 4)[0].real
    assert np.sqrt(np.mean((fine - np.sin(2 * np.pi * 5 * np.arange(1024) / 1024)) ** 2)) < 5e-4
    t = np.arange(200.0)
    lag = np.where(t < 84, 0, t - 95)
    echo = -20 + 15 * np.exp(-0.03 * lag) * 0.5 * (1 + kernels.erf((t - 92) / (np.sqrt(2) * 4)))
    fit = kernels.retracked(echo, start=(100.0, 3.0, 0.05), floor=60)
    assert abs(fit[2] - 92) < 0.5 and abs(fit[1] - 15) < 1
    sent = np.fft.ifft(kernels.chirp_spectrum(3600)).real
    out, tec, _ = kernels.compressed(np.stack([np.roll(sent, 500)] * 4), iono=False)
    assert tec == 0 and set(np.abs(out).argmax(axis=1)) == {500}


def test_electron_content_of_a_dispersed_chirp(spark):
    unit = 1e16 / (kernels.TEC_PER_E * 50)
    r = np.random.default_rng(1)
    for share in (10, 30):
        sent = np.fft.ifft(kernels.chirp_spectrum(3600, share * unit)).real
        data = np.stack([np.roll(sent, 500)] * 40) + r.normal(0, 1e-3, (40, 3600)) * np.abs(sent).max()
        out, tec, _ = kernels.compressed(data, iono=True)
        assert abs(tec * 50 - share) < 1.5
        assert abs(out).max() > 2 * abs(kernels.compressed(data, iono=False)[0]).max()


def test_range_compression_meets_day_and_night(spark):
    from fathomline import queries

    tec = [r[0] for r in queries.queries()["range_compression"](spark, "/root/testdata/sf0.001").select("tec").collect()]
    assert min(tec) == 0 < max(tec)


def test_ellipsoidal_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 90.0), (0.0, 0.0, 90.0, 0.0), (10.0, 20.0, 10.0, 20.0), (40.0, -5.0, -12.0, 60.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geometry.ellipsoidal_distance("a", "b", "c", "d", 3396190.0, 3376200.0)).collect()]
    t = (np.arange(1_000_000) + 0.5) / 1_000_000 * np.pi / 2
    meridian = np.sqrt((3396190.0 * np.sin(t)) ** 2 + (3376200.0 * np.cos(t)) ** 2).mean() * np.pi / 2
    assert got[:3] == pytest.approx([3396190.0 * np.pi / 2, meridian, 0], abs=1e-2)
    sphere = df.select(geometry.ellipsoidal_distance("a", "b", "c", "d", 1000.0, 1000.0), geometry.haversine_distance("a", "b", "c", "d", 1000.0)).collect()
    assert all(r[0] == pytest.approx(r[1], abs=1e-6) for r in sphere)


def test_best_lag(spark):
    a = [float(i * i % 17) for i in range(32)]
    got = spark.createDataFrame([(a, a[-2:] + a[:-2])], "a array<double>, b array<double>").select(traces.best_lag("a", "b", 3).alias("x")).first()["x"]
    assert (got["lag"], got["residual"]) == (-2, 0)


def test_degrees(spark):
    df = spark.createDataFrame([("12d30' 0.0\"W",), ("1d 0'36.0\"N",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(geometry.degrees_of("t")).collect()] == [-12.5, pytest.approx(1.01), None, None]


def test_binary_records(spark, tmp_path):
    layout = np.dtype([("t", ">u4"), ("name", "S4"), ("v", ">i2", (3,))])
    rows = np.array([(4_000_000_000, b"ab  ", (1, -2, 3)), (7, b"cdef", (0, 0, -9))], layout)
    (tmp_path / "x.dat").write_bytes(b"head" + rows.tobytes())
    got = binary.records(spark, str(tmp_path), [("t", ">u4"), ("name", "S4"), ("v", ">i2", (3,))], "*.dat", skip=4).orderBy("record").collect()
    assert [(r["record"], r["t"], r["name"], r["v"]) for r in got] == [(0, 4_000_000_000, "ab", [1, -2, 3]), (1, 7, "cdef", [0, 0, -9])]


def test_streamed_stacks(spark, tmp_path):
    for part in (range(0, 6), range(6, 11)):
        spark.createDataFrame([("p", i, [float(i), 1.0]) for i in part], "k string, i long, s array<double>").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, i long, s array<double>").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = stacks.stacks(stream, "k", "i", "s", 4).writeStream.format("memory").queryName("stacked").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    assert run.awaitTermination(120)
    assert sorted((r["block"], r["s"]) for r in spark.table("stacked").collect()) == [(0, [6.0, 4.0]), (1, [22.0, 4.0])]
