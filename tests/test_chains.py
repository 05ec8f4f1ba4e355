"""Focusing, interferometry, ranging, terrain and labels against analytic truth."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.functions import traces
from fathomline.operators import focusing, interferometry, kernels, ranging, terrain, windows
from fathomline.sources import binary, labels

LABEL = """
OBJECT = COLUMN
  NAME = SCAN
  DATA_TYPE = MSB_UNSIGNED_INTEGER
  BYTES = 4
END_OBJECT = COLUMN
OBJECT = COLUMN
  NAME = MODE
  DATA_TYPE = MSB_BIT_STRING
  BYTES = 2
  OBJECT = BIT_COLUMN
    NAME = HIGH
    BIT_DATA_TYPE = MSB_UNSIGNED_INTEGER
    START_BIT = 1
    BITS = 5
  END_OBJECT = BIT_COLUMN
  OBJECT = BIT_COLUMN
    NAME = SPARE
    BIT_DATA_TYPE = MSB_UNSIGNED_INTEGER
    START_BIT = 6
    BITS = 3
  END_OBJECT = BIT_COLUMN
  OBJECT = BIT_COLUMN
    NAME = LOW
    BIT_DATA_TYPE = MSB_INTEGER
    START_BIT = 9
    BITS = 8
  END_OBJECT = BIT_COLUMN
END_OBJECT = COLUMN
OBJECT = COLUMN
  NAME = SPARE1
  DATA_TYPE = MSB_UNSIGNED_INTEGER
  BYTES = 3
END_OBJECT = COLUMN
OBJECT = COLUMN
  NAME = TIME
  DATA_TYPE = CHARACTER
  BYTES = 5
END_OBJECT = COLUMN
"""


def test_labels(spark, tmp_path):
    layout = labels.layout(LABEL, (("samples", "i1", (3,)),))
    assert layout == [("SCAN", ">u4"), ("MODE", "V2"), ("SPARE0", "V3"), ("TIME", "S5"), ("samples", "i1", (3,))]
    fields = labels.bit_fields(LABEL)["MODE"]
    assert fields == [("HIGH", 0, 5, False), ("LOW", 8, 8, True)]
    (tmp_path / "a.dat").write_bytes(b"\x00\x00\x01\x02" + bytes([0b10110_000, 0xFE]) + b"xyz" + b"ab   " + bytes([1, 255, 3]))
    rows = binary.records(spark, str(tmp_path), layout, "*.dat")
    got = rows.select("SCAN", "TIME", "samples", *(labels.bits("MODE", a, n, s).alias(x) for x, a, n, s in fields)).first()
    assert (got["SCAN"], got["TIME"], got["samples"], got["HIGH"], got["LOW"]) == (258, "ab", [1, -1, 3], 22, -2)


@pytest.mark.parametrize("bad", [LABEL.replace("START_BIT = 9", "START_BIT = 10"), LABEL + "OBJECT = COLUMN\n", "END_OBJECT = COLUMN\n"])
def test_bad_labels(bad):
    with pytest.raises(ValueError):
        labels.bit_fields(bad)


def test_packed_samples(spark):
    values = [1, -1, 31, -32, 0, 5, -7, 12]
    word = "".join(f"{v & 63:06b}" for v in values)
    packed = bytearray(int(word, 2).to_bytes(6, "big"))
    df = spark.createDataFrame([(packed,), (bytearray(),)], "b binary")
    assert sorted((r[0] for r in df.select(traces.unpack6("b")).collect()), key=len) == [[], values]


def test_rays_obey_snell():
    x, depth, er, h = np.array([-800.0, 0.0, 1500.0]), np.array([100.0, 900.0]), 3.15, 3.0e5
    s = focusing.refracted(x, h, depth, er)
    quartic = (er - 1) * s**2 * (x[:, None] - s) ** 2 + er * h**2 * s**2 - depth**2 * (x[:, None] - s) ** 2
    assert np.abs(quartic / h**2).max() < 1e-4
    assert (np.sign(s) == np.sign(x)[:, None]).all() or s[1].tolist() == [0, 0]


def test_path_excess_meets_at_the_surface():
    x = np.linspace(-500, 500, 11)
    air = focusing.path_excess(x, 3.0e5, 100, 40)
    ice = focusing.path_excess(x, 3.0e5, 100, 40, 3.1)
    assert np.allclose(air[:, :41], ice[:, :41]) and (ice[:, 60] >= 0).all() and ice[5].max() == pytest.approx(0)
    held = focusing.path_excess(x, 3.0e5, 100, 40, 3.1, every=5)
    assert np.allclose(held[:, 41:46], ice[:, 41:42])


def test_delay_doppler_sums_a_point(spark):
    """A point under the middle of the aperture: after migration its energy is in one bin and sample."""
    n, m, f, dt, rate = 64, 81, kernels.HIGH_HZ, kernels.SAMPLE_S, 175.0
    x = (np.arange(m) - m // 2) * 20.0
    r = np.hypot(3.0e5, x)
    away = r - r[min(-(-m // 2), m - 1)]
    pulse = np.fft.fft(np.eye(n)[20])
    data = np.fft.ifft(pulse * np.exp(-2j * np.pi * (2 * away / kernels.LIGHT)[:, None] * np.fft.fftfreq(n, dt))) * np.exp(4j * np.pi * f / kernels.LIGHT * away)[:, None]
    power = np.abs(focusing.spherical(data, r, rate, f, dt))
    assert power.argmax() == 20 and power[20] > 5 * np.abs(data).sum(axis=0).max() / m


def test_coregistration_finds_shifts(spark):
    rng = np.random.default_rng(5)
    a = rng.standard_normal((4, 128)) + 1j * rng.standard_normal((4, 128))
    a = np.fft.ifft(np.fft.fft(a) * np.exp(-((np.fft.fftfreq(128) * 6) ** 2)))
    want = np.array([2.0, -3.5, 0.25, 0.0])
    b = kernels.delayed(a, -want)
    df = spark.createDataFrame([("p", i, x.real.tolist(), x.imag.tolist(), y.real.tolist(), y.imag.tolist()) for i, (x, y) in enumerate(zip(a, b, strict=True))], "k string, i long, ar array<double>, ai array<double>, br array<double>, bi array<double>")
    out = interferometry.coregister(df, "k", "i", ("ar", "ai"), ("br", "bi"), factor=8, reach=64, subsample=True).orderBy("i").collect()
    assert [r["shift"] for r in out] == pytest.approx(list(want), abs=0.1)  # a tenth of a sample
    moved = kernels.delayed(b, np.array([r["shift"] for r in out]))
    assert np.allclose(np.array([r["b_re"] for r in out]), moved.real) and np.allclose(np.array([r["b_im"] for r in out]), moved.imag)
    chunked = interferometry.coregister(df, "k", "i", ("ar", "ai"), ("br", "bi"), factor=8, reach=64, adaptive=True, most=3)
    assert chunked.count() == 4


def test_phase_density_integrates_to_one(spark):
    n = 2000
    at = spark.range(n).select(((F.col("id") + 0.5) * (2 * np.pi / n) - np.pi).alias("x"))
    for g, looks in ((0.5, 1), (0.9, 4), (0.97, 12.5)):
        total, mean = at.select(interferometry.phase_density("x", F.lit(0.3), g, looks).alias("f"), "x").agg(F.sum("f") * 2 * np.pi / n, F.sum(F.col("f") * F.sin(F.col("x") - 0.3))).first()
        assert total == pytest.approx(1, abs=1e-6) and abs(mean) < 1e-6


def test_ranging_finds_the_lag(spark):
    rng = np.random.default_rng(2)
    wide = np.cumsum(rng.standard_normal((40, 80)), axis=1)
    df = spark.createDataFrame([("p", i, w[10:70].tolist(), w[7:67].tolist()) for i, w in enumerate(wide)], "k string, i long, s array<double>, m array<double>")
    got = ranging.offset(df, "k", "i", "s", "m", 100.0, 100.0, 3, 8).first()
    assert got["delta"] == pytest.approx(3, abs=0.5) and got["dz"] == pytest.approx(got["delta"] * kernels.SAMPLE_S * kernels.LIGHT / 2)
    best = ranging.best_setting(df, "k", "i", "s", "m", [5.0, 100.0], 100.0, 3, 8).first()
    assert best["residual"] <= got["residual"]


def test_heights(spark):
    grid = spark.createDataFrame([(r, c, 10.0 * r + c) for r in range(3) for c in range(3) if (r, c) != (2, 2)], "row int, col int, z double")
    points = spark.createDataFrame([(1, 9.5, 100.5), (2, 10.0, 101.0), (3, 9.75, 101.0), (4, 50.0, 0.0), (5, 8.0, 102.0), (6, None, 101.0)], "id int, lat double, lon double")
    got = {r["id"]: r["height"] for r in terrain.heights(points, grid, "id", "lat", "lon", 10.0, 100.0, 1.0).collect()}
    assert got == {1: pytest.approx(5.5), 2: 1.0, 3: pytest.approx(3.5), 4: None, 5: None, 6: None}


def test_even_spacing(spark, monkeypatch):
    x = [5.0, 5.5, 7.0, 7.0, 9.2]
    df = spark.createDataFrame([("p", i, v, 3 * v, [v, -v]) for i, v in enumerate(x)], "k string, i long, x double, v double, a array<double>")
    run = lambda: [(r["line"], r["x"], round(r["v"], 9), [round(y, 9) for y in r["a"]]) for r in windows.resampled(df, "k", "i", "x", 1.0, ["v"], ["a"]).orderBy("line").collect()]
    want = [(n, float(n), 3 * (5.0 + n), [5.0 + n, -5.0 - n]) for n in range(5)]
    assert run() == want
    monkeypatch.setattr(windows, "CHUNK", 2)
    assert run() == want


def test_streams_of_varying_records(spark, tmp_path):
    def record(n, choff, fill, stamps=None):
        kind = binary.STREAMS[0 if stamps is None else 5]
        head = np.zeros(1, kind)
        head["nsamp"], head["choff"], head["ver"] = n, choff, 0 if stamps is None else 5
        if stamps is not None:
            head["tscount"] = stamps
        return head.tobytes() + b"\0" * 8 * (stamps or 0) + np.full(2 * n, fill, ">i2").tobytes()

    (tmp_path / "a.old").write_bytes(record(3, 0xFF, -7) + record(2, 2, 300) + record(4, 0, 1)[:-1])
    (tmp_path / "b.new").write_bytes(record(1, 0, 5, stamps=2) + record(2, 0, 6, stamps=0))
    (tmp_path / "c.old").write_bytes(b"")
    old = binary.streams(spark, str(tmp_path), glob="*.old").orderBy("record", "channel").collect()
    assert [(r["record"], r["channel"], r["samples"]) for r in old] == [(0, 1, [-7] * 3), (0, 2, [-7] * 3), (1, 3, [300] * 2), (1, 4, [300] * 2)]
    new = binary.streams(spark, str(tmp_path), channels=(2,), glob="*.new").orderBy("record").collect()
    assert [(r["channel"], r["samples"]) for r in new] == [(2, [5]), (2, [6, 6])]


def test_dechirping_removes_tones():
    n = 100
    reference = np.ones(n)
    pulse = np.zeros((2, n))
    pulse[0, 30], pulse[1, 70] = 50, 40
    out = kernels.dechirped(pulse, reference, tones=())
    assert np.abs(out).argmax(axis=1).tolist() == [30, 70] and np.abs(out.mean(axis=1)).max() < 1e-9
    spectrum = np.ones((1, n), complex)
    spectrum[0, 21] = 500
    assert np.allclose(kernels.without_tone(spectrum, 21), 1)
