"""What is planted between two antennas comes off again, and clutter off nadir has the phase it should."""

import numpy as np
from pyspark.sql import functions as F

from fathomline.plans import interferometer as plan


def smooth(r, n, k):
    """Speckle without the highest frequencies, so that fractional shifts are exact."""
    spectrum = np.fft.fft(r.standard_normal((n, k)) + 1j * r.standard_normal((n, k)))
    spectrum[:, k // 2 - 6 : k // 2 + 7] = 0
    return np.fft.ifft(spectrum)


def shifted(z, by):
    return np.fft.ifft(np.fft.fft(z) * np.exp(-2j * np.pi * np.fft.fftfreq(z.shape[1])[None] * np.reshape(by, (-1, 1))))


def table(spark, key, a, b, loops):
    rows = [(key, i, a[i].real.tolist(), a[i].imag.tolist(), b[i].real.tolist(), b[i].imag.tolist(), loops[0][i].tolist(), loops[1][i].tolist()) for i in range(len(a))]
    return spark.createDataFrame(rows, "p string, i long, ar array<double>, ai array<double>, br array<double>, bi array<double>, loop_a array<double>, loop_b array<double>").repartition(3)


def test_planted_differences_come_off(spark):
    r = np.random.default_rng(3)
    n, k = 30, 256
    own = plan.Antennas(19.0, 5.0, loopback_reach=4, factor=10, reach=40, look=5)
    z = smooth(r, n, k)
    late_a, late_b = r.integers(-2, 3, n), r.integers(-2, 3, n)
    late_a[0] = late_b[0] = 0
    roll = np.repeat(r.uniform(-0.05, 0.05, n // 5), 5)
    phase = 2 * np.pi * 19 / 5 * np.sin(roll)
    chirp = r.uniform(1, 50, 60)
    a = np.array([np.roll(x, s) for x, s in zip(z, late_a, strict=True)])
    b = np.array([np.roll(x, s) for x, s in zip(shifted(z, -1.3) * np.exp(1j * phase)[:, None], late_b, strict=True)])
    loops = [np.array([np.roll(chirp, s) for s in late]) for late in (late_a, late_b)]
    df = table(spark, "x", a, b, loops)
    rolls = spark.createDataFrame([("x", i, float(v)) for i, v in enumerate(roll)], "p string, i long, roll double")
    done = plan.registered(df, rolls, "p", "i", own)
    assert {round(x["shift"], 6) for x in done.collect()} == {1.3}
    rows = plan.interferogram(done, "p", "i", own).collect()
    assert len(rows) == 6 * (k - 1)
    assert max(abs(x["phase"]) for x in rows) < 1e-6 and min(x["correlation"] for x in rows) > 1 - 1e-6
    bare = plan.interferogram(plan.registered(df, None, "p", "i", own), "p", "i", own)
    level = {x["look"]: x["m"] for x in bare.groupBy("look").agg(F.avg("phase").alias("m")).collect()}
    assert all(abs(level[i // 5] + phase[i]) < 1e-6 for i in range(n))  # the roll is what is left
    assert plan.power(done, "p", "i", own).count() == 6 * k
    assert plan.interferogram(plan.registered(df.limit(0), rolls, "p", "i", own), "p", "i", own).count() == 0


def test_clutter_has_the_phase_of_its_angle(spark):
    own = plan.Antennas(19.0, 5.0, look=1, start=0.0)
    looks = range(4)
    angle = np.arccos(80 / 100)
    expected = float(-2 * np.pi * 19 / 5 * np.sin(angle - 0.01))
    rows = [("x", i, k, (expected + 0.4 + 0.1 * i if k == 100 else 0.4 + 0.1 * i if k == 80 else 0.0), 0.9) for i in looks for k in (80, 100, 120)]
    phases = spark.createDataFrame(rows, "p string, look long, k int, phase double, correlation double")
    surface = spark.createDataFrame([("x", i, 80) for i in looks], "p string, look long, k int")
    features = spark.createDataFrame([("x", i, 100) for i in looks] + [("x", 1, 120)], "p string, look long, k int")
    rolls = spark.createDataFrame([("x", i, 0.01) for i in looks], "p string, i long, roll double")
    out = plan.clutter(phases, surface, features, rolls, "p", "i", own).collect()
    assert len(out) == 5
    for x in out:
        if x["k"] == 100:
            assert abs(x["phase"] - expected) < 1e-9 and abs(x["expected"] - expected) < 1e-9 and abs(x["difference"]) < 1e-9
        else:
            assert abs(x["difference"]) > 0.1  # below the surface, not beside it
