"""Resampled lines, derivatives, bounded searches and statistics of phases, against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.functions import rotation
from fathomline.functions.derivatives import Dual, jacobian
from fathomline.operators import optimisation, phases, resampling


def plain_lines(parts, posting, half, full, none, low, high, blank, tone):
    """parts: for each segment places and traces. Lines by number, without chunks: the filters by their definitions, the parabola through the three nearest traces."""
    m = np.arange(-half, half + 1)
    f = np.linspace(-0.5, 0.5, 200_001)
    response = np.where(np.abs(f) <= full, 1.0, np.where(np.abs(f) < none, 0.5 + 0.5 * np.cos(np.pi * (np.abs(f) - full) / (none - full)), 0.0))
    taps = np.array([np.trapezoid(response * np.cos(2 * np.pi * f * k), f) for k in m])
    taps /= taps.sum()
    out = {}
    for x, data in parts:
        data = data.copy()
        data[:, :blank] = 0
        k = np.arange(data.shape[1])
        flat = np.array([d - np.polyval(np.polyfit(k, d, 1), k) for d in data])
        spectrum = np.fft.fft(flat)
        if tone:
            share, tail = tone
            n = data.shape[1]
            leak = sum(data[:, i] * np.exp(-2j * np.pi * share * i) for i in range(n - tail, n)) * n / tail
            spectrum[:, round(share * n)] -= leak
            spectrum[:, -round(share * n)] -= leak.conj()
        flat = np.fft.ifft(spectrum * resampling.band_pass(data.shape[1], low, high)).real
        smooth = np.array([sum(t * flat[min(max(i + j, 0), len(flat) - 1)] for t, j in zip(taps, m, strict=True)) for i in range(len(flat))])
        for line in range(math.floor(x[0] / posting + 0.99999), math.floor(x[-1] / posting) + 1):
            at = line * posting
            if len(x) == 1:
                out[line] = smooth[0]
            elif len(x) == 2:
                out[line] = smooth[0] + (at - x[0]) / (x[1] - x[0]) * (smooth[1] - smooth[0])
            else:
                i = min(max(int(np.argmin(np.abs(x - at))), 1), len(x) - 2)
                out[line] = sum(smooth[p] * math.prod((at - x[q]) / (x[p] - x[q]) for q in (i - 1, i, i + 1) if q != p) for p in (i - 1, i, i + 1))
    return out


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_lines_of_any_chunk_size(spark, chunk):
    r = np.random.default_rng(5)
    rows, parts, start, o = [], [], 0.0, 0
    for seg, n in enumerate((40, 2, 1, 23)):
        x = start + np.cumsum(r.uniform(0.5, 3.5, n))
        if n == 1:
            x = np.ceil(x / 2) * 2  # on a posting, so that the single trace gives a line
        data = r.standard_normal((n, 40)) + 3
        parts.append((x, data))
        rows += [("a", seg, o + i, float(p), d.tolist()) for i, (p, d) in enumerate(zip(x, data, strict=True))]
        start, o = x[-1] + 30, o + n
    df = spark.createDataFrame(rows, "p string, seg int, o int, x double, s array<double>").repartition(3)
    how = dict(half=6, full=0.1, none=0.15, low=0.05, high=0.35, blank=4, tone=(0.2, 20))
    got = {x["line"]: x for x in resampling.filtered_lines(df, "p", "seg", "o", "x", "s", 2.0, chunk=chunk, **how).collect()}
    want = plain_lines(parts, 2.0, *how.values())
    assert {k for k, x in got.items() if not x["filled"]} == set(want)
    assert all(np.allclose(got[k]["s"], v, atol=1e-7) for k, v in want.items())
    assert sorted(got) == list(range(min(want), max(want) + 1))  # gaps are filled
    assert resampling.line_counts(df, "p", "seg", "o", "x", 2.0).collect()[0]["lines"] == len(got)
    assert resampling.filtered_lines(df.limit(0), "p", "seg", "o", "x", "s", 2.0).count() == 0


def test_tone_is_taken_off():
    t = np.arange(200)
    leak = 5 * np.cos(2 * np.pi * 0.2 * t + 1)
    out = resampling.range_filtered(leak[None], 0.05, 0.35, tone=(0.2, 100))
    assert np.abs(out).max() < 0.02 * np.abs(resampling.range_filtered(leak[None], 0.05, 0.35)).max()


def test_traces_in_one_place():
    x = np.array([0.0, 1.0, 1.0, 1.0, 2.0])
    first, weights = resampling._weights(x, np.array([1.0]), 5)
    assert weights.sum() == 1 and set(np.unique(weights)) == {0, 1} and x[first[0] + int(weights[0].argmax())] == 1


def test_polynomials_of_second_degree_move(spark):
    assert rotation.shifted((0.0, 0.0, 1.0), 2.0) == (4.0, 4.0, 1.0)
    model = rotation.Rotation((10.0, -3.0, 0.7), (50.0, 2.0, -0.4), (20.0, 350.0, 1e-4), epoch=100.0)
    moved = rotation.at_epoch(model, 5000.0)
    days = spark.createDataFrame([(0.0,), (7305.5,), (-300.25,), (5000.0,)], "t double")
    for r in days.select(*rotation.angles("t", model), *rotation.angles("t", moved)).collect():
        assert np.allclose(r[:3], r[3:], rtol=1e-12, atol=1e-6)


def test_rotation_partials_are_central_differences(spark):
    from dataclasses import replace

    model = rotation.MODELS["Kuchynka2014"]
    rows = spark.createDataFrame([(1234.5, 3.0, -2.0, 1.0), (-200.0, 0.1, 5.0, -4.0)], "t double, x double, y double, z double")

    def changed(name, by):
        if name.startswith("offset"):
            offset = list(model.offset)
            offset["xyz".index(name[-1])] += by
            return replace(model, offset=tuple(offset))
        field, index = name[:-1], int(name[-1])
        if "_" in field:
            base, part = field.rsplit("_", 1)
            terms = getattr(model, f"{base}_terms")
            return replace(model, **{f"{base}_terms": replace(terms, **{part: tuple(v + by * (i == index) for i, v in enumerate(getattr(terms, part)))})})
        return replace(model, **{field: tuple(v + by * (i == index) for i, v in enumerate(getattr(model, field)))})

    steps = {"ascension0": 1e-4, "ascension1": 1e-3, "declination0": 1e-4, "declination1": 1e-3, "meridian0": 1e-4, "meridian1": 1e-7, "offset_x": 1e-3, "offset_z": 1e-3, "ascension_amplitude4": 1e-3, "declination_phase4": 1e-2, "meridian_rate5": 1e-6}
    got = rows.select(*(c.alias(n) for n, c in rotation.body_partials("t", "x", "y", "z", model, list(steps)).items())).collect()
    for name, h in steps.items():
        up, down = (rows.select(*rotation.to_body("t", "x", "y", "z", changed(name, s * h))).collect() for s in (1, -1))
        for g, a, b in zip(got, up, down, strict=True):
            want = (np.array(a) - np.array(b)) / (2 * h)
            assert np.allclose([g[f"d{c}_d{name}"] for c in "xyz"], want, rtol=1e-4, atol=1e-5 * max(1, np.abs(want).max()))
    with pytest.raises(ValueError, match="no such parameters"):
        rotation.body_partials("t", "x", "y", "z", model, ["ascension9"])


def test_helmert_partials_are_central_differences(spark):
    from fathomline.functions import geometry

    q, d = (0.9, 0.3, -0.2, 0.4), (1.0, -2.0, 0.5)
    names = ["q0", "q1", "q2", "q3", "offset_x", "offset_y", "offset_z"]
    rows = spark.createDataFrame([(3.0, -2.0, 1.0), (0.0, 0.0, 0.0)], "x double, y double, z double")
    got = rows.select(*(c.alias(n) for n, c in rotation.helmert_partials(q, d, "x", "y", "z", names).items())).collect()
    for i, name in enumerate(names):
        value = lambda s, i=i: (p := [v + s * 1e-6 * (j == i) for j, v in enumerate((*q, *d))], rows.select(*geometry.rotated(tuple(map(F.lit, p[:4])), F.col("x") + p[4], F.col("y") + p[5], F.col("z") + p[6])).collect())[1]
        for g, a, b in zip(got, value(1), value(-1), strict=True):
            assert np.allclose([g[f"d{c}_d{name}"] for c in "xyz"], (np.array(a) - np.array(b)) / 2e-6, atol=1e-6)
    none = rows.select(*rotation.helmert_partials((0, 0, 0, 0), d, "x", "y", "z", ["q0"]).values()).first()
    assert list(none) == [None] * 3


def test_dual_numbers(spark):
    x = Dual.parameter("x", F.lit(2.0))
    out = jacobian({"f": (x * x + 3.0).sqrt() / x - 1.0 * x}, ["x", "y"])
    r = spark.range(1).select(*(c.alias(n) for n, c in out.items())).first()
    assert r["df_dx"] == pytest.approx(1 / math.sqrt(7) - math.sqrt(7) / 4 - 1) and r["df_dy"] == 0


def test_least_values_within_bounds():
    """Many valleys: the deepest is found, on a bound too, whichever functions are searched together."""
    r = np.random.default_rng(1)
    place, seeds = r.uniform(0, 100, 40), np.arange(40, dtype=np.uint64)
    place[0], place[1] = 0.0, 100.0
    deep = lambda p: lambda x: 1 - 0.5 * np.exp(-(((x - p) / 3) ** 2)) - 0.2 * np.cos(x - p) ** 2
    x, value = optimisation.minimise(deep(place), 0.0, 100.0, seeds)
    assert np.abs(x - place).max() < 1e-5 and np.allclose(value, 0.3)
    one, _ = optimisation.minimise(deep(place[7:8]), 0.0, 100.0, seeds[7:8])
    assert one[0] == x[7]


@pytest.mark.parametrize("measure", ["signal_to_noise", "peak"])
def test_planted_ionospheres(spark, measure):
    r = np.random.default_rng(3)
    n, unit = 3600, 1e16 / 0.29
    planted = np.repeat(r.uniform(0.1, 0.9, 3), 4) * unit
    pulse = np.fft.ifft(optimisation.chirp_spectra(n, planted))
    echo = np.roll(pulse.real, 900, axis=1) + 0.05 * r.standard_normal(pulse.shape)
    df = spark.createDataFrame([("p", i // 4, i, e.tolist()) for i, e in enumerate(echo)], "p string, c int, i int, s array<double>").repartition(3)
    out = optimisation.ionosphere(df, "p", "c", "i", "s", measure=measure).orderBy("i").collect()
    assert np.abs(np.array([x["electron"] for x in out]) - planted).max() < 0.02 * unit
    for x in out:
        assert x["chunk_electron"] == pytest.approx(np.mean([y["electron"] for y in out if y["c"] == x["c"]]))
        assert len(x["re"]) == n
    with pytest.raises(ValueError, match="no such measure"):
        optimisation.ionosphere(df, "p", "c", "i", "s", measure="loudest")


def test_independent_samples(spark):
    white = [("w", lag, 1.0 if lag == 0 else 0.02) for lag in range(5)]
    alike = [("a", lag, 1.0) for lag in range(5)]
    slow = [("s", lag, 1 - lag / 4) for lag in range(5)]
    df = spark.createDataFrame(white + alike + slow, "k string, lag int, coherence double")
    counts = spark.createDataFrame([("w", 100), ("a", 100), ("s", 100)], "k string, n long")
    got = {r["k"]: (r["spacing"], r["looks"]) for r in phases.independent_samples(df, counts, ["k"], level=0.4).collect()}
    assert got["w"] == (1.0, 100.0) and got["a"] == (None, 1.0)
    assert got["s"][0] == pytest.approx(2.4) and got["s"][1] == pytest.approx(100 / 2.4)


def test_drawn_phases(spark):
    table = phases.empirical_density(spark, 0.6, 3.0, 15.0, points=2001).toPandas()
    assert np.trapezoid(table["density"], table["phase"]) == pytest.approx(1, abs=1e-6)
    assert np.allclose(phases._density(table["phase"].to_numpy(), math.radians(15), 0.6, 3.0), table["density"], rtol=1e-9)
    deviation = phases.deviation_deg(0.6, 3.0)
    q = phases.quantiles(0.6, 3.0)
    assert np.degrees(q.std()) == pytest.approx(deviation, rel=1e-3) and abs(q.mean()) < 1e-6
    rows = spark.range(4000)
    means = {r["id"]: r["mean"] for r in phases.drawn_means(rows.repartition(7), "id", 6, 0.6, 3.0).collect()}
    assert means == {r["id"]: r["mean"] for r in phases.drawn_means(rows.repartition(2), "id", 6, 0.6, 3.0).collect()}
    assert np.degrees(np.std(list(means.values()))) == pytest.approx(deviation / math.sqrt(6), rel=0.05)
    wide = phases.sample_mean_deviation(spark, 5, 0.4, 1.0, simulations=4000).first()
    assert wide["deviation"] > 30 and wide["mean_deviation"] == pytest.approx(wide["deviation"] / math.sqrt(5), rel=0.05)
    narrow = phases.sample_mean_deviation(spark, 5, 0.95, 8.0).first()
    assert narrow["deviation"] < 30 and narrow["mean_deviation"] == pytest.approx(narrow["deviation"] / math.sqrt(5))


@pytest.mark.parametrize("chunk", [7, 4096])
def test_doppler_looks_of_any_chunk_size(spark, chunk):
    """Against the definition: every trace moved by whole samples, then a spectrum along track."""
    from fathomline.operators import focusing

    r = np.random.default_rng(9)
    n, k, width = 23, 30, 6
    data = r.standard_normal((n, k)) + 1j * r.standard_normal((n, k))
    place = np.stack([3.69e6 + r.uniform(0, 50, n), np.arange(n) * 900.0, np.zeros(n)], 1)
    opening = r.integers(0, 4, n)
    df = spark.createDataFrame([("a", i, d.real.tolist(), d.imag.tolist(), *map(float, p), 3.39e6, int(o)) for i, (d, p, o) in enumerate(zip(data, place, opening, strict=True))], "p string, i long, re array<double>, im array<double>, x double, y double, z double, g double, o int").repartition(3)
    got = {(x["i"], x["bin"]): x["magnitude"] for x in focusing.doppler_looks(df, "p", "i", "re", "im", ("x", "y", "z"), "g", "o", width, 2, ways=2, chunk=chunk).collect()}
    assert len(got) == n * 5
    for i in range(n):
        signal = np.zeros((width + 1, k), complex)
        below = place[i] / np.linalg.norm(place[i]) * 3.39e6
        for j in range(max(0, i - 3), min(n, i + 4)):
            away = abs(np.linalg.norm(place[j] - below) - np.linalg.norm(place[i] - below))
            for m in range(k):
                s = int(m + 2 * away / 299792458.0 / 0.0375e-6 - opening[j] + opening[i])
                if 0 <= s < k:
                    signal[j - i + 3, m] = data[j, s]
        spectrum = np.abs(np.fft.fft(signal, axis=0))
        assert all(np.allclose(got[i, b], spectrum[b]) for b in range(-2, 3))
    assert focusing.doppler_looks(df.limit(0), "p", "i", "re", "im", ("x", "y", "z"), "g", "o", width).count() == 0
