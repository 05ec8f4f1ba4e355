"""Paths, lookups, channel lists, and the surface chain on worked fixtures."""

import pytest

from fathomline.functions import signal
from fathomline.operators import aggregates, ionosphere, surface, windows
from fathomline.plans import paths


def index(spark):
    rows = [("mrosh_0001", "data/edr01xxx/edr0187401/e_0187401_001_ss19_700_a.lbl", "e_0187401_001_ss19_700_a", "0187401"), ("mrosh_0001", "data/edr01xxx/edr0187401/e_0187401_002_ss19_700_a.lbl", "e_0187401_002_ss19_700_a", "0187401")]
    return spark.createDataFrame(rows, "volume_id string, file_specification_name string, product_id string, orbit string")


def test_paths(spark):
    got = {(r["product_id"][10:13], r["name"]): r["path"] for r in paths.files(index(spark), "/o", "/t").collect()}
    assert len(got) == 24
    assert got["001", "edr_lbl"] == "/o/EDR/mrosh_0001/data/edr01xxx/edr0187401/e_0187401_001_ss19_700_a.lbl"
    assert got["002", "cmp_tecu"] == "/t/cmp/mrosh_0001/data/edr01xxx/edr0187401/ion/e_0187401_002_ss19_700_a_s_TECU.txt"
    other = paths.files(index(spark), "/o", "/t", ("srf",), {"srf": "foc"}).collect()
    assert {r["path"] for r in other} == {f"/t/srf/mrosh_0001/data/edr01xxx/edr0187401/foc/e_0187401_00{i}_ss19_700_a.txt" for i in (1, 2)}


def test_lookups(spark):
    asked = spark.createDataFrame([("0187401",), ("e_0187401_002_ss19_700_a",), ("9999999",), ("e_0187401_009_ss19_700_a",)], "name string")
    many = {(r["name"], r["product_id"]) for r in paths.resolved(asked, index(spark), "name").collect()}
    assert many == {("0187401", "e_0187401_001_ss19_700_a"), ("0187401", "e_0187401_002_ss19_700_a"), ("e_0187401_002_ss19_700_a", "e_0187401_002_ss19_700_a"), ("9999999", None), ("e_0187401_009_ss19_700_a", None)}
    one = {r["name"]: r["product_id"] for r in paths.resolved(asked, index(spark), "name", single=True).collect()}
    assert one == {"0187401": "e_0187401_001_ss19_700_a", "e_0187401_002_ss19_700_a": "e_0187401_002_ss19_700_a", "9999999": None, "e_0187401_009_ss19_700_a": None}
    with pytest.raises(KeyError, match="9999999, e_0187401_009"):
        paths.required(asked.where("name <> '0187401'"), index(spark), "name")


def test_focused_paths(spark):
    aux, other = (spark.createDataFrame([(x,)], "path string") for x in ("/o/EDR/mrosh_0001/data/e_0187401_001_ss19_700_a_a.dat", "/elsewhere/e_a.dat"))
    at = paths.focused("path", "/o", "/t", "Delay Doppler v2", {"ddv2_interpolate_dx [m]": 5, "ddv2_posting_interval [range lines]": 5, "ddv2_aperture_dist [km]": 6})
    assert aux.select(at).first()[0] == "/t/foc/mrosh_0001/data/5m/5 range lines/6km/e_0187401_001_ss19_700_a_s.h5"
    with pytest.raises(Exception, match="not in the archive"):
        other.select(at).collect()
    with pytest.raises(ValueError, match="no such focuser"):
        paths.focused("path", "/o", "/t", "other", {})


def test_channel_lists():
    assert signal.channel_specs("3") == [(3, 3, 1.0, 0, 0.0)]
    assert signal.channel_specs("[1,1,0.5,2,0.5; 2,3,1,0,0;]") == [(1, 1, 0.5, 2, 0.5), (2, 3, 1.0, 0, 0.0)]
    with pytest.raises(ValueError, match="4 values"):
        signal.channel_specs("[1,2,3,4]")


def test_surface_without_altimetry(spark):
    traces = spark.createDataFrame([("p", 0, [0.0, 1.0, 5.0, 4.0, 0.0, 9.0, 0.0, 0.0], [0.0] * 8), ("p", 1, [0.0] * 8, [0.0] * 8)], "product string, trace int, re array<double>, im array<double>")
    aux = spark.createDataFrame([("p", i, 250.0) for i in (0, 1)], "product string, trace int, SPACECRAFT_ALTITUDE double")
    got = {r["trace"]: r for r in surface.surfaces(traces, None, aux, "product", "trace", width=4, antenna=False).collect()}
    assert (got[0]["surf_y"], round(got[0]["surf_amp"], 6), got[0]["flag"]) == (1, 1.0, 0)  # 1 * (25 - 1) beats 25 * (16 - 25)
    assert (got[1]["surf_y"], got[1]["surf_amp"], got[1]["surf_pow"]) == (0, 0.0, float("-inf"))


def test_circles_hold_their_rim(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 2.0), (1.0, 0.0, 4.0), (5.0, 5.0, 1.0)], "lon double, lat double, v double")
    got = {(r["col"], r["row"]): (r["n"], r["mean"]) for r in surface.circles(rows, "lon", "lat", "v", 1.0, (0.0, 2.0, 0.0, 1.0)).collect()}
    assert got == {(0, 0): (2, 3.0), (1, 0): (2, 3.0), (2, 0): (1, 4.0), (0, 1): (1, 2.0), (1, 1): (1, 4.0)}


def test_electron_content_of_equal_paths(spark):
    """Echoes that differ by the ionosphere's delay alone give its content back."""
    tec, f = 7e15, 4e6
    late = ionosphere.DELAY * tec * (1 / f**2 - 1 / 4e14) / 6.283185307179586
    high = spark.createDataFrame([(1, 10, 1e-3, 300.0, 0.0)], "g int, id int, time double, altitude double, height double")
    low = spark.createDataFrame([(1, 20, 1e-3 + late, 300.0, 0.0, 0), (1, 21, None, 300.0, 0.0, 0), (2, 22, 1e-3, 300.0, 0.0, 0)], "g int, id int, time double, altitude double, height double, band int")
    got = ionosphere.electron_content(high, low, "g", "1").collect()
    assert [(r["high_id"], r["low_id"]) for r in got] == [(10, 20)] and abs(got[0]["tec"] / tec - 1) < 1e-6


def test_padding_modes(spark):
    df = spark.createDataFrame([("a", 5, [1, 2]), ("a", 6, [3, 4])], "k string, i int, s array<int>")
    got = [(r["i"], r["s"]) for r in windows.padded(df, "k", "i", "s", 1, 2, "zeros").orderBy("i").collect()]
    assert got == [(0, [0, 0]), (1, [1, 2]), (2, [3, 4]), (3, [0, 0]), (4, [0, 0])]
    assert windows.skipped(df, "k", "i", 1, 0).count() == 1 and windows.region(df, "i", 5, 9, 1).count() == 1
    with pytest.raises(ValueError, match="no such mode"):
        windows.padded(df, "k", "i", "s", 1, 1, "wrap")


def test_one_channel_is_scaled(spark):
    stacks = spark.createDataFrame([(0, 1, [10.0, 20.0]), (1, 1, [1.0, 1.0]), (0, 2, [4.0, 8.0])], "block int, channel int, samples array<double>")
    specs = spark.createDataFrame(signal.channel_specs("[1,1,1,2,0.5; 2,1,2,0,0]"), "chanout int, chan0in int, scalef0 double, chan1in int, scalef1 double")
    got = {(r["chanout"], r["block"]): r["samples"] for r in aggregates.paired_stacks(stacks, specs, "block", "samples", 2).collect()}
    assert got == {(1, 0): [6.0, 12.0], (2, 0): [10.0, 20.0], (2, 1): [1.0, 1.0]}


def test_rotation_models(spark):
    """Round trips, another epoch, librations, and the published angles at the epoch."""
    import math

    from fathomline.functions import rotation

    rows = spark.createDataFrame([(0.0, 1.0, 2.0, 3.0), (7305.5, -4.0, 0.5, 9.0), (-300.25, 0.0, 0.0, 0.0)], "t double, x double, y double, z double")
    for model in rotation.MODELS.values():
        moved = rotation.at_epoch(model, 3652.5)
        out = rows.withColumns(dict(zip("uvw", rotation.to_body("t", "x", "y", "z", model), strict=True))).withColumns(dict(zip("abc", rotation.to_inertial("t", "u", "v", "w", model), strict=True)))
        out = out.withColumns(dict(zip(("d1", "d2", "d3"), rotation.angles("t", model), strict=True)) | dict(zip(("e1", "e2", "e3"), rotation.angles("t", moved), strict=True)))
        for r in out.collect():
            assert all(abs(r[p] - r[q]) < 1e-9 for p, q in zip("xyz", "abc", strict=True))
            assert all(abs(r[f"d{i}"] - r[f"e{i}"]) < 1e-6 for i in (1, 2, 3))
            assert math.isclose(r["x"] ** 2 + r["y"] ** 2 + r["z"] ** 2, r["u"] ** 2 + r["v"] ** 2 + r["w"] ** 2, abs_tol=1e-9)
    at = rows.where("t = 0").select(*rotation.angles("t", rotation.MODELS["IAU2000"])).first()
    assert [round(x, 6) for x in at] == [407.68143, 37.1135, 176.63]
    other = rows.where("t = 0").select(*rotation.angles("t", rotation.MODELS["Konopliv2016"])).first()
    assert all(abs(x - y) < 0.01 for x, y in zip(other, at, strict=True))  # the models agree at the epoch
    lib = rotation.librations(2.18e-4, 0.2056, (174.79, 4.09))
    assert len(lib.amplitude) == 5 and abs(lib.amplitude[0] - math.degrees(1.5 * 2.18e-4) * (1 - 11 * 0.2056**2 + 959 / 48 * 0.2056**4 - 3641 / 288 * 0.2056**6 + 11359 / 2880 * 0.2056**8 - 247799 / 345600 * 0.2056**10)) < 1e-12
    assert lib.phase[1] == pytest.approx(349.58) and lib.rate[4] == pytest.approx(20.45)


def test_product_tables(spark, tmp_path):
    from fathomline.operators.surface import TABLE
    from fathomline.sources import products

    (tmp_path / "x_TECU.txt").write_text("0.3 0.1\n0.5 0.2\n")
    assert [tuple(r) for r in products.electron_content(spark, str(tmp_path / "x_TECU.txt")).collect()] == [(0.3, 0.1), (0.5, 0.2)]
    alt = spark.createDataFrame([[float(i) for i in range(8)], [1.0, 2.0, 3.0, 4.0, 5.0, -1.0, 7.0, 8.0]], products.ALTIMETRY)
    products.stored(alt, str(tmp_path / "alt"), "csv")
    assert {(r["idx_fine"], r["flag"]) for r in products.altimetry(spark, str(tmp_path / "alt"), quality=True).collect()} == {(5.0, 0), (-1.0, 1)}
    srf = spark.createDataFrame([[float(i) for i in range(len(TABLE))]], TABLE)
    products.stored(surface.archived(srf.withColumn("more", srf["flag"])), str(tmp_path / "srf"), "csv")
    assert [tuple(r) for r in products.surface_echoes(spark, str(tmp_path / "srf")).collect()] == [tuple(float(i) for i in range(len(TABLE)))]
    with pytest.raises(ValueError, match="no such kind"):
        products.stored(srf, str(tmp_path / "z"), "hdf")
    with pytest.raises(Exception, match="already exists"):
        products.stored(srf, str(tmp_path / "srf"), "csv")


def test_auxiliary_files(spark, tmp_path):
    import numpy as np

    from fathomline.sources import products

    rows = np.zeros(3, products.AUXILIARY)
    rows["EPHEMERIS_TIME"], rows["GEOMETRY_EPOCH"], rows["SC_ROLL_ANGLE"], rows["CORRUPTED_DATA_FLAG1"] = [5, -6, 7], b"2006-12-06T02:22:01.945", [0.5, -1.5, 2.0], [0, 1, 255]
    (tmp_path / "e_1_a.dat").write_bytes(rows.tobytes())
    got = products.auxiliary(spark, str(tmp_path)).orderBy("record").collect()
    assert [(r["EPHEMERIS_TIME"], r["GEOMETRY_EPOCH"], r["SC_ROLL_ANGLE"], r["CORRUPTED_DATA_FLAG1"]) for r in got] == [(5, "2006-12-06T02:22:01.945", 0.5, 0), (-6, "2006-12-06T02:22:01.945", -1.5, 1), (7, "2006-12-06T02:22:01.945", 2.0, 255)]
    packed = spark.createDataFrame([(1, bytearray(rows.tobytes())), (2, None), (3, bytearray())], "id int, packed binary")
    assert [(r["id"], r["record"]) for r in products.decoded(packed, ["id"], "packed", products.AUXILIARY).orderBy("record").collect()] == [(1, 0), (1, 1), (1, 2)]
    with pytest.raises(Exception, match="no whole number"):
        products.decoded(spark.createDataFrame([(1, bytearray(b"abc"))], "id int, packed binary"), ["id"], "packed", products.AUXILIARY).collect()


def test_altimetry_finds_a_planted_echo(spark):
    """The whole chain over a flat ground: every pick near the echo, every radius the spacecraft's less the flight, corrupted traces -1."""
    import numpy as np

    from fathomline.functions.signal import LIGHT
    from fathomline.operators import altimetry

    r, n, at = np.random.default_rng(3), 400, 220
    shape = np.where(np.arange(n) >= at, 60 * np.exp(-(np.arange(n) - at) / 25.0), 0)
    rows = [("p", i, (shape + r.normal(0, 0.4, n)).tolist(), r.normal(0, 0.4, n).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "product string, trace int, re array<double>, im array<double>")
    geo = spark.createDataFrame([("p", i, float(i), 1.0, 2.0, 3700.0, 5000, 1, 0.0, i == 40) for i in range(90)], "product string, trace int, et double, latitude double, longitude double, radius_km double, window int, pri_code int, tecu double, corrupted boolean")
    got = altimetry.spots(df, geo, "product", "trace", "re", "im", 3, smooth=10, noise_scale=20.0, skip=20, reach=300, tail=100).orderBy("trace").collect()
    assert len(got) == 90 and got[40]["spot_radius"] == got[40]["idx_fine"] == -1
    phase = 5000 - int(2000 * 3700.0 / LIGHT / 0.0375e-6)
    for x in got[:40] + got[41:]:
        assert abs(x["idx_coarse"] - at) <= 14 and abs(x["idx_fine"] - at) <= 60 and x["snr"] > 0  # the echo is no echo of the model
        flight = (5000 + x["idx_fine"] - phase + phase) * 0.0375e-6 + 1428e-6 - 11.98e-6
        assert abs(x["spot_radius"] - (3700.0 - flight * LIGHT / 2000)) < 1e-6 and x["range"] == x["spot_radius"]


def test_filtered_ends(spark):
    from fathomline.operators import altimetry

    x = [float(i % 7) for i in range(60)]
    got = altimetry.filtered(spark.createDataFrame([(x,)], "a array<double>"), ["a"], 3).first()["a"]
    mean = [0.0] + [sum(x[i - 1 : i + 2]) / 3 for i in range(1, 59)] + [0.0]
    want = [m - sum(mean) / 60 for m in mean]
    want[:10], want[-10:] = want[20:30], want[-30:-20]
    assert got == pytest.approx(want)


def test_telemetry_chain(spark):
    from fathomline.plans import chains

    rows = [("p", i, [float(i + j) for j in range(64)], 80.0, 0, 3, float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "product string, trace int, samples array<double>, sza double, kind int, code int, km double")
    plain = chains.decompressed(df, "product", "trace", "samples", "kind", "code").orderBy("trace").collect()
    assert plain[2]["samples"][:3] == [2.0, 3.0, 4.0]  # four pulses: 2^2 / 4
    out = chains.compressed(df, "product", "trace", "samples", "sza", "kind", "code", rows=512)
    assert out.count() == 4 and chains.contents(out, "product").count() == 1
    with pytest.raises(Exception, match="dynamic scaling"):
        chains.decompressed(df.withColumn("kind", df["kind"] + 1), "product", "trace", "samples", "kind", "code").collect()
