"""What only larger or odd tables show."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from fathomline import queries, queries_echoes, queries_lines, queries_products  # noqa: F401
from fathomline.functions import geometry
from fathomline.operators import across, aggregates, interferometry, joins, kernels, optimisation, windows
from fathomline.plans import catalog, paths


def embeddings(spark, at, ids, label):
    rows = [(i, label, [float(x) for x in np.random.default_rng(i).normal(size=64)]) for i in ids]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{at}/embeddings.parquet")


def test_chunks_that_are_exactly_full(spark, tmp_path):
    rows = [(i, 1, 0.1 if i < 3001 else 100.0) for i in range(3004)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, value double")
    df.withColumn("ts", F.timestamp_seconds("event_id").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    got = queries.queries()["greedy_distance_chunks"](spark, str(tmp_path)).collect()
    assert sorted((r["chunk"], r["n"], r["first_row"], r["last_row"]) for r in got) == [(0, 3001, 0, 3000), (1, 3, 3001, 3003)]


def test_copies_are_found_whatever_the_energy_beside_them():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(3000, 64)) + 1j * rng.normal(size=(3000, 64))
    a = a + np.roll(a, 1, axis=1)
    plain, levelled = ([interferometry._offset(x, np.roll(x, -2), 10, 30, False, False, on)[0] for x in a] for on in (False, True))
    assert set(levelled) == {20.0} and set(plain) != {20.0}


def test_the_pole_itself(spark, tmp_path):
    embeddings(spark, tmp_path, range(727), 4)
    got = queries.queries()["places_across_track"](spark, str(tmp_path)).where("trace = 726 AND side = 0").collect()
    assert [(r["lat"], r["lon"]) for r in got] == [(90.0, 251.8)]


def test_pulses_narrower_than_a_part_of_the_bounds(spark):
    rng = np.random.default_rng(3)
    phases = [6.0 * (1 + k / 64) ** -1.93 for k in range(64)]
    planted, level = rng.uniform(0, 400, 60), np.abs(rng.normal(size=(60, 64)))
    z = level * np.exp(-1j * planted[:, None] * np.array(phases))
    df = spark.createDataFrame([(1, 0, i, z[i].real.tolist(), z[i].imag.tolist()) for i in range(60)], "p int, c int, i int, re array<double>, im array<double>")
    got = {r["i"]: r for r in optimisation.undispersed(df, "p", "c", "i", "re", "im", phases, 0.0, 400.0).collect()}
    for i in range(60):
        assert abs(got[i]["dispersion"] - planted[i]) < 1e-4 and math.isclose(got[i]["peak"], level[i].sum(), rel_tol=1e-6)


def test_full_cubes_are_cut(spark):
    r = np.random.default_rng(2)
    cells = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(r.uniform(0, 1, (3000, 3)))], "cell_ long, x double, y double, z double")
    placed, size = across._cubes(cells, 4.0)
    assert size < 4.0 and placed.groupBy("q0", "q1", "q2").count().agg(F.max("count")).first()[0] < 10 * across.FULL
    copies = cells.withColumns({c: F.lit(0.5) for c in "xyz"})
    assert across._cubes(copies, 4.0)[1] == 4.0


def test_windows_fitted_together():
    rng = np.random.default_rng(6)
    windows = 10 * np.log10(rng.normal(size=(40, 48)) ** 2 + 1e-4)
    together = kernels.retracked(windows, start=(24.0, 3.0, 0.05), floor=16)
    assert all((kernels.retracked(w, start=(24.0, 3.0, 0.05), floor=16) == p).all() for w, p in zip(windows, together, strict=True))


def test_geodesics_in_batches(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (10.0, 20.0, 10.0, 20.0), (None, 0.0, 1.0, 1.0)], "a double, b double, c double, d double")
    out = df.select(geometry.ellipsoidal_distance("a", "b", "c", "d", 1000.0, 1000.0).alias("m"))
    got = [r["m"] for r in out.collect()]
    assert math.isclose(got[0], 1000 * math.pi / 180, rel_tol=1e-9) and got[1:] == [0.0, None]
    assert "ArrowEvalPython" in out._jdf.queryExecution().toString()


def test_files_keep_columns_without_a_join(spark):
    index = spark.createDataFrame([("mrosh_0001", "data/edr00xxx/edr0000001/e_0000001_001_ss05_700_a.lbl", "e_0000001_001_ss05_700_a", 7)], "volume_id string, file_specification_name string, product_id string, o_orderkey long")
    out = paths.files(index, "/r", "/m", ("cmp",), keep=("o_orderkey",))
    assert {(r["name"], r["o_orderkey"]) for r in out.collect()} == {("cmp_rad", 7), ("cmp_tecu", 7)}


def nearest_of(spark, n, keys):
    r = np.random.default_rng(4)
    rows = [(int(k), float(x), int(i)) for k, x, i in zip(r.integers(0, keys, n), r.integers(0, 40, n) / 4, range(n), strict=True)]
    posts, asked = rows[::2], rows[1::2]
    made = lambda rows, at, i: spark.createDataFrame(rows, f"k long, {at} double, {i} long")
    out = joins.nearest(made(asked, "x", "n"), made(posts, "p", "cell"), "k", "x", "p", "cell")
    want = {n: min(((abs(p - x), c) for q, p, c in posts if q == k), default=(0, None))[1] for k, x, n in asked}
    return out, want


def test_short_keys_are_put_in_order_once(spark):
    out, want = nearest_of(spark, 400, 60)
    assert {r["n"]: r["cell"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Window ") == 1 and "SortMergeJoin" not in plan


def test_long_keys_that_are_counted_together(spark, monkeypatch):
    monkeypatch.setattr(windows, "CHUNK", 5)
    monkeypatch.setattr(windows, "KEYS", 3)
    out, want = nearest_of(spark, 400, 7)
    assert {r["n"]: r["cell"] for r in out.collect()} == want


def test_cubes_with_more_cells_than_a_mask(spark):
    """Cells overlap by 90 on one axis, and have gaps between them on the other; nulls in all columns."""
    r = np.random.default_rng(8)
    rows = [(float(x), float(y), int(v), str(s)) for x, y, v, s in zip(r.integers(-20, 900, 60) / 4, r.integers(-2, 12, 60) / 2, r.integers(0, 9, 60), r.integers(0, 5, 60), strict=True)]
    rows += [(None, 1.0, 1, "0"), (3.0, None, 1, "0"), (40.0, 1.0, None, None), (float("nan"), 1.0, 1, "0"), (500.0, 5.25, None, "9")]
    df = spark.createDataFrame(rows, "x double, y double, v int, s string")
    want = {}
    for x, y, v, s in rows:
        if x is not None and y is not None:
            for i in range(260):
                for j in range(4):
                    if 2.0 * i + 1 <= x < 2.0 * i + 181 and 1.5 * j <= y < 1.5 * j + 1:
                        want.setdefault((i, j), []).append((v, s))
    out = aggregates.overlapping_cube(df, {"x": (1.0, 2.0, 180.0), "y": (0.0, 1.5, 1.0)}, "v", "s")
    got = {(r["x_cell"], r["y_cell"]): r for r in out.collect()}
    assert got.keys() == want.keys() and max(i for i, _ in got) > 128
    for k, all_ in want.items():
        v = [v for v, _ in all_ if v is not None]
        assert (got[k]["n"], got[k]["least"], got[k]["most"], got[k]["sources"]) == (len(v), min(v, default=None), max(v, default=None), len({s for _, s in all_ if s}))
        assert got[k]["mean"] is None if not v else math.isclose(got[k]["mean"], sum(v) / len(v))
    assert "count(distinct" not in out._jdf.queryExecution().toString()
    alone = aggregates.overlapping_cube(df, {"y": (0.0, 1.5, 1.0)}, "v", "s").collect()
    assert all(r["sources"] == len({s for _, y, _, s in rows if y is not None and s and 1.5 * r["y_cell"] <= y < 1.5 * r["y_cell"] + 1}) for r in alone) and alone


def test_products_are_put_in_order_once_and_joined_with_nothing(spark):
    out = queries.queries()["processed_products"](spark, "/root/testdata/sf0.001")
    assert len(out.collect()) == 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "WindowGroupLimit" not in plan


def test_odd_paths(spark):
    odd = ["", "/", "a", "a/", "/a", "a/b", "a//b", "a/b/", "/a/b.c/d e", "\u00e9/\U0001f600/x", "a/b\n", None]
    df = spark.createDataFrame([(p,) for p in odd], "p string")
    got = df.select("p", paths.folder("p").alias("folder"), paths.joined("", F.col("p"), "z").alias("joined")).collect()
    assert all(r["folder"] == (None if r["p"] is None else re.sub(r"/?[^/]*\Z", "", r["p"], count=1)) for r in got)
    assert all(r["joined"] == (f"{r['p']}/z" if r["p"] else "z") for r in got)


def test_the_last_record_of_an_id(spark):
    rows = [(1, "A "), (3, "A"), (2, "a"), (None, "A"), (5, "B"), (None, "C")]
    df = spark.createDataFrame([(o, f"V{o}", f"F{o}", p) for o, p in rows], "o int, volume_id string, file_specification_name string, product_id string")
    assert {(r["product_id"], r["o"]) for r in catalog.index(df, "o").collect()} == {("a", 3), ("b", 5), ("c", None)}


def test_callers_columns_are_left_alone(spark, monkeypatch):
    """Names that the step uses itself, in either case, with keys of one part and of several."""
    names = ["bucket_", "from_", "To_", "parts_", "part_", "cut_", "x_", "x__", "carried_", "coming_"]
    df = spark.createDataFrame([("a", float(x), (float(x), x) if x % 3 == 0 else None, *range(x, x + len(names))) for x in range(12)], f"k string, at double, p struct<x:double,v:int>, {', '.join(f'`{n}` int' for n in names)}")
    for chunk in (4096, 4):
        monkeypatch.setattr(windows, "CHUNK", chunk)
        out = windows.neighbours(df, "k", "at", "p", "lo", "hi")
        assert out.columns == [*df.columns, "lo", "hi"]
        for r in out.collect():
            x = int(r["at"])
            assert [r[n] for n in names] == [*range(x, x + len(names))]
            assert (r["lo"]["v"], r["hi"] and r["hi"]["v"]) == (x // 3 * 3, -(-x // 3) * 3 if x < 10 else None)
