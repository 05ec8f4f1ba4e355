"""Places across the track and nearest cells, against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.operators import across


def test_frames_and_places(spark):
    lat, lon = np.array([89.0, 89.9, 88.5, 87.0, 87.0]), np.array([10.0, 80.0, 190.0, 191.0, 191.0])
    track = spark.createDataFrame([("t", i, float(a), float(o)) for i, (a, o) in enumerate(zip(lat, lon, strict=True))] + [("one", 0, 5.0, 5.0)], "k string, i int, lat double, lon double")
    rows = {(r["k"], r["i"]): r for r in across.frames(track, "k", "i", "lat", "lon").collect()}
    a, o = np.radians(lat), np.radians(lon)
    up = np.stack([np.cos(a) * np.cos(o), np.cos(a) * np.sin(o), np.sin(a)], 1)
    for i in range(4):
        step = up[min(i + 1, 4)] - up[max(i - 1, 0)]
        step = step - (step @ up[i]) * up[i]
        step /= np.linalg.norm(step)
        assert np.allclose(rows["t", i]["along"], step) and np.allclose(rows["t", i]["across"], np.cross(up[i], step))
    assert rows["one", 0]["along"] is None and rows["one", 0]["across"] is None  # nowhere to go
    out = across.places(across.frames(track, "k", "i", "lat", "lon"), 3000.0, 2, 1e6).collect()
    assert len(out) == 4 * 5  # the last trace stands where the one before it does
    for r in out:
        d = across.distance
        p = np.cos(r["offset"] * 0.003) * np.array(r["up"]) + np.sin(r["offset"] * 0.003) * np.array(r["across"])
        q = np.radians([r["side_lat"], r["side_lon"]])
        assert np.allclose([np.cos(q[0]) * np.cos(q[1]), np.cos(q[0]) * np.sin(q[1]), np.sin(q[0])], p, atol=1e-9) and 0 <= r["side_lon"] < 360
    away = spark.range(1).select(d(F.lit(5.0), F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(0.0), F.lit(90.0)), d(F.lit(2.0), F.lit(40.0), F.lit(7.0), F.lit(2.0), F.lit(40.0), F.lit(7.0))).first()
    assert away[0] == pytest.approx(34**0.5) and away[1] < 1e-6


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_cells(spark, k):
    """Dense and empty parts, ties, points far outside, fewer rows than asked for, nulls."""
    r = np.random.default_rng(4)
    grid = np.vstack((r.uniform(0, 1, (300, 3)), r.uniform(40, 41, (5, 3)), [[7.0, 7.0, 7.0]] * 4))
    points = np.vstack((r.uniform(0, 1, (60, 3)), r.uniform(-90, 90, (15, 3)), [[7.0, 7.0, 7.5]]))
    g = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(grid)] + [(999, None, 0.0, 0.0)], "c long, x double, y double, z double").repartition(3)
    p = spark.createDataFrame([("p", i, *map(float, x)) for i, x in enumerate(points)] + [("p", 999, 0.0, None, 0.0)], "a string, b int, x double, y double, z double").repartition(2)
    got = across.nearest_cells(p, g, ["a", "b"], "c", ("x", "y", "z"), k, 4.0)
    found = {(r["b"], r["rank"]): (r["c"], round(r["distance"], 9)) for r in got.collect()}
    want = {}
    for i, x in enumerate(points):
        d = np.sqrt(((grid - x) ** 2).sum(1))
        for n, j in enumerate(sorted(range(len(grid)), key=lambda j: (d[j], j))[:k]):
            want[i, n + 1] = (j, round(float(d[j]), 9))
    assert found == want
    few = across.nearest_cells(p, g.limit(0).unionByName(g.where("c = 5 OR c = 6")), ["a", "b"], "c", ("x", "y", "z"), 3, 4.0)
    assert few.count() == 2 * len(points)
    assert across.nearest_cells(p, g.limit(0), ["a", "b"], "c", ("x", "y", "z"), k, 40.0).count() == 0
    assert across.nearest_cells(p.limit(0), g, ["a", "b"], "c", ("x", "y", "z"), k, 40.0).count() == 0
    assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()


def test_sides_of_echoes(spark):
    cells = spark.createDataFrame([(1, o, abs(o - 0.2) * 10) for o in range(-3, 4)], "i int, offset int, away double")
    echoes = spark.createDataFrame([(1, 2.4), (1, 12.0), (1, 30.9)], "i int, echo double")
    assert {(r["echo"], r["offset"], r["side"]) for r in across.side_echoes(cells, echoes, ["i"], "away", "echo").collect()} == {(2.4, 0, 0), (12.0, -1, -1), (30.9, -3, -1)}
