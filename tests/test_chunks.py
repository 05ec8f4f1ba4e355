"""Operators give the same rows however a product is cut into chunks."""

import math

import pytest
from pyspark.sql import functions as F

from fathomline import queries, queries_echoes  # noqa: F401
from fathomline.operators import windows

SF = "/root/testdata/sf0.001"
NAMES = ["radargram_snr", "running_mean_zero_edges", "along_track_prefix_sum", "sample_hold_islands", "interpolated_track", "nearest_cells", "surface_normalised_phase", "clutter_residuals"]


@pytest.mark.parametrize("name", NAMES)
def test_small_chunks(spark, monkeypatch, name):
    def rows():
        return sorted(tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in queries.queries()[name](spark, SF).collect())

    whole = rows()
    monkeypatch.setattr(windows, "CHUNK", 7)
    monkeypatch.setattr(windows, "TRACES", 5)
    assert rows() == whole and whole


def test_neighbours_of_odd_places(spark, monkeypatch):
    """Nulls, ties, one row, and most rows in one place."""
    monkeypatch.setattr(windows, "CHUNK", 3)
    rows = [("a", float(x), None) for x in (0, 1, 2, 2, 2, 2, 2, 5, 9)] + [("a", 2.0, (2.0, 7)), ("a", 6.0, (6.0, 8)), ("b", 1.0, None), ("c", 4.0, (4.0, 1))]
    df = spark.createDataFrame(rows, "k string, x double, p struct<x:double,v:int>")
    got = {(r["k"], r["x"], r["lo"] and r["lo"]["v"], r["hi"] and r["hi"]["v"]) for r in windows.neighbours(df, "k", "x", "p", "lo", "hi").collect()}
    assert got == {("a", 0.0, None, 7), ("a", 1.0, None, 7), ("a", 2.0, 7, 7), ("a", 5.0, 7, 8), ("a", 6.0, 8, 8), ("a", 9.0, 8, None), ("b", 1.0, None, None), ("c", 4.0, 1, 1)}


def test_distance_chunks_against_a_loop(spark):
    steps = [1.0, 0.0, 12.0, 31.0, 2.0, 29.0, 29.5, 64.0, 1.0, 14.0, 3.0]
    at, rows = 0.0, []
    for i, s in enumerate(steps):
        at += s
        rows.append(("a", i, at))
    rows += [("b", 0, 5.0)]
    start, chunk, want = rows[0][2], 0, []
    for _, _, d in rows[:-1]:
        if d > start + 30:
            start, chunk = d, chunk + 1
        want.append(chunk)
    if rows[-2][2] - start < 15:
        want = [min(c, chunk - 1) for c in want]
    df = spark.createDataFrame(rows, "k string, i int, d double")
    got = windows.distance_chunks(df, "k", "i", "d", 30.0).orderBy("k", "i").collect()
    assert [r["chunk"] for r in got] == [*want, 0]
    with pytest.raises(Exception, match="goes backwards"):
        windows.distance_chunks(spark.createDataFrame([("a", 0, 5.0), ("a", 1, 4.0)], "k string, i int, d double"), "k", "i", "d").collect()


def test_unions_of_sides_dealt_alike(spark):
    """Groups over a union whose sides are dealt by the same key."""
    side = spark.range(400).select((F.col("id") % 37).alias("k"), "id").groupBy("k").agg(F.sum("id").alias("s"))
    got = windows.united(side, side, "k").groupBy("k").agg(F.sum("s").alias("s"), F.count("*").alias("n")).collect()
    assert len(got) == 37 and all(r["n"] == 2 for r in got) and math.isclose(sum(r["s"] for r in got), 2 * 399 * 400 / 2)
