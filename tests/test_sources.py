"""Sources that share large files out to tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

from fathomline.sources import binary, rasters, splits

LAYOUT = [("no", ">u4"), ("v", "<f4", [3])]


def file_of(n, at):
    rows = np.zeros(n, np.dtype([("no", ">u4"), ("v", "<f4", (3,))]))
    rows["no"], rows["v"] = np.arange(n), np.arange(3 * n).reshape(n, 3)
    at.write_bytes(rows.tobytes())


def test_shares_give_what_whole_files_give(spark, tmp_path):
    file_of(1000, tmp_path / "a.dat")
    file_of(7, tmp_path / "b.dat")
    file_of(0, tmp_path / "c.dat")
    whole = sorted((r["file"].rsplit("/", 1)[1], r["record"], r["no"], tuple(r["v"])) for r in binary.records(spark, str(tmp_path), [("no", ">u4"), ("v", "<f4", (3,))], "*.dat").collect())
    for split in (1, 100, 1 << 20):
        df = splits.records(spark, str(tmp_path), LAYOUT, "*.dat", split=split)
        if split == 100:
            assert df.rdd.getNumPartitions() == 169  # six records each
        if split > 1:
            assert sorted((r["file"].rsplit("/", 1)[1], r["record"], r["no"], tuple(r["v"])) for r in df.collect()) == whole
    assert [r["no"] for r in splits.records(spark, str(tmp_path / "b.dat"), LAYOUT, split=32).where("record > 1 AND record <= 4").orderBy("record").collect()] == [2, 3, 4]


def test_large_sparse_file(spark, tmp_path):
    at = tmp_path / "large.dat"
    with at.open("wb") as f:
        f.truncate(3 * 2**30 + 5)
        f.seek(16 * 150_000_000)
        f.write(np.array([7], ">u4").tobytes() + np.ones(3, "<f4").tobytes())
    with pytest.raises(Exception, match="no whole number of records"):
        splits.records(spark, str(at), LAYOUT).count()
    df = splits.records(spark, str(at), LAYOUT, cut="keep")
    assert df.rdd.getNumPartitions() == 48
    few = df.where("record >= 149999999 AND record < 150000002").orderBy("record")
    assert [(r["record"], r["no"], r["v"]) for r in few.collect()] == [(149_999_999, 0, [0, 0, 0]), (150_000_000, 7, [1, 1, 1]), (150_000_001, 0, [0, 0, 0])]
    reader = splits.RecordReader(str(at), "*", np.dtype([("no", ">u4"), ("v", "<f4", (3,))]), 0, splits.SPLIT, "keep")
    list(reader.pushFilters([GreaterThanOrEqual(("record",), 149_999_999), LessThan(("record",), 150_000_002)]))
    assert [(s.first, s.count) for s in reader.partitions()] == [(149_999_999, 3)]  # 48 bytes
    assert [tuple(r) for r in splits.cut_off(spark, str(at), LAYOUT).select("records", "left_bytes").collect()] == [(3 * 2**26, 5)]
    with pytest.raises(ValueError, match="cut records"):
        splits.records(spark, str(at), LAYOUT, cut="maybe")


@pytest.mark.parametrize("split", [1, 60, 1 << 20])
def test_streams_by_shares(spark, tmp_path, split):
    r = np.random.default_rng(1)
    for name, version in (("old.str", 0), ("new.str", 5)):
        kind, data = binary.STREAMS[version], b""
        for i in range(40):
            head = np.zeros(1, kind)
            head["nsamp"], head["ver"], head["choff"] = 5 + i % 7, version, 2 if i % 2 else 0xFF
            if version:
                head["tscount"] = i % 3
            data += head.tobytes() + bytes(8 * (i % 3) if version else 0) + r.integers(-9, 9, 2 * (5 + i % 7)).astype(">i2").tobytes()
        (tmp_path / name).write_bytes(data[:-3])
    (tmp_path / "short.str").write_bytes(b"\0\0\0")
    whole = sorted((x["file"].rsplit("/", 1)[1], *x[1:3], tuple(x["samples"])) for x in binary.streams(spark, str(tmp_path), glob="*.str").collect())
    shares = splits.stream_shares(spark, str(tmp_path), "*.str", split)
    assert sorted((x["file"].rsplit("/", 1)[1], *x[1:3], tuple(x["samples"])) for x in splits.streams(shares).collect()) == whole
    one = splits.streams(shares, channels=(2,))
    assert {x["channel"] for x in one.collect()} == {2}
    left = {x["file"].rsplit("/", 1)[1]: x["left"] for x in shares.groupBy("file").agg(F.sum("left_bytes").alias("left")).collect()}
    assert left["short.str"] == 3 and left["old.str"] == 8 + 4 * (5 + 39 % 7) - 3
    (tmp_path / "odd.xyz").write_bytes(bytes([0] * 6 + [77, 0]) * 4)
    with pytest.raises(Exception, match="version 77"):
        splits.stream_shares(spark, str(tmp_path), "*.xyz").count()


FORMAT = """OBJECT = COLUMN
 NAME = "COUNTER"
 DATA_TYPE = MSB_UNSIGNED_INTEGER
 BYTES = 4
END_OBJECT = COLUMN
OBJECT = COLUMN
 NAME = "KIND"
 DATA_TYPE = CHARACTER
 BYTES = 2
END_OBJECT = COLUMN
"""


def test_labels_and_data_together(spark, tmp_path):
    label = lambda rows, mode: f'FILE_RECORDS = 3\nINSTRUMENT_MODE_ID = "{mode}"\nOBJECT = SCIENCE_TELEMETRY_TABLE\n  ROWS = {rows}\nEND_OBJECT\n'
    size = {"p": 1800, "q": 3600, "r": 0}
    for name, rows in (("p", 5), ("q", 3), ("r", 4)):
        data = np.zeros(rows, np.dtype([("c", ">u4"), ("k", "S2"), ("s", "i1", (size[name],))]))
        data["c"], data["k"], data["s"] = np.arange(rows), name.encode(), -3
        (tmp_path / name).write_bytes(data.tobytes())
    products = spark.createDataFrame([(str(tmp_path / "p"), True, label(5, "SS21")), (str(tmp_path / "q"), True, label(3, "SS01")), (str(tmp_path / "r"), False, label(4, "SS01"))], "path string, science boolean, label string")
    rows = splits.product_records(products, FORMAT, split=4000).orderBy("path", "record").collect()
    assert [(r["path"][-1], r["record"], r["COUNTER"], r["KIND"], r["sample_bytes"] and (len(r["sample_bytes"]), r["sample_bytes"][0])) for r in rows] == [(n, i, i, n, (size[n], -3) if size[n] else None) for n, k in (("p", 5), ("q", 3), ("r", 4)) for i in range(k)]
    shares = splits.product_shares(products, FORMAT, split=4000)
    assert shares.where("path LIKE '%p'").count() == 3
    cut = products.limit(1).withColumn("label", F.lit(label(6, "SS21")))
    with pytest.raises(Exception, match="records of 1806 in its label"):
        splits.product_records(cut, FORMAT).count()
    assert splits.product_records(cut, FORMAT, strict=False).count() == 5
    with pytest.raises(Exception, match="no such mode"):
        splits.product_records(products.limit(1).withColumn("label", F.lit(label(5, "XX1"))), FORMAT).count()
    assert splits.SAMPLE_BYTES["SS1"] == splits.SAMPLE_BYTES["SS04"] == 3600 and splits.SAMPLE_BYTES["SS20"] == 2700 and splits.SAMPLE_BYTES["SS9"] == 1800


def tile(folder, name, data, north, west, cell, kind=">i2", more=""):
    (folder / f"{name}.img").write_bytes(data.astype(kind).tobytes())
    lines, samples = data.shape
    (folder / f"{name}.lbl").write_text(f"LINES = {lines}\nLINE_SAMPLES = {samples}\nMAXIMUM_LATITUDE = {north} <DEG>\nMINIMUM_LATITUDE = {north - lines * cell} <DEG>\nWESTERNMOST_LONGITUDE = {west} <DEG>\nEASTERNMOST_LONGITUDE = {west + samples * cell} <DEG>\n{more}")


def test_only_bytes_in_the_box_are_read(spark, tmp_path, monkeypatch):
    r = np.random.default_rng(2)
    one, two = r.integers(-8000, 20000, (40, 64)), r.integers(-8000, 20000, (40, 64))
    tile(tmp_path, "n", one, 10.0, 0.0, 0.25)
    tile(tmp_path, "s", two, 0.0, 0.0, 0.25, "<f4", "SAMPLE_TYPE = PC_REAL\nSAMPLE_BITS = 32\nOFFSET = 100\nSCALING_FACTOR = 2\n")
    every = {(t["tile"][-5], t["line"], t["sample"]): (t["latitude"], t["longitude"], t["height"]) for t in rasters.cells(spark, str(tmp_path)).collect()}
    want = {("n", i, j): (10 - (i + 0.5) / 4, (j + 0.5) / 4, float(one[i, j])) for i in range(40) for j in range(64)} | {("s", i, j): (-(i + 0.5) / 4, (j + 0.5) / 4, float(two[i, j]) * 2 + 100) for i in range(40) for j in range(64)}
    assert every == want
    box = (2.125, 3.5, 4.0, 7.125)
    inside = {k: v for k, v in want.items() if box[0] <= v[0] <= box[1] and box[2] <= v[1] <= box[3]}
    got = {(t["tile"][-5], t["line"], t["sample"]): (t["latitude"], t["longitude"], t["height"]) for t in rasters.cells(spark, str(tmp_path), box=box).collect()}
    assert got == inside
    pushed = rasters.cells(spark, str(tmp_path)).where("latitude >= 2.125 AND latitude <= 3.5 AND longitude >= 4.0 AND longitude < 7.2")
    assert pushed.count() == len(inside) and pushed.rdd.getNumPartitions() == 1
    reader = rasters.RasterReader(str(tmp_path), "*.img", {"latitude": box[:2], "longitude": box[2:]}, 30)
    windows = reader.partitions()
    assert sum(w.bytes() for w in windows) == 2 * len(inside) and len(windows) == 3 and {w.file[-5] for w in windows} == {"n"}
    read = []

    class Counted:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            read.append(n)
            return self.f.read(n)

    monkeypatch.setattr(rasters, "opened", lambda path, plain=rasters.opened: Counted(plain(path)))
    cells = [b for w in windows for b in reader.read(w)]
    assert sum(read) == 2 * len(inside) == 2 * sum(b.num_rows for b in cells)
    assert rasters.cells(spark, str(tmp_path), box=(60, 70, 0, 1)).count() == 0
    file_of(0, tmp_path / "c.dat")
    assert splits.records(spark, str(tmp_path), LAYOUT, "*.dat").count() == 0


def test_labels_and_files_that_do_not_fit(spark, tmp_path):
    tile(tmp_path, "a", np.zeros((4, 4)), 1.0, 0.0, 0.25)
    (tmp_path / "a.img").write_bytes(b"\0" * 20)
    with pytest.raises(Exception, match="too few"):
        rasters.cells(spark, str(tmp_path)).count()
    (tmp_path / "a.lbl").write_text("LINES = 4\n")
    with pytest.raises(Exception, match="LINE_SAMPLES"):
        rasters.cells(spark, str(tmp_path)).count()
