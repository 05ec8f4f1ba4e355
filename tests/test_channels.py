"""The sounder's chain as a stream, stopped midway and taken up again."""

import numpy as np
from pyspark.sql import functions as F

from fathomline.functions import signal
from fathomline.operators.kernels import dechirped
from fathomline.sources import binary
from fathomline.streaming import channels

SPECS = signal.channel_specs("[1,1,1,0,0; 2,1,0.5,2,-1]")


def written(at, records):
    data = b""
    for one, two in records:
        head = np.zeros(1, binary.STREAMS[0])
        head["nsamp"], head["choff"] = len(one), 0xFF
        data += head.tobytes() + one.astype(">i2").tobytes() + two.astype(">i2").tobytes()
    at.write_bytes(data + b"\0\0")


def test_stopped_and_taken_up_again(spark, tmp_path):
    r = np.random.default_rng(6)
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    source.mkdir()
    data = {name: [(r.integers(-99, 99, 40), r.integers(-99, 99, 40)) for _ in range(n)] for name, n in (("a", 25), ("b", 12), ("c", 7))}
    reference = np.exp(1j * r.uniform(0, 6, 40))

    def run():
        stream = channels.arriving(spark, str(source), "*.str", files=1)
        looks = channels.looks(stream, "file", "record", "channel", "samples", SPECS, 2, 3, reference)
        looks.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(state)).trigger(availableNow=True).start().awaitTermination()

    written(source / "a.str", data["a"])
    run()
    written(source / "b.str", data["b"])
    written(source / "c.str", data["c"])
    run()
    got = {(x["file"].rsplit("/", 1)[1][0], x["chanout"], x["block"]): x["magnitude"] for x in spark.read.schema("file string, chanout int, block long, magnitude array<double>").parquet(str(out)).collect()}
    want = {}
    for name, records in data.items():
        for chanout, mix in ((1, lambda one, two: one * 1.0), (2, lambda one, two: 0.5 * one - two)):
            traces = np.array([mix(*x) for x in records])
            for block in range(len(traces) // 6):
                stacks = traces[6 * block : 6 * block + 6].reshape(3, 2, -1).sum(1)
                want[name, chanout, block] = np.abs(dechirped(stacks, reference)).mean(0)
    assert set(got) == set(want) and all(np.allclose(got[k], v) for k, v in want.items())


def test_late_blocks_are_given_up(spark, tmp_path):
    """A block that stays incomplete leaves no state once the watermark has passed it."""
    source, state = tmp_path / "in", tmp_path / "state"
    kind = "k string, o long, c int, s array<double>, t timestamp"
    row = lambda o, t: ("x", o, 1, [1.0, 2.0], t)
    at = lambda minute: f"2026-01-01 00:{minute:02d}:00"

    def run(rows):
        spark.createDataFrame(rows, kind.replace("timestamp", "string")).withColumn("t", F.col("t").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(kind).parquet(str(source))
        looks = channels.looks(stream, "k", "o", "c", "s", SPECS[:1], 1, 2, time="t", late="5 minutes")
        q = looks.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(state)).trigger(availableNow=True).start()
        q.awaitTermination()
        return sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"])

    assert run([row(0, at(0)), row(2, at(0)), row(3, at(1))]) == 1  # block 0 waits, block 1 is whole
    run([row(20, at(40)), row(21, at(40))])
    assert run([row(30, at(41)), row(31, at(41))]) == 0
    assert {x["block"] for x in spark.read.parquet(str(tmp_path / "out")).collect()} == {1, 10, 15}
