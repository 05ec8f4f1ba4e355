"""Sounder channels as a stream: records are combined into output channels, stacked coherently, compressed, and their magnitudes stacked, as they arrive."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.kernels import dechirped
from ..sources.binary import STREAMS


def arriving(spark: SparkSession, path: str, glob: str = "*", files: int = 16) -> DataFrame:
    """file, time (when it was last changed), record, channel, samples of sounder streams, as files appear under path; `files` of them at most in a batch. A file is whole when it appears; a last record that is cut off is left out."""
    schema = spark.read.format("binaryFile").load(path).schema
    content = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files).load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, time, data in zip(batch["path"].to_pylist(), batch["modificationTime"], batch["content"], strict=True):
                data = memoryview(data.as_buffer())
                if len(data) < STREAMS[0].itemsize:
                    continue
                if (kind := STREAMS.get(data[6])) is None:
                    raise ValueError(f"{file}: streams of version {data[6]} are unknown")
                at, rows = 0, []
                while at + kind.itemsize <= len(data):
                    head = np.frombuffer(data, kind, 1, at)[0]
                    at += kind.itemsize + (8 * int(head["tscount"]) if "tscount" in kind.names else 0)
                    n, low = int(head["nsamp"]), 0 if head["choff"] == 0xFF else int(head["choff"]) & 15
                    if not n or at + 4 * n > len(data):
                        break
                    rows += [(len(rows) // 2, low + k + 1, np.frombuffer(data, ">i2", n, at + 2 * n * k).astype(float)) for k in (0, 1)]
                    at += 4 * n
                if rows:
                    record, channel, samples = zip(*rows, strict=True)
                    columns = [pa.array([file] * len(rows)), pa.array([time.as_py()] * len(rows), pa.timestamp("us", "UTC")), pa.array(record, pa.int64()), pa.array(channel, pa.int32()), pa.array(list(samples), pa.list_(pa.float64()))]
                    yield pa.record_batch(columns, ["file", "time", "record", "channel", "samples"])

    return content.select("path", "modificationTime", "content").mapInArrow(run, "file string, time timestamp, record long, channel int, samples array<double>")


def combined(stream: DataFrame, specs: list[tuple], channel: str, samples: str) -> DataFrame:
    """stream with chanout and parts: a row for each output channel that a trace goes into, its samples scaled; parts is how many input channels that output has. specs: of signal.channel_specs."""
    ways: dict[int, list[tuple[int, float, int]]] = {}
    for chanout, *inputs in specs:
        taken = [t for t in (inputs[:2], inputs[2:]) if t[0]]
        for number, scale in taken:
            ways.setdefault(number, []).append((chanout, float(scale), len(taken)))
    goes = F.lit(None).cast("array<struct<chanout:int,scale:double,parts:int>>")
    for number, to in ways.items():
        made = F.array(*(F.struct(F.lit(c).alias("chanout"), F.lit(s).alias("scale"), F.lit(n).alias("parts")) for c, s, n in to))
        goes = F.when(F.col(channel) == number, made).otherwise(goes)
    rows = stream.withColumn("way_", F.explode(goes))
    return rows.withColumns({samples: F.transform(samples, lambda x: x.cast("double") * F.col("way_.scale")), "chanout": F.col("way_.chanout"), "parts": F.col("way_.parts")}).drop("way_")


def looks(stream: DataFrame, key: str, order: str, channel: str, samples: str, specs: list[tuple], depth: int, looks_: int, reference: np.ndarray | None = None, time: str | None = None, late: str = "1 hour") -> DataFrame:
    """key, chanout, block, magnitude: the mean magnitude of `looks_` coherent stacks of `depth` records each, once all their records are there, in whatever order they come. reference: a spectrum with which stacks are compressed first.

    A block's state is a sum for each stack; it is dropped when the block is emitted. With `time`, an event time, a block is given up and its state dropped when the watermark, `late` behind the newest trace of all, has passed its own newest; without it, it waits. Each trace must come once. Traces without key, order, channel or samples take no part. Shorter traces of a block end with zeros.
    """
    rows = combined(stream, specs, channel, samples)
    columns = [F.col(key).cast("string").alias("key"), "chanout", F.floor(F.col(order) / (depth * looks_)).alias("block"), F.floor(F.pmod(F.col(order), F.lit(depth * looks_)) / depth).cast("int").alias("stack"), "parts", F.col(samples).cast("array<double>").alias("samples")]
    rows = rows.select(*columns, *([F.col(time).alias("time")] if time else [])).dropna(subset=["key", "block", "samples"])
    rows = rows.withWatermark("time", late) if time else rows

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, width, latest, data = state.get if state.exists else (0, 0, 0, b"")
        total, parts = np.frombuffer(data).reshape(looks_, width).copy() if n else np.zeros((looks_, 0)), 1
        for frame in frames:
            if time:
                latest = max(latest, int(frame["time"].max().timestamp() * 1000))
            for stack, parts, x in zip(frame["stack"], frame["parts"], frame["samples"], strict=True):  # noqa: B007
                if len(x) > total.shape[1]:
                    total = np.pad(total, ((0, 0), (0, len(x) - total.shape[1])))
                total[stack, : len(x)] += x
                n += 1
        if n < depth * looks_ * parts:
            state.update((n, total.shape[1], latest, total.tobytes()))
            if time:
                state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), latest) + 1)
            return
        if state.exists:
            state.remove()
        made = np.abs(total if reference is None else dechirped(total, reference)).mean(0)
        yield pd.DataFrame({"key": [group[0]], "chanout": [group[1]], "block": [group[2]], "magnitude": [made.tolist()]})

    timeout = GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.NoTimeout
    out = rows.groupBy("key", "chanout", "block").applyInPandasWithState(run, "key string, chanout int, block long, magnitude array<double>", "n long, width long, latest long, total binary", "append", timeout)
    return out.withColumnRenamed("key", key)
