"""Files of fixed-width records, as rows.

Each file is one row of Spark's binaryFile source and so one task; its records leave it in batches. A file of more than 2 GB has to be split at a record before.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import from_arrow_schema

RECORDS = 4096


def _column(x: np.ndarray) -> pa.Array:
    """Values, or arrays of a record, in this machine's byte order; text without the blanks that fill it up; bytes (V) as they are."""
    if x.dtype.kind == "S":
        return pa.array([v.decode("latin-1").rstrip() for v in x.tolist()], pa.string())
    if x.dtype.kind == "V":
        return pa.array(x.tolist() if x.ndim == 1 else [bytes(v) for v in x], pa.binary())
    x = np.ascontiguousarray(x.astype(x.dtype.newbyteorder("=")))
    if x.dtype.kind == "u":  # no unsigned types in Spark
        x = x.astype(np.int64 if x.dtype.itemsize > 2 else np.int32)
    if x.ndim == 1:
        return pa.array(x)
    flat = pa.array(x.reshape(-1))
    width = x.size // len(x) if len(x) else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), flat)


def records(spark: SparkSession, path: str, layout: list[tuple], glob: str = "*", skip: int = 0) -> DataFrame:
    """Rows of the files under path: file, record (from 0) and the fields of layout, numpy's list of (name, type) or (name, type, shape).

    skip: bytes of a header. A last record that is not whole raises an error that names the file.
    """
    dtype = np.dtype(layout)
    fields = [(n, _column(np.zeros(1, dtype)[n]).type) for n in dtype.names]
    schema = from_arrow_schema(pa.schema([("file", pa.string()), ("record", pa.int64()), *fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                data = memoryview(content.as_buffer())[skip:]
                if len(data) % dtype.itemsize:
                    raise ValueError(f"{file}: {len(data)} bytes are no whole number of records of {dtype.itemsize}")
                rows = np.frombuffer(data, dtype)
                for lo in range(0, len(rows), RECORDS):
                    some = rows[lo : lo + RECORDS]
                    columns = [pa.array([file] * len(some), pa.string()), pa.array(np.arange(lo, lo + len(some))), *(_column(some[n]) for n in dtype.names)]
                    yield pa.record_batch(columns, ["file", "record", *dtype.names])

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def pulse_compressed(spark: SparkSession, path: str, samples: int = 7200, glob: str = "*") -> DataFrame:
    """Records of little-endian 32-bit floats."""
    return records(spark, path, [("samples", "<f4", (samples,))], glob)


def integer_traces(spark: SparkSession, path: str, samples: int = 3200, glob: str = "*", kind: str = "<i2") -> DataFrame:
    """Traces of integers, as the sounder's channels are stored; kind ">i4" for magnitudes and phases of processed lines."""
    return records(spark, path, [("samples", kind, (samples,))], glob)


def complex_traces(spark: SparkSession, path: str, samples: int = 3600, glob: str = "*", kind: str = "<i2") -> DataFrame:
    """Traces re, im from files whose records hold all real parts, then all imaginary parts."""
    return records(spark, path, [("re", kind, (samples,)), ("im", kind, (samples,))], glob)


#: Headers of sounder streams, by the version byte: samples, channels, radar version (2), channel offset, version, reserved; the later version adds place, spacing and the number of time stamps.
STREAMS = {
    0: np.dtype([("nsamp", ">u2"), ("nchan", "u1"), ("vr0", "u1"), ("vr1", "u1"), ("choff", "u1"), ("ver", "u1"), ("resvd2", "u1")]),
    5: np.dtype([("nsamp", ">u2"), ("nchan", "u1"), ("vr0", "u1"), ("vr1", "u1"), ("choff", "u1"), ("ver", "u1"), ("resvd2", "u1"), ("absix", ">f8"), ("relix", ">f8"), ("xinc", ">f4"), ("rseq", ">u4"), ("scount", ">u2"), ("tscount", ">u4")]),
}
STREAMS[255] = STREAMS[0]


def streams(spark: SparkSession, path: str, channels: tuple[int, ...] | None = None, glob: str = "*") -> DataFrame:
    """Rows of sounder streams, whose records vary in length: file, record, channel (from 1) and samples, for each of a record's two channels; only those of `channels`, if given.

    A last record that is cut off is left out, as happens when a recording stops. A file of an unknown version raises an error that names it.
    """
    schema = "file string, record long, channel int, samples array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                data = memoryview(content.as_buffer())
                if len(data) < STREAMS[0].itemsize:
                    continue
                if (kind := STREAMS.get(data[6])) is None:
                    raise ValueError(f"{file}: streams of version {data[6]} are unknown")
                rows, at, record = [], 0, 0
                while at + kind.itemsize <= len(data):
                    head = np.frombuffer(data, kind, 1, at)[0]
                    n, first = int(head["nsamp"]), 0 if head["choff"] == 0xFF else int(head["choff"]) & 15
                    at += kind.itemsize + (8 * int(head["tscount"]) if "tscount" in kind.names else 0)
                    if not n or at + 4 * n > len(data):
                        break
                    for k in (0, 1):
                        if channels is None or first + k + 1 in channels:
                            rows.append((file, record, first + k + 1, np.frombuffer(data, ">i2", n, at + 2 * n * k).astype(np.int32)))
                    at, record = at + 4 * n, record + 1
                    if len(rows) >= RECORDS:
                        yield _stream_batch(rows)
                        rows = []
                if rows:
                    yield _stream_batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def _stream_batch(rows: list[tuple]) -> pa.RecordBatch:
    file, record, channel, samples = zip(*rows, strict=True)
    return pa.record_batch([pa.array(file, pa.string()), pa.array(record, pa.int64()), pa.array(channel, pa.int32()), pa.array(samples, pa.list_(pa.int32()))], ["file", "record", "channel", "samples"])
