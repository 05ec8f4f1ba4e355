"""Large files of records, read by many tasks: each opens a file at an offset and reads its own bytes.

Files are reached through pyarrow's file systems (local or mounted folders, hdfs://, s3://, gs://); driver and executors need to see them under the same path.
"""

import fnmatch
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema

from .binary import RECORDS, STREAMS, _column, _stream_batch
from .labels import layout as label_layout

#: Bytes of a task's share of a file.
SPLIT = 64 << 20
#: Bytes of samples of a telemetry record, by the instrument's mode (of 8, 6 and 4 bits a sample, each third mode of 21).
SAMPLE_BYTES = {f"SS{n:0{width}d}": (3600, 2700, 1800)[(n - 1) % 3] for n in range(1, 22) for width in (1, 2)}


def opened(path: str):
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def size_of(path: str) -> int:
    system, place = fs.FileSystem.from_uri(path)
    return system.get_file_info(place).size


def listed(path: str, glob: str = "*") -> list[tuple[str, int]]:
    """Paths and sizes of the files under a folder, or of one file."""
    system, place = fs.FileSystem.from_uri(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(place, recursive=True))
    prefix = path[: len(path) - len(place)] if path.endswith(place) else ""
    return sorted((prefix + f.path, f.size) for f in found if f.is_file and fnmatch.fnmatch(f.base_name, glob))


@dataclass
class Share(InputPartition):
    file: str
    first: int
    count: int

    def __post_init__(self):
        super().__init__((self.file, self.first))


class Records(DataSource):
    """Format fixed_records; options path, layout (JSON), glob, skip, split, cut."""

    @classmethod
    def name(cls) -> str:
        return "fixed_records"

    def dtype(self) -> np.dtype:
        return np.dtype([(f[0], f[1], *(tuple(x) for x in f[2:])) for f in json.loads(self.options["layout"])])

    def schema(self):
        dtype = self.dtype()
        return from_arrow_schema(pa.schema([("file", pa.string()), ("record", pa.int64()), *((n, _column(np.zeros(1, dtype)[n]).type) for n in dtype.names)]))

    def reader(self, schema) -> "RecordReader":
        o = self.options
        return RecordReader(o["path"], o.get("glob", "*"), self.dtype(), int(o.get("skip", 0)), int(o.get("split", SPLIT)), o.get("cut", "error"))


class RecordReader(DataSourceReader):
    def __init__(self, path: str, glob: str, dtype: np.dtype, skip: int, split: int, cut: str):
        self.path, self.glob, self.dtype, self.skip, self.split, self.cut = path, glob, dtype, skip, split, cut
        self.low, self.high, self.file = 0, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of record and a file's name choose the bytes that are read; Spark still looks at the rows."""
        for f in filters:
            name, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if name == ("record",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, value + isinstance(f, GreaterThan))
            if name == ("record",) and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                most = value - isinstance(f, LessThan)
                self.high = most if self.high is None else min(self.high, most)
            if name == ("file",) and isinstance(f, EqualTo):
                self.file = value
            yield f

    def partitions(self) -> list[Share]:
        size, each = self.dtype.itemsize, max(1, self.split // self.dtype.itemsize)
        out = []
        for file, length in listed(self.path, self.glob):
            if self.file is not None and file != self.file:
                continue
            n, rest = divmod(max(length - self.skip, 0), size)
            if rest and self.cut == "error":
                raise ValueError(f"{file}: {length - self.skip} bytes are no whole number of records of {size}")
            stop = n if self.high is None else min(n, self.high + 1)
            out += [Share(file, at, min(each, stop - at)) for at in range(self.low, stop, each)]
        return out

    def read(self, share: Share | None) -> Iterator[pa.RecordBatch]:
        if share is not None:  # else there are no records
            yield from _records(share.file, self.skip + share.first * self.dtype.itemsize, share.first, share.count, self.dtype)


def _records(file: str, offset: int, first: int, count: int, dtype: np.dtype) -> Iterator[pa.RecordBatch]:
    with opened(file) as f:
        f.seek(offset)
        for lo in range(0, count, RECORDS):
            some = np.frombuffer(f.read(min(RECORDS, count - lo) * dtype.itemsize), dtype)
            columns = [pa.array([file] * len(some), pa.string()), pa.array(np.arange(first + lo, first + lo + len(some))), *(_column(some[n]) for n in dtype.names)]
            yield pa.record_batch(columns, ["file", "record", *dtype.names])


def records(spark: SparkSession, path: str, layout: list[tuple], glob: str = "*", skip: int = 0, split: int = SPLIT, cut: str = "error") -> DataFrame:
    """Rows of the files under path, as binary.records gives them, but a file is read by a task for each `split` bytes, and conditions on record or file leave bytes unread.

    cut: 'error' refuses a last record that is not whole, 'keep' leaves it out; cut_off() counts such bytes. Turns on spark.sql.python.filterPushdown.enabled.
    """
    if cut not in ("error", "keep"):
        raise ValueError(f"no such way to treat cut records: {cut}")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Records)
    return spark.read.format("fixed_records").options(path=path, layout=json.dumps(layout), glob=glob, skip=skip, split=split, cut=cut).load()


def cut_off(spark: SparkSession, path: str, layout: list[tuple], glob: str = "*", skip: int = 0) -> DataFrame:
    """file, records, left_bytes: how many records each file holds and how many bytes come after the last whole one. Sizes are looked at, not contents."""
    size = np.dtype(layout).itemsize
    rows = [(f, max(n - skip, 0) // size, max(n - skip, 0) % size) for f, n in listed(path, glob)]
    return spark.createDataFrame(rows, "file string, records long, left_bytes long")


def product_shares(products: DataFrame, format_label: str, split: int = SPLIT, strict: bool = True) -> DataFrame:
    """path, science, samples, first, count, left_bytes: shares of data files. products: path, science, label (its text), as from paths.labels_of with the labels' texts. A file that has another number of records than its label says is an error, or with strict=False is read as far as it goes, and left_bytes says what is left."""
    size = np.dtype(label_layout(format_label)).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, science, rows, mode in zip(*(batch[c].to_pylist() for c in ("path", "science", "rows", "mode")), strict=True):
                if science and mode not in SAMPLE_BYTES:
                    raise ValueError(f"{path}: no such mode: {mode}")
                samples = SAMPLE_BYTES[mode] if science else 0
                length = size_of(path)
                n, rest = divmod(length, size + samples)
                if strict and (rest or n != rows):
                    raise ValueError(f"{path}: {length} bytes, but {rows} records of {size + samples} in its label")
                each = max(1, split // (size + samples))
                out += [(path, science, samples, at, min(each, n - at), rest if at + each >= n else 0) for at in range(0, n, each)] or [(path, science, samples, 0, 0, rest)]
            columns = zip(*out, strict=True) if out else [[]] * 6
            kinds = [pa.string(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["path", "science", "samples", "first", "count", "left_bytes"])

    entry = lambda name, within="": F.regexp_extract("label", rf"(?s){within}\b{name}\s*=\s*\"?([A-Za-z0-9]+)", 1)
    read = products.select("path", "science", entry("ROWS", r"SCIENCE_TELEMETRY_TABLE.*?").try_cast("long").alias("rows"), entry("INSTRUMENT_MODE_ID").alias("mode"))
    return read.mapInArrow(run, "path string, science boolean, samples int, first long, count long, left_bytes long")


def product_records(products: DataFrame, format_label: str, split: int = SPLIT, strict: bool = True) -> DataFrame:
    """path, record, the fields of the format label, and sample_bytes (array of bytes, as many as the product's mode has; null for auxiliary data): label and data of many products in one reader, a task for some shares of files. See product_shares."""
    fields = label_layout(format_label)
    shares = product_shares(products, format_label, split, strict).where("count > 0")
    dtype = np.dtype(fields)
    schema = from_arrow_schema(pa.schema([("path", pa.string()), ("record", pa.int64()), *((n, _column(np.zeros(1, dtype)[n]).type) for n in dtype.names), ("sample_bytes", pa.list_(pa.int8()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, samples, first, count in zip(*(batch[c].to_pylist() for c in ("path", "samples", "first", "count")), strict=True):
                own = np.dtype(fields + ([("sample_bytes", "i1", (samples,))] if samples else []))
                for rows in _records(path, first * own.itemsize, first, count, own):
                    more = [] if samples else [pa.nulls(rows.num_rows, pa.list_(pa.int8()))]
                    yield pa.record_batch([*rows.columns, *more], ["path", "record", *dtype.names, "sample_bytes"])

    return shares.repartition("path", "first").select("path", "samples", "first", "count").mapInArrow(run, schema)


def _walked(file: str, split: int) -> Iterator[tuple[str, int, int, int, int]]:
    """Shares of a stream: file, offset, first record, records, and the bytes that are left at the end of the file. Headers say where the next one is; samples are skipped."""
    length = size_of(file)
    with opened(file) as f:
        head = f.read(STREAMS[0].itemsize)
        if len(head) < STREAMS[0].itemsize:
            yield file, 0, 0, 0, length
            return
        if (kind := STREAMS.get(head[6])) is None:
            raise ValueError(f"{file}: streams of version {head[6]} are unknown")
        at, begin, record, first = 0, 0, 0, 0
        window, base = b"", 0
        while at + kind.itemsize <= length:
            if not base <= at <= base + len(window) - kind.itemsize:
                f.seek(at)
                window, base = f.read(1 << 20), at
            h = np.frombuffer(window, kind, 1, at - base)[0]
            nxt = at + kind.itemsize + (8 * int(h["tscount"]) if "tscount" in kind.names else 0) + 4 * int(h["nsamp"])
            if not h["nsamp"] or nxt > length:
                break
            at, record = nxt, record + 1
            if at - begin >= split:
                yield file, begin, first, record - first, 0
                begin, first = at, record
        yield file, begin, first, record - first, length - at


def stream_shares(spark: SparkSession, path: str, glob: str = "*", split: int = SPLIT) -> DataFrame:
    """file, offset, first, count, left_bytes: where shares of `split` bytes of sounder streams begin, found by a task for each file that reads headers alone; left_bytes is what a last record that is cut off takes."""
    files = spark.createDataFrame([(f,) for f, _ in listed(path, glob)], "file string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch["file"].to_pylist():
                rows = list(zip(*_walked(file, split), strict=True))
                yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, [pa.string()] + [pa.int64()] * 4, strict=True)], ["file", "offset", "first", "count", "left_bytes"])

    return files.repartition(max(1, files.count())).mapInArrow(run, "file string, offset long, first long, count long, left_bytes long")


def streams(shares: DataFrame, channels: tuple[int, ...] | None = None) -> DataFrame:
    """file, record, channel, samples of the shares that stream_shares gave, as binary.streams gives them: each share is read by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, offset, first, count in zip(*(batch[c].to_pylist() for c in ("file", "offset", "first", "count")), strict=True):
                with opened(file) as f:
                    kind = STREAMS[f.read(STREAMS[0].itemsize)[6]]
                    f.seek(offset)
                    rows = []
                    for record in range(first, first + count):
                        head = np.frombuffer(f.read(kind.itemsize), kind)[0]
                        stamps, n = 8 * int(head["tscount"]) if "tscount" in kind.names else 0, int(head["nsamp"])
                        data = f.read(stamps + 4 * n)[stamps:]
                        low = 0 if head["choff"] == 0xFF else int(head["choff"]) & 15
                        rows += [(file, record, low + k + 1, np.frombuffer(data, ">i2", n, 2 * n * k).astype(np.int32)) for k in (0, 1) if channels is None or low + k + 1 in channels]
                        if len(rows) >= RECORDS:
                            yield _stream_batch(rows)
                            rows = []
                    if rows:
                        yield _stream_batch(rows)

    return shares.where("count > 0").repartition("file", "offset").select("file", "offset", "first", "count").mapInArrow(run, "file string, record long, channel int, samples array<int>")


def stored(files: DataFrame, folder: str) -> str:
    """Writes each row of files (name, content: binary) as a file of the folder, from the tasks that hold the rows; a task that runs again writes the same. Returns the folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = fs.FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        for batch in batches:
            for name, content in zip(batch["name"].to_pylist(), batch["content"], strict=True):
                with system.open_output_stream(f"{place}/{name}") as f:
                    f.write(content.as_buffer())
            yield pa.record_batch([batch["name"]], ["name"])

    files.select("name", "content").mapInArrow(run, "name string").count()
    return folder
