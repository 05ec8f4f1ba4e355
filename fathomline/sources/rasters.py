"""Elevation rasters with labels: tiles of whole numbers, row by row from the north, read as cells.

Each tile is a partition or several bands of rows; of a tile that a box of latitudes and longitudes meets, only the bytes of cells inside are read, and other tiles aren't opened but for their labels.
"""

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from .splits import listed, opened

#: Cells of a partition.
BAND = 1 << 22
#: Numpy kinds of the labels' sample types.
SAMPLES = {"MSB_INTEGER": ">i", "LSB_INTEGER": "<i", "MSB_UNSIGNED_INTEGER": ">u", "LSB_UNSIGNED_INTEGER": "<u", "UNSIGNED_INTEGER": ">u", "IEEE_REAL": ">f", "PC_REAL": "<f"}


@dataclass
class Tile:
    """A raster's place and form: cells are equal parts of the box from north to south and from west to east."""

    lines: int
    samples: int
    kind: np.dtype
    north: float
    south: float
    west: float
    east: float
    scale: float = 1.0
    offset: float = 0.0

    @classmethod
    def of(cls, label: str) -> "Tile":
        entry = dict(re.findall(r"^\s*([A-Z_]+)\s*=\s*\"?([^\s\"<]+)", label, re.M))
        missing = {"LINES", "LINE_SAMPLES", "MAXIMUM_LATITUDE", "MINIMUM_LATITUDE", "WESTERNMOST_LONGITUDE", "EASTERNMOST_LONGITUDE"} - set(entry)
        if missing:
            raise ValueError(f"a raster's label has no {', '.join(sorted(missing))}")
        kind = np.dtype(f"{SAMPLES[entry.get('SAMPLE_TYPE', 'MSB_INTEGER')]}{int(entry.get('SAMPLE_BITS', 16)) // 8}")
        box = (float(entry[k]) for k in ("MAXIMUM_LATITUDE", "MINIMUM_LATITUDE", "WESTERNMOST_LONGITUDE", "EASTERNMOST_LONGITUDE"))
        return cls(int(entry["LINES"]), int(entry["LINE_SAMPLES"]), kind, *box, float(entry.get("SCALING_FACTOR", 1)), float(entry.get("OFFSET", 0)))

    def latitude(self, line):
        return self.north - (line + 0.5) * (self.north - self.south) / self.lines

    def longitude(self, sample):
        return self.west + (sample + 0.5) * (self.east - self.west) / self.samples

    def inside(self, box: dict[str, tuple[float, float]]) -> tuple[int, int, int, int]:
        """First line, line behind the last, and likewise samples, of the cells whose middles lie in the box, edges included."""
        (south, north), (west, east) = box["latitude"], box["longitude"]
        up, across = self.lines / (self.north - self.south), self.samples / (self.east - self.west)
        within = lambda low, high, n: (max(0, math.ceil(low - 1e-9)) if low > 0 else 0, min(n, math.floor(high + 1e-9) + 1) if high < n else n)
        lines = within((self.north - north) * up - 0.5, (self.north - south) * up - 0.5, self.lines)
        return *lines, *within((west - self.west) * across - 0.5, (east - self.west) * across - 0.5, self.samples)


@dataclass
class Window(InputPartition):
    """Lines and samples of a tile that one task reads."""

    file: str
    tile: Tile
    lines: tuple[int, int]
    samples: tuple[int, int]

    def __post_init__(self):
        super().__init__((self.file, self.lines))

    def bytes(self) -> int:
        return (self.lines[1] - self.lines[0]) * (self.samples[1] - self.samples[0]) * self.tile.kind.itemsize


class Raster(DataSource):
    """Format labelled_raster; options path, glob, south, north, west, east."""

    @classmethod
    def name(cls) -> str:
        return "labelled_raster"

    def schema(self) -> str:
        return "tile string, line int, sample int, latitude double, longitude double, height double"

    def reader(self, schema) -> "RasterReader":
        o = self.options
        box = {"latitude": (float(o.get("south", "-inf")), float(o.get("north", "inf"))), "longitude": (float(o.get("west", "-inf")), float(o.get("east", "inf")))}
        return RasterReader(o["path"], o.get("glob", "*.img"), box, int(o.get("band", BAND)))


class RasterReader(DataSourceReader):
    def __init__(self, path: str, glob: str, box: dict[str, tuple[float, float]], band: int):
        self.path, self.glob, self.box, self.band = path, glob, box, band

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of latitude and longitude narrow the box; Spark still looks at the rows."""
        for f in filters:
            name = getattr(f, "attribute", ())
            if len(name) == 1 and name[0] in self.box:
                low, high = self.box[name[0]]
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    low = max(low, float(f.value))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    high = min(high, float(f.value))
                self.box[name[0]] = (low, high)
            yield f

    def partitions(self) -> list[Window]:
        out = []
        for file, length in listed(self.path, self.glob):
            with opened(re.sub(r"\.[^.]*$", ".lbl", file)) as f:
                tile = Tile.of(f.read().decode("latin-1"))
            if length < tile.lines * tile.samples * tile.kind.itemsize:
                raise ValueError(f"{file}: {length} bytes are too few for {tile.lines} lines of {tile.samples} cells")
            top, bottom, left, right = tile.inside(self.box)
            if top < bottom and left < right:
                each = max(1, self.band // (right - left))
                out += [Window(file, tile, (at, min(at + each, bottom)), (left, right)) for at in range(top, bottom, each)]
        return out

    def read(self, window: Window | None) -> Iterator[pa.RecordBatch]:
        if window is None:  # no tile meets the box
            return
        tile, (left, right) = window.tile, window.samples
        wide, size = right - left, tile.kind.itemsize
        each = max(1, (1 << 16) // wide)
        with opened(window.file) as f:
            for top in range(*window.lines, each):
                lines = np.arange(top, min(top + each, window.lines[1]))
                parts = []
                for line in lines.tolist():
                    f.seek((line * tile.samples + left) * size)
                    parts.append(f.read(wide * size))
                height = np.frombuffer(b"".join(parts), tile.kind).astype(float) * tile.scale + tile.offset
                line, sample = np.repeat(lines, wide), np.tile(np.arange(left, right), len(lines))
                yield pa.record_batch([pa.array([window.file] * len(line)), pa.array(line.astype(np.int32)), pa.array(sample.astype(np.int32)), pa.array(tile.latitude(line)), pa.array(tile.longitude(sample)), pa.array(height)], ["tile", "line", "sample", "latitude", "longitude", "height"])


def cells(spark: SparkSession, path: str, glob: str = "*.img", box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """tile, line, sample, latitude, longitude, height of the cells under path, whose middles lie in the box (south, north, west, east; edges included). Each raster has a label of its name with the ending lbl. Conditions on latitude and longitude narrow the box too: this turns on spark.sql.python.filterPushdown.enabled. A box over the seam of longitudes takes two calls."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Raster)
    bounds = dict(zip(("south", "north", "west", "east"), map(str, box), strict=True)) if box else {}
    return spark.read.format("labelled_raster").options(path=path, glob=glob, **bounds).load()


def merged(cells_: DataFrame, per_degree: float, north: float, west: float) -> DataFrame:
    """row, col, z: the cells of all tiles on one grid whose first cell's middle is at (north, west), as terrain.heights takes them."""
    return cells_.select(F.round((F.lit(north) - F.col("latitude")) * per_degree).cast("long").alias("row"), F.round((F.col("longitude") - F.lit(west)) * per_degree).cast("long").alias("col"), F.col("height").alias("z"))
