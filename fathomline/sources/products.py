"""The archive's products as tables: auxiliary records, altimetry, electron content, surface echoes and their statistics."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ..operators.surface import TABLE
from .binary import _column, records

#: The fields of an auxiliary record, big-endian.
AUXILIARY = [
    ("SCET_BLOCK_WHOLE", ">u4"), ("SCET_BLOCK_FRAC", ">u2"), ("EPHEMERIS_TIME", ">i8"), ("GEOMETRY_EPOCH", "S23"), ("SOLAR_LONGITUDE", ">f8"), ("ORBIT_NUMBER", ">i4"),
    ("X_MARS_SC_POSITION_VECTOR", ">f8"), ("Y_MARS_SC_POSITION_VECTOR", ">f8"), ("Z_MARS_SC_POSITION_VECTOR", ">f8"), ("SPACECRAFT_ALTITUDE", ">f8"), ("SUB_SC_EAST_LONGITUDE", ">f8"), ("SUB_SC_PLANETOCENTRIC_LATITUDE", ">f8"), ("SUB_SC_PLANETOGRAPHIC_LATITUDE", ">f8"),
    ("X_MARS_SC_VELOCITY_VECTOR", ">f8"), ("Y_MARS_SC_VELOCITY_VECTOR", ">f8"), ("Z_MARS_SC_VELOCITY_VECTOR", ">f8"), ("MARS_SC_RADIAL_VELOCITY", ">f8"), ("MARS_SC_TANGENTIAL_VELOCITY", ">f8"), ("LOCAL_TRUE_SOLAR_TIME", ">f8"), ("SOLAR_ZENITH_ANGLE", ">f8"),
    ("SC_PITCH_ANGLE", ">f8"), ("SC_YAW_ANGLE", ">f8"), ("SC_ROLL_ANGLE", ">f8"), ("MRO_SAMX_INNER_GIMBAL_ANGLE", ">f8"), ("MRO_SAMX_OUTER_GIMBAL_ANGLE", ">f8"), ("MRO_SAPX_INNER_GIMBAL_ANGLE", ">f8"), ("MRO_SAPX_OUTER_GIMBAL_ANGLE", ">f8"), ("MRO_HGA_INNER_GIMBAL_ANGLE", ">f8"), ("MRO_HGA_OUTER_GIMBAL_ANGLE", ">f8"),
    ("DES_TEMP", ">f4"), ("DES_5V", ">f4"), ("DES_12V", ">f4"), ("DES_2V5", ">f4"), ("RX_TEMP", ">f4"), ("TX_TEMP", ">f4"), ("TX_LEV", ">f4"), ("TX_CURR", ">f4"), ("CORRUPTED_DATA_FLAG1", "u1"), ("CORRUPTED_DATA_FLAG2", "u1"),
]
#: Columns of an altimetry table, of the fit's statistics, and of a table of electron contents.
ALTIMETRY = ["et", "spot_lat", "spot_lon", "spot_radius", "idx_coarse", "idx_fine", "range", "snr"]
STATISTICS = ["xa", "xb", "xo", "pt", "pc", "pn", "crl", "chisqr", "mu", "ok"]
CONTENT = ["electron", "sigma"]


def auxiliary(spark: SparkSession, path: str, glob: str = "*_a.dat") -> DataFrame:
    """file, record and the auxiliary fields of all files under path."""
    return records(spark, path, AUXILIARY, glob)


def decoded(df: DataFrame, columns: list[str], packed: str, layout: list[tuple]) -> DataFrame:
    """columns, record (from 0 in each value) and the fields of whole records in a binary column."""
    dtype = np.dtype(layout)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fields = [(n, _column(np.zeros(1, dtype)[n]).type) for n in dtype.names]
    schema = df.select(*columns).schema
    for f in [*from_arrow_schema(pa.schema([("record", pa.int64()), *fields])).fields]:
        schema = schema.add(f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [x.as_py() or b"" for x in batch[packed]]
            if bad := next((len(v) for v in values if len(v) % dtype.itemsize), None):
                raise ValueError(f"{bad} bytes are no whole number of records of {dtype.itemsize}")
            rows, n = np.frombuffer(b"".join(values), dtype), np.array([len(v) // dtype.itemsize for v in values], np.int64)
            whose = pa.array(np.repeat(np.arange(len(n)), n))
            no = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.record_batch([*(batch[c].take(whose) for c in columns), pa.array(no), *(_column(rows[f]) for f in dtype.names)], [*columns, "record", *dtype.names])

    assert packed in kinds
    return df.select(*columns, packed).mapInArrow(run, schema)


def encoded(df: DataFrame, columns: list[str], packed: str, layout: list[tuple]) -> DataFrame:
    """columns and a binary column of one record each, made of the fields of layout; fields that df lacks are zero or empty."""
    dtype = np.dtype(layout)
    have = [n for n in dtype.names if n in df.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros(batch.num_rows, dtype)
            for n in have:
                x = batch[n].to_numpy(zero_copy_only=False)
                rows[n] = [str(v).encode("latin-1") for v in x] if dtype[n].kind == "S" else x
            data, size = rows.tobytes(), dtype.itemsize
            yield pa.record_batch([*(batch[c] for c in columns), pa.array([data[i * size : (i + 1) * size] for i in range(len(rows))], pa.binary())], [*columns, packed])

    schema = df.select(*columns).schema.add(packed, "binary")
    return df.select(*dict.fromkeys([*columns, *have])).mapInArrow(run, schema)


def _table(spark: SparkSession, path: str, columns: list[str], header: bool, separator: str) -> DataFrame:
    schema = ", ".join(f"`{c}` double" for c in columns)
    return spark.read.schema(schema).options(header=header, sep=separator, ignoreLeadingWhiteSpace=True).csv(path)


def altimetry(spark: SparkSession, path: str, quality: bool = False) -> DataFrame:
    """Altimetry tables (text with a header). quality: adds flag, 1 where the fine pick is negative."""
    rows = _table(spark, path, ALTIMETRY, True, ",")
    return rows.withColumn("flag", (F.col("idx_fine") < 0).cast("int")) if quality else rows


def electron_content(spark: SparkSession, path: str) -> DataFrame:
    """Content and width of each chunk, from text files without a header."""
    return _table(spark, path, CONTENT, False, " ")


def surface_echoes(spark: SparkSession, path: str) -> DataFrame:
    """Tables of surface echoes (text with a header), as operators.surface.archived gives them."""
    return _table(spark, path, TABLE, True, ",")


def echo_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of echoes with the columns of the echoes themselves (text with a header)."""
    return _table(spark, path, [*STATISTICS, *TABLE], True, ",")


def stored(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Stores a product's table: 'parquet' for traces, 'csv' (with a header) for tables of numbers, 'json' for results of ranging. An existing one is an error."""
    if kind not in ("parquet", "csv", "json"):
        raise ValueError(f"no such kind: {kind}")
    writer = df.write.mode("errorifexists")
    (writer.option("header", True) if kind == "csv" else writer).format(kind).save(path)
