"""Chains of operators from telemetry to products."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import signal
from ..operators import kernels, windows

BITS = 8


def decompressed(df: DataFrame, key: str, order: str, samples: str, compression: str, tracking: str) -> DataFrame:
    """df with its samples (array of double) undone of on-board scaling. A product's first trace says how: compression code 0 is static, for the pulses that its tracking code stands for; an error for dynamic scaling, whose factors vary within a product."""
    first = df.groupBy(key).agg(F.min_by(F.struct(F.col(compression).alias("kind"), F.col(tracking).cast("int").alias("code")), order).alias("how_"))
    scale = F.when(F.col("how_.kind") == 0, signal.static_scale(signal.presum_of(F.col("how_.code")), BITS)).otherwise(F.raise_error(F.lit("dynamic scaling isn't supported")).cast("double"))
    rows = df.join(first.select(key, scale.alias("scale_")), key)
    return rows.withColumn(samples, F.transform(samples, lambda x: x * F.col("scale_"))).drop("scale_")


def compressed(df: DataFrame, key: str, order: str, samples: str, zenith: str, compression: str, tracking: str, distance: str | None = None, length: float = 30.0, rows: int = 512) -> DataFrame:
    """key, chunk, order, re, im, tec, tec_width: telemetry decompressed, cut into chunks by distance along track (by `rows` traces without a distance), and range-compressed chunk by chunk."""
    plain = decompressed(df, key, order, samples, compression, tracking)
    chunked = windows.distance_chunks(plain, key, order, distance, length) if distance else windows.fixed_chunks(plain, key, order, rows)
    return kernels.range_compress(chunked, key, "chunk", order, samples, zenith)


def contents(compressed_: DataFrame, key: str) -> DataFrame:
    """key, chunk, tec, tec_width: a row for each chunk, as the archive's tables of electron contents have them."""
    return compressed_.groupBy(key, "chunk").agg(F.max("tec").alias("tec"), F.max("tec_width").alias("tec_width"))
