"""The range offset between a radargram and its simulated clutter: both clipped, scaled and smoothed along track, then compared at every shift in fast time.

Sums over traces are Spark aggregates; no product is gathered.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import signal, traces
from . import windows
from .kernels import LIGHT, SAMPLE_S


def scaled(df: DataFrame, key: str, samples: str, depth_db: float) -> DataFrame:
    """Decibels cut at depth_db below the product's maximum and scaled to 0 to 1; 0 where a product has but one level."""
    ends = df.groupBy(key).agg(F.max(F.array_max(samples)).alias("top_"), F.min(F.array_min(samples)).alias("least_"))
    ends = ends.select(key, "top_", F.greatest(F.col("top_") - depth_db, "least_").alias("floor_"))
    return df.join(ends, key).withColumn(samples, F.transform(samples, lambda x: F.coalesce(F.try_divide(F.greatest(x, F.col("floor_")) - F.col("floor_"), F.col("top_") - F.col("floor_")), F.lit(0.0)))).drop("top_", "floor_")


def smoothed(df: DataFrame, key: str, order: str, samples: str, n: int) -> DataFrame:
    """Each trace the mean of n traces around it; traces without so many on either side go."""
    last = df.groupBy(key).agg(F.max(order).alias("last_"))
    rows = windows.trace_sums(df, key, order, samples, n // 2, n - 1 - n // 2).join(last, key)
    inner = (F.col(order) >= n) & (F.col(order) <= F.col("last_") - n)
    return rows.where(inner).withColumn(samples, F.transform(samples, lambda x: x / n)).drop("last_")


def residuals(df: DataFrame, key: str, simulated: str, measured: str, reach: int) -> DataFrame:
    """key, lag (-reach to reach - 1), residual: mean absolute difference over the samples that overlap when the measured trace is read `lag` samples further on (a negative lag compares the traces' beginnings)."""
    lags = F.sequence(F.lit(-reach), F.lit(reach - 1))
    n = F.size(measured)

    def total(lag):
        begin, length = F.greatest(F.lit(0), lag), n - F.abs(lag)
        gaps = F.zip_with(F.slice(simulated, 1, F.greatest(length, F.lit(0))), F.slice(measured, begin + 1, F.greatest(length, F.lit(0))), lambda p, q: F.abs(p - q))
        return F.struct(lag.alias("lag"), traces.total(gaps).alias("s"), F.greatest(length, F.lit(0)).alias("n"))

    rows = df.select(key, F.explode(F.transform(lags, total)).alias("x"))
    return rows.groupBy(key, F.col("x.lag").alias("lag")).agg(F.try_divide(F.sum("x.s"), F.sum("x.n")).alias("residual"))


def best(found: DataFrame, keys: list[str], sample_s: float = SAMPLE_S) -> DataFrame:
    """keys, delta (samples, between them by a parabola), dz (metres), residual: the lag of the least residual, least lag first among equals."""
    rows = found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("lag", "residual"))).alias("all_"))  # as many as there are lags
    curve = F.transform("all_", lambda x: -x["residual"])
    rows = rows.select(*keys, F.get("all_", F.lit(0))["lag"].alias("first_"), curve.alias("curve_")).withColumn("i_", traces.argmax("curve_"))
    top = signal.peak("curve_", "i_")
    rows = rows.select(*keys, (F.col("first_") + F.col("i_")).alias("lag_"), top.alias("top_"))
    delta = F.col("lag_") + F.coalesce(F.col("top_.place"), F.lit(0.0))
    return rows.select(*keys, delta.alias("delta"), (delta * sample_s * LIGHT / 2).alias("dz"), (-F.col("top_.height")).alias("residual"))


def offset(df: DataFrame, key: str, order: str, simulated: str, measured: str, depth_simulated: float, depth_measured: float, average: int, reach: int) -> DataFrame:
    """key, delta, dz, residual of two radargrams in decibels, as arrays of the same rows."""
    rows = scaled(scaled(df.select(key, order, simulated, measured), key, simulated, depth_simulated), key, measured, depth_measured)
    a = smoothed(rows.drop(measured), key, order, simulated, average)
    b = smoothed(rows.drop(simulated), key, order, measured, average)
    return best(residuals(a.join(b, [key, order]), key, simulated, measured, reach), [key])


def best_setting(df: DataFrame, key: str, order: str, simulated: str, measured: str, settings: list[float], depth_measured: float, average: int, reach: int) -> DataFrame:
    """The offset at the depth of the simulation, among `settings`, whose best residual is the least: key, setting, delta, dz, residual."""
    all_ = None
    for depth in settings:
        one = offset(df, key, order, simulated, measured, depth, depth_measured, average, reach).withColumn("setting", F.lit(float(depth)))
        all_ = one if all_ is None else windows.united(all_, one, key)
    pick = all_.groupBy(key).agg(F.min(F.struct("residual", "setting", "delta", "dz")).alias("x"))
    return pick.select(key, "x.setting", "x.delta", "x.dz", "x.residual")
