"""From compressed traces to altimetry spots: zero-Doppler sums, alignment by the spacecraft's radius, averaging along track, a coarse pick and a fit around it."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import number, signal, traces
from . import kernels, windows

#: Samples on either side of the coarse pick that the fit takes in, the pulse interval of an unknown code in microseconds, the centre frequency, and the constants of the ionosphere's delay.
FIT_REACH, USUAL_PRI_US, CENTRE_HZ, DELAY, TECU = 100, 1428.0, 20e6, 1.69e-6, 1e16
#: Columns that the geometry has besides key and order.
GEOMETRY = ["et", "latitude", "longitude", "radius_km", "window", "pri_code", "tecu", "corrupted"]


def fresnel_traces(altitude_m, speed, pri_s) -> Column:
    """Half the traces in a Fresnel zone: the averaging length of a product is the mean over its traces, cut."""
    c = signal.LIGHT
    zone = F.sqrt(number(altitude_m) * c / 10e6 + (c / 20e6) ** 2)
    return F.when(number(speed) != 0, 2 * zone / F.abs(number(speed)) / number(pri_s) / 2)


def filtered(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """Each trace its running mean of n samples (zero at the ends), less its mean, the ten samples at either end replaced by those twenty further in."""
    for c in columns:
        before = n // 2
        mean = F.transform(c, lambda x, i: F.when((i >= before) & (i + n - before <= F.size(c)), traces.total(F.slice(c, F.greatest(i - before, F.lit(0)) + 1, n)) / n).otherwise(0.0))  # noqa: B023
        df = df.withColumn("mean_", mean).withColumn("level_", traces.mean("mean_"))
        df = df.withColumn(c, F.transform("mean_", lambda x: x - F.col("level_"))).drop("mean_", "level_")
        size = F.size(c)
        df = df.withColumn(c, F.concat(F.slice(c, 21, 10), F.slice(c, 11, size - 20), F.slice(c, size - 29, 10)))
    return df


def averaged(df: DataFrame, key: str, order: str, samples: str, n: int) -> DataFrame:
    """key, order, samples: means of n traces around each, the end traces repeated."""
    if n <= 1:
        return df.select(key, order, samples)
    first = df.groupBy(key).agg(F.min(order).alias("base_"))
    wide = windows.padded(df, key, order, samples, n, n)
    sums = windows.trace_sums(wide, key, order, samples, n // 2, n - 1 - n // 2).join(first, key)
    last = sums.groupBy(key).agg((F.max(order) - 2 * n).alias("last_"))
    rows = sums.join(last, key).withColumn(order, F.col(order) - n).where((F.col(order) >= 0) & (F.col(order) <= F.col("last_")))
    return rows.select(key, (F.col(order) + F.col("base_")).cast(df.schema[order].dataType).alias(order), F.transform(samples, lambda x: x / n).alias(samples))


def spots(df: DataFrame, geometry: DataFrame, key: str, order: str, re: str, im: str, window: int, smooth: int | None = 10, doppler: tuple[int, int] = (30, 29), noise_scale: float = 20.0, fine: bool = True, skip: int = 20, reach: int = 1000, tail: int = 1000) -> DataFrame:
    """key, order, et, spot_lat, spot_lon, spot_radius, idx_coarse, idx_fine, range, snr: a row for each trace.

    geometry: key, order and GEOMETRY; corrupted (boolean) traces give -1 everywhere. window: traces that are averaged; smooth: samples of the running mean after the zero-Doppler sums, None for neither. Without fine the coarse pick stands and snr is 0. A trace without a pick counts as picked at 0.
    """
    rows = df.select(key, order, F.col(re).cast("array<double>").alias("re"), F.col(im).cast("array<double>").alias("im"))
    if smooth is not None:
        for c in ("re", "im"):
            rows = windows.zero_doppler(rows, key, order, c, *doppler)
        rows = filtered(rows, ["re", "im"], smooth)
    away = F.floor(2000 * number("radius_km") / signal.LIGHT / kernels.SAMPLE_S).cast("long")
    placed = geometry.select(key, order, *GEOMETRY).withColumn("phase", (F.col("window") - away).cast("long"))
    start = placed.where("window > 1000").groupBy(key).agg(F.min("phase").alias("tx0"))
    placed = placed.join(start, key).withColumn("lag", F.col("phase") - F.col("tx0"))
    level = F.zip_with("re", "im", lambda x, y: F.hypot(x, y))
    rolled = rows.join(placed.select(key, order, "lag"), [key, order]).select(key, order, traces.roll(level, F.col("lag")).alias("trace_"))
    rows = averaged(rolled, key, order, "trace_", window).join(placed, [key, order]).withColumn("shift", F.pmod("lag", F.size("trace_")).cast("int"))
    pick = F.coalesce(traces.coarse_pick("trace_", "shift", noise_scale, skip, reach, tail), F.lit(0))
    rows = rows.withColumn("coarse", F.when(~F.col("corrupted"), pick))
    geometry_columns = ["et", "latitude", "longitude", "radius_km", "window", "pri_code", "tecu", "phase", "tx0", "shift", "coarse"]
    if fine:
        asked = rows.where("coarse > 0").withColumn("first_", F.greatest(F.col("coarse") - FIT_REACH, F.lit(0)))
        asked = asked.withColumn("part_", F.slice("trace_", F.col("first_") + 1, F.least(F.col("coarse") + FIT_REACH, F.size("trace_")) - F.col("first_")))
        fits = kernels.retrack(asked.withColumn("power_", F.transform("part_", lambda x: x * x)), [key, order], "power_", "first_")
        rows = rows.select(key, order, *geometry_columns).join(fits, [key, order], "left").withColumns({"delta": F.coalesce("delta", F.lit(0.0)), "snr": F.coalesce("snr", F.lit(0.0))})
    else:
        rows = rows.select(key, order, *geometry_columns).withColumns({"delta": F.col("coarse").cast("double"), "snr": F.lit(0.0)})
    late = DELAY * number("tecu") * TECU / CENTRE_HZ / (2 * math.pi * CENTRE_HZ)
    flight = (F.col("window") + F.col("delta") - F.col("phase") + F.col("tx0")) * kernels.SAMPLE_S + signal.pri_of("pri_code", USUAL_PRI_US) / 1e6 - signal.BEFORE_WINDOW_S - late
    radius = number("radius_km") - flight * signal.LIGHT / 2000
    good = lambda c, name: F.when(F.col("coarse").isNull(), F.lit(-1.0)).otherwise(number(c)).alias(name)
    return rows.select(key, order, "et", F.col("latitude").alias("spot_lat"), F.col("longitude").alias("spot_lon"), good(radius, "spot_radius"), good(F.col("coarse") - F.col("shift"), "idx_coarse"), good(F.col("delta") - F.col("shift"), "idx_fine"), good(radius, "range"), good("snr", "snr"))
