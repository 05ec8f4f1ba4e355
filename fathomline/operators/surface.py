"""From compressed traces to a table of surface echoes, and their statistics over a grid of circles."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import number, signal, traces

#: The columns of the archived table, in order.
TABLE = ["EPHEMERIS_TIME", "SUB_SC_PLANETOCENTRIC_LATITUDE", "SUB_SC_EAST_LONGITUDE", "SOLAR_ZENITH_ANGLE", "SOLAR_LONGITUDE", "SPACECRAFT_ALTITUDE", "SC_ROLL_ANGLE", "surf_y", "surf_amp", "surf_pow", "flag"]


def steepest(power: Column | str, centre: Column | str, width: int) -> Column:
    """Index of the sample within width around the centre at which power times its step to the next sample is largest, the first of equals; null if the window is empty."""
    p, c = (F.col(x) if isinstance(x, str) else x for x in (power, centre))
    low = F.greatest(F.lit(0), c - width // 2).cast("int")
    high = F.least(F.size(p) - 1, c + (width + 1) // 2).cast("int")
    window = F.slice(p, low + 1, F.greatest(high - low + 1, F.lit(0)))
    product = F.zip_with(F.slice(window, 1, F.greatest(F.size(window) - 1, F.lit(0))), F.slice(window, 2, F.greatest(F.size(window) - 1, F.lit(0))), lambda a, b: a * (b - a))
    return F.when(F.size(window) > 1, traces.argmax(product) + low)


def surfaces(compressed: DataFrame, altimetry: DataFrame | None, auxiliary: DataFrame, key: str, order: str, width: int = 100, gain: float = 0.0, altitude: bool = True, antenna: bool = True) -> DataFrame:
    """key, order, surf_y, surf_amp, surf_pow (dB), flag and the auxiliary columns.

    compressed: key, order, re, im. altimetry: key, order, idx_fine, flag; places outside the trace count as 0, and without altimetry the window lies at the trace's start and flags are 0. A trace without a pick has amplitude 0.
    """
    rows = compressed.select(key, order, F.zip_with("re", "im", lambda x, y: x.cast("double") * x + y.cast("double") * y).alias("power_"))
    if altimetry is None:
        rows = rows.withColumns({"at_": F.lit(-(-width // 2)), "flag": F.lit(0)})
    else:
        rows = rows.join(altimetry.select(key, order, F.col("idx_fine").alias("at_"), "flag"), [key, order])
        rows = rows.withColumn("at_", F.when((F.col("at_") < 0) | (F.col("at_") > F.size("power_")), 0).otherwise(F.floor("at_")).cast("int"))
    rows = rows.join(auxiliary, [key, order]).withColumn("surf_y", steepest("power_", "at_", width))
    total = F.lit(float(gain))
    if altitude:
        total = total + signal.altitude_gain("SPACECRAFT_ALTITUDE")
    if antenna:
        total = total + signal.antenna_gain("MRO_SAMX_INNER_GIMBAL_ANGLE", "MRO_SAPX_INNER_GIMBAL_ANGLE", "MRO_HGA_OUTER_GIMBAL_ANGLE")
    amplitude = F.coalesce(F.sqrt(F.get("power_", "surf_y")), F.lit(0.0)) * signal.from_decibel(total)
    rows = rows.withColumn("surf_amp", amplitude)
    return rows.withColumn("surf_pow", signal.decibel("surf_amp")).drop("power_", "at_")


def archived(rows: DataFrame) -> DataFrame:
    """The columns of the archived table, as its text files have them; `.write.csv(path, header=True)` stores it."""
    return rows.select(*TABLE)


def usable(rows: DataFrame) -> DataFrame:
    """Echoes with an amplitude, a good flag, a roll near 0 or 180 degrees, and no missing or infinite number."""
    roll = F.col("SC_ROLL_ANGLE")
    level = ((roll > -0.5) & (roll < 0.5)) | ((roll > 179.5) & (roll < 180.5))
    numbers = [F.col(c) for c in ("surf_amp", "SUB_SC_EAST_LONGITUDE", "SUB_SC_PLANETOCENTRIC_LATITUDE")]
    whole = [c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in numbers]
    return rows.where((F.col("surf_amp") > 0) & (F.col("flag") == 0) & level & whole[0] & whole[1] & whole[2])


def circles(rows: DataFrame, lon: str, lat: str, value: str, r: float, limits: tuple[float, float, float, float], least: int = 1) -> DataFrame:
    """col, row, lon, lat, n, mean, deviation (of the population) and power (mean square): statistics of the rows within r degrees of each point of a square grid that is r apart and begins at the west and south limits. Circles of fewer than `least` rows aren't listed.

    A row looks only at the few points around it; sums of a point are made before the shuffle, so that a place with many rows is no single task.
    """
    west, east, south, north = limits
    x, y = number(lon), number(lat)
    near = lambda v, first: F.sequence(F.ceil((v - r - first) / r).cast("long"), F.floor((v + r - first) / r).cast("long"))
    cells = rows.where(x.between(west - r, east + r) & y.between(south - r, north + r)).select(x.alias("x"), y.alias("y"), number(value).alias("v"), F.explode(near(x, west)).alias("col"), near(y, south).alias("rows_")).withColumn("row", F.explode("rows_"))
    cells = cells.withColumns({"lon": west + F.col("col") * r, "lat": south + F.col("row") * r}).where((F.col("col") >= 0) & (F.col("row") >= 0) & (F.col("lon") <= east) & (F.col("lat") <= north))
    inside = cells.where((F.col("x") - F.col("lon")) * (F.col("x") - F.col("lon")) + (F.col("y") - F.col("lat")) * (F.col("y") - F.col("lat")) <= r * r)
    out = inside.groupBy("col", "row").agg(F.min("lon").alias("lon"), F.min("lat").alias("lat"), F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("deviation"), F.avg(F.col("v") * F.col("v")).alias("power"))
    return out.where(F.col("n") >= least)


def specularity(short: DataFrame, long: DataFrame, key: str, time: str, samples: str, pick: str, reach: int = 5) -> DataFrame:
    """key, time, specularity: the short aperture's sample over the long one's, at the short one's pick, for traces of equal time; null unless both picks exist and lie within reach of each other."""
    a, b = (df.select(key, time, F.col(samples).alias(f"{n}_"), F.col(pick).alias(f"{n}_at_")) for n, df in (("short", short), ("long", long)))
    rows = a.join(b, [key, time])
    ratio = F.try_divide(F.get("short_", F.col("short_at_").cast("int")), F.get("long_", F.col("short_at_").cast("int")))
    return rows.select(key, time, F.when(F.abs(F.col("short_at_") - F.col("long_at_")) <= reach, ratio).alias("specularity"))
