"""Spacecraft and Martian time. Leap seconds are ignored."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import number

#: Seconds from 1970 to the J2000 epoch and to the start of Mars year 1, the length of a sol and of a Mars year in sols, and the sols at which solar longitude passes each 30 degrees.
J2000 = 946728000
MARS_YEAR_1 = -464745600
SOL_SECONDS, YEAR_SOLS = 88775.245, 668.6
MONTH_SOLS = (0.0, 61.2, 126.6, 193.3, 257.8, 317.5, 371.9, 421.6, 468.5, 514.6, 562.0, 612.9, 668.6)


def seconds_since_j2000(ts) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp")) / 1e6 - J2000


def parse_iso(text) -> Column:
    """J2000 seconds of a day-of-month or day-of-year timestamp; an error for anything else."""
    text = F.rtrim(F.col(text) if isinstance(text, str) else text)
    forms = ("yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-DDD'T'HH:mm:ss.SSS", "yyyy-DDD'T'HH:mm:ss")
    return seconds_since_j2000(F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in forms), F.when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp"))))


def mars_year(seconds_j2000) -> Column:
    return F.ceil((number(seconds_j2000) + J2000 - MARS_YEAR_1) / (SOL_SECONDS * YEAR_SOLS)).cast("int")


def solar_longitude(seconds_j2000) -> Column:
    """Linear within each twelfth of the Mars year."""
    since = number(seconds_j2000) + J2000 - MARS_YEAR_1
    sols = (since - (mars_year(seconds_j2000) - 1) * (SOL_SECONDS * YEAR_SOLS)) / SOL_SECONDS
    out = F.lit(360.0)
    for i in range(11, -1, -1):
        lo, hi = MONTH_SOLS[i], MONTH_SOLS[i + 1]
        out = F.when(sols < hi, 30.0 * i + 30.0 * ((sols - lo) / (hi - lo))).otherwise(out)
    return F.greatest(out, F.lit(0.0))
