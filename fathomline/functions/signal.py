"""Scalar signal arithmetic: peaks, gains, complex numbers as pairs, code tables."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import number

#: Pulse repetition intervals in microseconds and presummed pulses, by telemetry code.
PRI_US = {1: 1428.0, 2: 1429.0, 3: 1290.0, 4: 2856.0, 5: 2984.0, 6: 2580.0}
PRESUM = (1, 2, 3, 4, 8, 16, 32, 64)
REFERENCE_ALTITUDE_KM = 250.0


def parabola3(before, at, after) -> Column:
    """Vertex of the parabola through three samples: struct of place, height and half-curvature. Null where they lie on a line."""
    l, m, r = map(number, (before, at, after))
    place = F.try_divide(r - l, 2 * (2 * m - r - l))
    return F.struct(place.alias("place"), (m - 0.25 * (l - r) * place).alias("height"), (0.5 * (l - 2 * m + r)).alias("curvature"))


def parabola5(*samples) -> Column:
    """Vertex of the least-squares parabola through five samples."""
    p, q, r, s, t = map(number, samples)
    level = (-6.0 * p + 24.0 * q + 34.0 * r + 24.0 * s - 6.0 * t) / 70
    slope = (-2.0 * p - q + s + 2.0 * t) / 10
    bend = (p + q + r + s + t - 5.0 * level) / 10
    place = F.try_divide(-slope, 2 * bend)
    return F.struct(place.alias("place"), (level + slope * place + bend * place * place).alias("height"), bend.alias("curvature"))


def peak(samples, at) -> Column:
    """Interpolated peak of an array around index `at` (from 0): five points inside, three next to the edge, the sample itself at it."""
    a = F.col(samples) if isinstance(samples, str) else samples
    i = F.col(at) if isinstance(at, str) else at
    get = lambda k: F.get(a, (i + k).cast("int"))
    n = F.size(a)
    exact = F.struct(F.lit(0.0).alias("place"), number(get(0)).alias("height"), F.lit(None).cast("double").alias("curvature"))
    return F.when((i >= 2) & (i <= n - 3), parabola5(*map(get, range(-2, 3)))).when((i > 0) & (i < n - 1), parabola3(get(-1), get(0), get(1))).otherwise(exact)


def quadratic_through(x, knots: list, values: list) -> Column:
    """The quadratic through three points, at x."""
    x, k, v = number(x), [number(y) for y in knots], [number(y) for y in values]
    term = lambda i, j, l: v[i] * F.try_divide((x - k[j]) * (x - k[l]), (k[i] - k[j]) * (k[i] - k[l]))
    return term(0, 1, 2) + term(1, 0, 2) + term(2, 0, 1)


def decibel(x, factor: float = 20.0) -> Column:
    """Minus infinity for 0."""
    x = number(x)
    return F.when(x == 0, F.lit(float("-inf"))).otherwise(factor * F.log10(x))


def from_decibel(x, factor: float = 20.0) -> Column:
    return F.pow(F.lit(10.0), number(x) / factor)


def to_complex(magnitude_db, phase, power: bool = False) -> tuple[Column, Column]:
    m = from_decibel(magnitude_db, 10.0 if power else 20.0)
    return m * F.cos(number(phase)), m * F.sin(number(phase))


def to_polar(re, im) -> tuple[Column, Column]:
    return decibel(F.hypot(number(re), number(im))), F.atan2(number(im), number(re))


def wrap_phase(x) -> Column:
    return F.pmod(number(x) + F.pi(), 2 * F.pi()) - F.pi()


def gaussian(x, height, centre, sigma) -> Column:
    d = number(x) - number(centre)
    return number(height) * F.exp(-d * d / (2 * number(sigma) * number(sigma)))


def altitude_gain(altitude_km) -> Column:
    return 20 * F.log10(number(altitude_km) / REFERENCE_ALTITUDE_KM)


def latitude_gain(latitude) -> Column:
    x = number(latitude) / 90
    return -(-0.41 - 1.62 * x - 1.10 * x * x + 0.65 * x * x * x + 0.66 * x * x * x * x)


def antenna_gain(inner_minus, inner_plus, outer) -> Column:
    return -(0.0423 * F.abs(number(inner_minus)) + 0.0274 * F.abs(number(inner_plus)) - 0.0056 * F.abs(number(outer)))


def static_scale(presum, bits) -> Column:
    """Factor that undoes static compression."""
    p = number(presum)
    return F.pow(F.lit(2.0), F.ceil(F.log2(p)) - number(bits) + 8) / p


def presum_of(code) -> Column:
    return F.element_at(F.array(*map(F.lit, PRESUM)), F.col(code) + 1 if isinstance(code, str) else code + 1)


def pri_of(code, unknown: float | None = None) -> Column:
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(F.element_at(F.create_map(*(F.lit(y) for x in PRI_US.items() for y in x)), code), F.lit(unknown).cast("double"))


#: Speed of light, and what precedes the receive window besides the pulse repetition interval.
LIGHT, BEFORE_WINDOW_S = 299792458.0, 11.98e-6


def window_opening(samples, code, climb_km=0.0, sample_s: float = 0.0375e-6) -> Column:
    """Seconds from pulse to the receive window of `samples` before its opening, as seen from the lowest radius of the track. An unknown interval code adds nothing."""
    return number(samples) * sample_s + pri_of(code, 0.0) / 1e6 - BEFORE_WINDOW_S - 2000 * number(climb_km) / LIGHT


def distance_to_window(samples, code, climb_m=0.0, sample_s: float = 0.0375e-6) -> Column:
    """One-way metres from the lowest radius of the track to the first sample."""
    return (number(samples) * sample_s + pri_of(code, 0.0) / 1e6 - BEFORE_WINDOW_S) * LIGHT / 2 - number(climb_m)


def channel_specs(text: str) -> list[tuple[int, int, float, int, float]]:
    """Rows chanout, chan0in, scalef0, chan1in, scalef1 of a number (that channel as it is) or of a list such as [1,1,0.5,2,0.5; 2,3,1,0,0]."""
    text = re.sub(r"[\\\s\[\]]", "", str(text)).rstrip(";")
    if re.fullmatch(r"[+-]?\d+", text):
        return [(int(text), int(text), 1.0, 0, 0.0)]
    out = []
    for line in text.split(";"):
        parts = line.split(",")
        if len(parts) != 5:
            raise ValueError(f"{line!r} has {len(parts)} values, not 5")
        out.append((int(parts[0]), int(parts[1]), float(parts[2]), int(parts[3]), float(parts[4])))
    return out


#: What magnitudes and phases of processed lines are divided by when they are read, and phases multiplied by when they are written.
MAGNITUDE_UNIT, PHASE_UNIT, PHASE_SCALE = 10000.0, 65536.0, 16777216.0


def written_integers(magnitude, phase, scale: float) -> tuple[Column, Column]:
    """Whole numbers (cut, not rounded) of a magnitude's decadic logarithm times scale, and of a phase in radians; null for a magnitude of 0."""
    m = number(magnitude)
    return F.when(m > 0, scale * F.log10(m)).cast("int"), (number(phase) * PHASE_SCALE).cast("int")


def read_integers(magnitude, phase) -> tuple[Column, Column]:
    """Decibels and radians of the whole numbers that processed lines hold."""
    return number(magnitude) / MAGNITUDE_UNIT, number(phase) / PHASE_UNIT
