"""Coordinates and distances on spheres and ellipsoids, as Column expressions. Angles are in degrees."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import let, number


def ellipsoid_radius(lat, lon, axes: tuple[float, float, float] = (0.0, 0.0, 0.0), radius: float = 0.0) -> Column:
    """Radius in metres of a triaxial ellipsoid with axes in km; of a sphere where an axis is 0."""
    a, b, c = map(float, axes)
    if not a * b * c:
        return F.lit(1000.0 * radius)
    lat, lon = F.radians(number(lat)), F.radians(number(lon))
    parts = (a * b * F.sin(lat), b * c * F.cos(lat) * F.cos(lon), a * c * F.cos(lat) * F.sin(lon))
    return F.lit(1000.0 * a * b * c) / F.sqrt(parts[0] * parts[0] + parts[1] * parts[1] + parts[2] * parts[2])


def to_cartesian(lat, lon, height, **ellipsoid) -> tuple[Column, Column, Column]:
    r = number(height) + ellipsoid_radius(lat, lon, **ellipsoid)
    lat, lon = F.radians(number(lat)), F.radians(number(lon))
    return r * F.cos(lon) * F.cos(lat), r * F.sin(lon) * F.cos(lat), r * F.sin(lat)


def to_spherical(x, y, z, **ellipsoid) -> tuple[Column, Column, Column]:
    """Latitude, longitude from 0 to 360, and height; null at the centre, where there is no direction."""
    x, y, z = map(number, (x, y, z))
    r = F.sqrt(x * x + y * y + z * z)
    lat = F.degrees(F.asin(F.try_divide(z, r)))
    lon = F.degrees(F.pmod(F.atan2(y, x) + 2 * F.pi(), 2 * F.pi()))
    return lat, lon, r - ellipsoid_radius(lat, lon, **ellipsoid)


def sphere_distance(lat1, lon1, lat2, lon2, radius: float) -> Column:
    """By the law of cosines."""
    a, b, c, d = (F.radians(number(x)) for x in (lat1, lon1, lat2, lon2))
    return radius * F.acos(F.sin(a) * F.sin(c) + F.cos(a) * F.cos(c) * F.cos(b - d))


def haversine_distance(lat1, lon1, lat2, lon2, radius: float) -> Column:
    lat1, lon1, lat2, lon2 = map(number, (lat1, lon1, lat2, lon2))
    s, t = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    h = s * s + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * t * t
    return radius * 2 * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def apex_distance(radius1, radius2, lat1, lon1, lat2, lon2) -> Column:
    """Straight distance of two points given by their radii and places."""
    r, s = number(radius1), number(radius2)
    return F.sqrt(r * r + s * s - 2 * r * s * F.cos(haversine_distance(lat1, lon1, lat2, lon2, 1.0)))


def look_angle(surface_delay, feature_delay) -> Column:
    """Angle off nadir in radians of an echo, from the delays of the surface below and of the echo."""
    return F.acos(F.try_divide(number(surface_delay), number(feature_delay)))


def roll_phase(roll, baseline: float, wavelength: float) -> Column:
    return 2 * F.pi() * baseline / wavelength * F.sin(-number(roll))


def geodesic(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray, a: float, b: float, rounds: int) -> np.ndarray:
    """Vincenty's inverse iteration on arrays of degrees."""
    f = 1 - b / a
    u1, u2 = (np.arctan((1 - f) * np.tan(np.radians(x))) for x in (lat1, lat2))
    span = np.radians(lon2 - lon1)
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    share = lambda x, y: np.divide(x, y, out=np.zeros_like(x), where=y != 0)

    def angles(lam):
        left, right = c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam)
        sin, cos = np.sqrt(left * left + right * right), s1 * s2 + c1 * c2 * np.cos(lam)
        azimuth = share(c1 * c2 * np.sin(lam), sin)
        square = 1 - azimuth * azimuth
        return sin, cos, np.arctan2(sin, cos), azimuth, square, cos - share(2 * s1 * s2, square)

    lam = span
    for _ in range(rounds):
        sin, cos, sigma, azimuth, square, mid = angles(lam)
        c = f / 16 * square * (4 + f * (4 - 3 * square))
        lam = span + (1 - c) * f * azimuth * (sigma + c * sin * (mid + c * cos * (2 * mid * mid - 1)))
    sin, cos, sigma, azimuth, square, mid = angles(lam)
    u = square * (a * a - b * b) / (b * b)
    big = 1 + u / 16384 * (4096 + u * (u * (320 - 175 * u) - 768))
    small = u / 1024 * (256 + u * (u * (74 - 47 * u) - 128))
    bend = small * sin * (mid + small / 4 * (cos * (2 * mid * mid - 1) - small / 6 * mid * (4 * sin * sin - 3) * (4 * mid * mid - 3)))
    return b * big * (sigma - bend)


def ellipsoidal_distance(lat1, lon1, lat2, lon2, a: float, b: float, rounds: int = 8) -> Column:
    """Length of the geodesic on an ellipsoid of revolution with half-axes a and b, by Vincenty's inverse iteration; 0 for equal points. Nearly opposite points may not converge in the rounds. On Arrow batches, as a round has some thirty steps, which higher-order functions would interpret."""

    def run(p: pa.Array, q: pa.Array, r: pa.Array, s: pa.Array) -> pa.Array:
        at = [x.to_numpy(zero_copy_only=False) for x in (p, q, r, s)]
        missing = np.logical_or.reduce([x.is_null().to_numpy(zero_copy_only=False) for x in (p, q, r, s)])
        with np.errstate(invalid="ignore"):
            return pa.array(geodesic(*at, a, b, rounds), mask=missing)

    return F.arrow_udf(run, "double")(*(number(x) for x in (lat1, lon1, lat2, lon2)))


def rotated(q: tuple, x, y, z) -> tuple[Column, Column, Column]:
    """The vector turned by quaternion q = (w, i, j, k) and stretched by its norm; null for a quaternion of zeros."""
    w, i, j, k = map(number, q)
    x, y, z = map(number, (x, y, z))
    norm = F.sqrt(w * w + i * i + j * j + k * k)
    rows = (
        ((w * w + i * i - j * j - k * k), 2 * (i * j - w * k), 2 * (i * k + w * j)),
        (2 * (i * j + w * k), (w * w - i * i + j * j - k * k), 2 * (j * k - w * i)),
        (2 * (i * k - w * j), 2 * (j * k + w * i), (w * w - i * i - j * j + k * k)),
    )
    return tuple(F.try_divide(a * x + b * y + c * z, norm) for a, b, c in rows)


def degrees_of(text) -> Column:
    """Degrees of a text such as 12d30'15.5"W, west and south being negative; null for other texts."""
    part = lambda i: F.regexp_extract(text, r"(\d+)d\s*(\d+)'\s*([\d.]+)\"\s*([NSEW])", i)
    value = part(1).try_cast("double") + part(2).try_cast("double") / 60 + part(3).try_cast("double") / 3600
    return F.when(part(4).isin("W", "S"), -value).otherwise(value)


def box_around(lon, lat, r_circle: float, r_sphere: float) -> Column:
    """Struct west, east, south, north of the box around a circle on a sphere: latitudes by the angle, longitudes by the sine theorem; all longitudes where a pole lies inside."""
    a, lon, lat = r_circle / r_sphere, number(lon), number(lat)
    south, north = lat - F.degrees(F.lit(a)), lat + F.degrees(F.lit(a))
    polar = (north >= 90) | (south <= -90) | F.lit(a >= 1.5707963267948966)
    span = F.degrees(F.asin(F.sin(F.lit(a)) / F.sin(F.radians(90 - F.abs(lat)))))
    return F.struct(F.when(polar, 0.0).otherwise(lon - span).alias("west"), F.when(polar, 360.0).otherwise(lon + span).alias("east"), F.greatest(south, F.lit(-90.0)).alias("south"), F.least(north, F.lit(90.0)).alias("north"))


def to_line_sample(lat, lon, height, top: float, left: float, per_degree: float) -> tuple[Column, Column, Column]:
    """Line, sample and height on a raster whose rows and columns are equal parts of a degree: top and left are the latitude and longitude of its first cell's middle."""
    return (top - number(lat)) * per_degree, (number(lon) - left) * per_degree, number(height)


def from_line_sample(line, sample, height, top: float, left: float, per_degree: float) -> tuple[Column, Column, Column]:
    """Latitude, longitude and height."""
    return top - number(line) / per_degree, left + number(sample) / per_degree, number(height)


def line_sample_to_cartesian(line, sample, height, top: float, left: float, per_degree: float, **ellipsoid) -> tuple[Column, Column, Column]:
    return to_cartesian(*from_line_sample(line, sample, height, top, left, per_degree), **ellipsoid)


def cartesian_to_line_sample(x, y, z, top: float, left: float, per_degree: float, **ellipsoid) -> tuple[Column, Column, Column]:
    return to_line_sample(*to_spherical(x, y, z, **ellipsoid), top, left, per_degree)


def quaternion(rows: tuple) -> tuple[Column, Column, Column, Column]:
    """(w, i, j, k) of a rotation matrix that may be stretched: norm is the cube root of its determinant. Null for a singular one."""
    (a, b, c), (d, e, f), (g, h, i) = ([number(x) for x in row] for row in rows)
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    size = F.when(det != 0, F.sign(det) * F.pow(F.abs(det), 1 / 3))
    half = lambda p, q, r: size / 2 * F.sqrt(F.greatest(1 + (p * a + q * e + r * i) / size, F.lit(0.0)))
    signed = lambda x, y: F.sign((x - y) / size)
    return half(1, 1, 1), signed(h, f) * half(1, -1, -1), signed(c, g) * half(-1, 1, -1), signed(d, b) * half(-1, -1, 1)


def change_of_radius(df: DataFrame, key: str, radius: str, out: str) -> DataFrame:
    """df with out, the radius above the least of its product."""
    return df.join(df.groupBy(key).agg(F.min(radius).alias("least_")), key).withColumn(out, F.col(radius) - F.col("least_")).drop("least_")
