"""One trace as an array of samples: rolls, picks, noise. All stay in the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import let


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def total(a) -> Column:
    return F.aggregate(col(a), F.lit(0.0), lambda s, x: s + x)


def mean(a) -> Column:
    return F.try_divide(total(a), F.size(col(a)))


def variance(a) -> Column:
    """Of the population."""
    a = col(a)
    return F.try_divide(F.aggregate(a, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")), lambda t, x: F.struct((t["s"] + x).alias("s"), (t["q"] + x * x).alias("q")), lambda t: t["q"] - F.try_divide(t["s"] * t["s"], F.size(a))), F.size(a))


def argmax(a) -> Column:
    """From 0; the first of equal maxima."""
    return (F.array_position(col(a), F.array_max(col(a))) - 1).cast("int")


def roll(a, n) -> Column:
    """Circular shift to the right."""
    a, n = col(a), F.lit(n) if isinstance(n, int) else col(n)  # a name, number or Column
    k = F.pmod(n, F.size(a)).cast("int")
    return F.concat(F.slice(a, F.size(a) - k + 1, k), F.slice(a, 1, F.size(a) - k))


def steps(a) -> Column:
    """Absolute differences of neighbours."""
    a = col(a)
    return F.zip_with(F.slice(a, 2, F.size(a) - 1), F.slice(a, 1, F.size(a) - 1), lambda y, x: F.abs(y - x))


def running_mean(a, n: int) -> Column:
    """Trailing mean of n samples; n - 1 shorter than the trace."""
    a = col(a)
    return F.transform(F.sequence(F.lit(1), F.size(a) - n + 1), lambda i: F.try_divide(total(F.slice(a, i, n)), F.lit(float(n))))


def signal_to_noise(a, noise: int) -> Column:
    """Each sample in decibels over the root mean square of the first `noise` samples."""
    a = col(a)
    head = F.slice(a, 1, noise)
    rms = F.sqrt(F.aggregate(head, F.lit(0.0), lambda s, x: s + x * x) / F.size(head))
    return F.transform(a, lambda x: F.when(x == 0, F.lit(float("-inf"))).otherwise(20 * F.log10(F.abs(x) / rms)))


def first_above(a, limit) -> Column:
    """Index of the first sample above the limit, null if none is."""
    return F.array_min(F.filter(F.transform(col(a), lambda x, i: F.when(x > limit, i)), lambda i: i.isNotNull()))


def coarse_pick(a, shift, noise_scale: float = 1.0, skip: int = 20, reach: int = 1000, tail: int = 1000) -> Column:
    """First step, from `skip` past the shift on, above a share of the noise that falls from 1.0 by tenths until one is found; null if none is."""
    low = (F.lit(shift) if isinstance(shift, int) else col(shift)) + skip

    def window(d: Column) -> Column:
        noise = F.sqrt(variance(F.slice(d, F.greatest(F.size(d) - tail + 1, F.lit(1)), tail))) * noise_scale
        return F.struct(F.slice(d, low + 1, reach).alias("w"), noise.alias("noise"))

    def limited(x: Column) -> Column:
        """The first share that the largest step is above is the one at which a step is found."""
        most = F.array_max(x["w"])
        return F.struct(x["w"].alias("w"), F.coalesce(*(F.when(most > x["noise"] * (t / 10.0), x["noise"] * (t / 10.0)) for t in range(10, 0, -1))).alias("limit"))

    found = let(let(let(steps(a), window), limited), lambda x: first_above(x["w"], x["limit"]))
    return (found + low).cast("int")


def threshold_pick(a, skip: int = 128, noise: int = 128, scale: float = 4.5) -> Column:
    """First step past `skip` samples above `scale` standard deviations of the first `noise` steps; the largest step if none is."""
    d = steps(a)
    limit = F.sqrt(variance(F.slice(d, 1, noise))) * scale
    window = F.slice(d, skip + 1, F.greatest(F.size(d) - skip, F.lit(0)))
    return (F.coalesce(first_above(window, limit), argmax(window)) + skip).cast("int")


def surface_pick(a, threshold: float, noise_from: int, noise_to: int) -> Column:
    """Index of the largest magnitude if it is `threshold` times the mean noise or more, else null."""
    m = F.transform(col(a), lambda x: F.abs(x))
    noise = mean(F.slice(m, noise_from + 1, noise_to - noise_from))
    return F.when(F.array_max(m) >= threshold * noise, argmax(m))


def echoes(a, mode: str, threshold_db: float = 0.0) -> Column:
    """Indices of the maximum, or of all samples within threshold_db (negative) of it."""
    a = col(a)
    if mode == "maximum":
        return F.array(argmax(a))
    return F.filter(F.transform(a, lambda x, i: F.when(x >= F.array_max(a) + threshold_db, i)), lambda i: i.isNotNull())


def shifted_difference(a, b, lag: int, circular: bool) -> Column:
    """Mean absolute difference of a and b shifted by lag >= 0; over the overlap if not circular."""
    a, b = col(a), col(b)
    x, y = (a, roll(b, lag)) if circular else (F.slice(a, lag + 1, F.size(a) - lag), F.slice(b, 1, F.size(b) - lag))
    return mean(F.zip_with(x, y, lambda p, q: F.abs(p - q)))


def unpack4(packed) -> Column:
    """Two signed 4-bit samples of each byte, high half first, as integers."""
    sign = lambda x: F.when(x > 7, x - 16).otherwise(x)
    byte = lambda i: F.conv(F.hex(F.substring(col(packed), i, 1)), 16, 10).cast("int")
    return F.flatten(F.transform(F.sequence(F.lit(1), F.octet_length(col(packed))), lambda i: F.array(sign(F.shiftright(byte(i), 4)), sign(byte(i).bitwiseAND(15)))))


def mad(a) -> Column:
    """Median absolute deviation from the median; the median of an even number is the mean of the middle two."""

    def median(x: Column) -> Column:
        n = F.size
        return let(F.array_sort(x), lambda s: (F.get(s, F.floor((n(s) - 1) / 2).cast("int")) + F.get(s, F.floor(n(s) / 2).cast("int"))) / 2)

    return let(col(a), lambda v: let(median(v), lambda middle: median(F.transform(v, lambda x: F.abs(x - middle)))))


def best_lag(a, b, reach: int) -> Column:
    """Struct lag, residual: the circular shift of b within reach, least first among equals, whose difference from a has the least median absolute deviation."""
    a, b = col(a), col(b)
    at = lambda lag: F.struct(mad(F.transform(a, lambda x, i: x - F.get(b, F.pmod(i - lag, F.size(b)).cast("int")))).alias("residual"), lag.alias("lag"))
    best = F.array_min(F.transform(F.sequence(F.lit(-reach), F.lit(reach)), at))
    return F.struct(best["lag"].alias("lag"), best["residual"].alias("residual"))


def unpack6(packed) -> Column:
    """Four signed 6-bit samples of each three bytes, high bits first, as integers; bytes past the last three whole ones are left out."""
    sign = lambda x: F.when(x > 31, x - 64).otherwise(x)
    three = lambda i: F.conv(F.hex(F.substring(col(packed), i * 3 + 1, 3)), 16, 10).cast("int")
    groups = F.floor(F.octet_length(col(packed)) / 3).cast("int")
    four = lambda i: F.array(*(sign(F.shiftright(three(i), s).bitwiseAND(63)) for s in (18, 12, 6, 0)))
    return F.when(groups > 0, F.flatten(F.transform(F.sequence(F.lit(0), groups - 1), four))).otherwise(F.array().cast("array<int>"))


def standardised(a) -> Column:
    """Less the mean and over the standard deviation of the population; zeros for a constant."""
    return let(F.struct(mean(a).alias("m"), F.sqrt(variance(a)).alias("s")), lambda z: F.transform(col(a), lambda x: F.coalesce(F.try_divide(x - z["m"], z["s"]), F.lit(0.0))))


def correlation(a, b) -> Column:
    """Pearson's coefficient of two traces; null if one is constant."""
    a, b = col(a), col(b)
    centred = lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), mean(x["a"]).alias("ma"), mean(x["b"]).alias("mb"))
    parts = lambda x: F.aggregate(F.arrays_zip(x["a"].alias("p"), x["b"].alias("q")), F.struct(F.lit(0.0).alias("pq"), F.lit(0.0).alias("pp"), F.lit(0.0).alias("qq")), lambda s, z: F.struct((s["pq"] + (z["p"] - x["ma"]) * (z["q"] - x["mb"])).alias("pq"), (s["pp"] + (z["p"] - x["ma"]) * (z["p"] - x["ma"])).alias("pp"), (s["qq"] + (z["q"] - x["mb"]) * (z["q"] - x["mb"])).alias("qq")))
    both = F.struct(a.alias("a"), b.alias("b"))
    return let(let(let(both, centred), parts), lambda s: F.try_divide(s["pq"], F.sqrt(s["pp"] * s["qq"])))
