"""Two antennas over the same ground: co-registration, multilook interferograms, phases off nadir.

Complex traces are pairs of arrays re, im. All but co-registration are DataFrame code.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import number, signal, traces
from .aggregates import coherence, fresnel_stack
from .joins import interpolated
from .kernels import delayed, upsampled
from .windows import CHUNK, neighbours


def looks(df: DataFrame, key: str, order: str, a: tuple[str, str], b: tuple[str, str], width: int, smooth: int = 2, roll_phase: str | None = None) -> DataFrame:
    """key, look, k, phase, correlation: the interferogram a conj(b) and its coherence, over looks of `width` traces (made odd) and running means of `smooth` samples.

    An incomplete last look goes, as do the last smooth - 1 samples. roll_phase, a column of phases, is averaged over the look and added. Width 1 takes the samples as they are, without smoothing.
    """
    width = max(1, width - 1 + width % 2)
    smooth = smooth if width > 1 else 1
    (ar, ai), (br, bi) = a, b
    zip2 = lambda p, q, r, s, sign: F.zip_with(F.zip_with(p, q, lambda x, y: x * y), F.zip_with(r, s, lambda x, y: x * y), lambda x, y: x + sign * y)
    mean = lambda x: traces.running_mean(x, smooth)
    parts = {"re": zip2(ar, br, ai, bi, 1), "im": zip2(ai, br, ar, bi, -1), "pa": zip2(ar, ar, ai, ai, 1), "pb": zip2(br, br, bi, bi, 1)}
    rows = df.select(key, F.floor(F.col(order) / width).alias("look"), number(roll_phase or F.lit(0.0)).alias("roll_"), *(x.alias(f"{n}_") for n, x in parts.items()))
    rows = rows.withColumns({f"{n}_": mean(f"{n}_") for n in parts}).select(key, "look", "roll_", F.posexplode(F.arrays_zip(*(f"{n}_" for n in parts))).alias("k", "z"))
    share = F.try_divide(F.hypot("z.re_", "z.im_"), F.sqrt(F.col("z.pa_") * F.col("z.pb_")))
    out = rows.groupBy(key, "look", "k").agg(F.count("*").alias("n_"), F.avg("z.re_").alias("re_"), F.avg("z.im_").alias("im_"), F.avg(share).alias("correlation"), F.avg("roll_").alias("roll_"))
    return out.where(F.col("n_") == width).select(key, "look", "k", (F.atan2("im_", "re_") + F.col("roll_")).alias("phase"), "correlation")


def normalised(phases: DataFrame, surface: DataFrame, key: str) -> DataFrame:
    """phases (key, look, k, phase) less the phase at the surface, whose sample is k of `surface` (key, look, k).

    Between looks that have a surface its sample is interpolated and cut to a whole number; outside them the nearest counts. A product without a surface goes.
    """
    at = phases.groupBy(key, "look").agg(F.lit(1).alias("one_")).drop("one_").join(surface.select(key, "look", F.struct(number("look").alias("x"), number("k").alias("y")).alias("s_")), [key, "look"], "left")
    at = neighbours(at, key, "look", "s_", "lo_", "hi_")
    lo, hi = F.coalesce("lo_", "hi_"), F.coalesce("hi_", "lo_")
    place = lo["y"] + F.coalesce(F.try_divide(F.col("look") - lo["x"], hi["x"] - lo["x"]), F.lit(0.0)) * (hi["y"] - lo["y"])
    at = at.select(key, "look", F.floor(place).alias("k"))
    level = phases.join(at, [key, "look", "k"]).select(key, "look", F.col("phase").alias("level_"))
    return phases.join(level, [key, "look"]).withColumn("phase", F.col("phase") - F.col("level_")).drop("level_")


def off_nadir_phase(surface, feature, roll, baseline: float, wavelength: float, offset: float = 0.0) -> Column:
    """Phase that clutter at the surface would have if it echoed at sample `feature` under a surface at sample `surface`, both less `offset`; roll in radians. Null for an echo above the surface."""
    ratio = F.try_divide(number(surface) - offset, number(feature) - offset)
    angle = F.when(F.abs(ratio) <= 1, F.acos(ratio))
    return -2 * math.pi * baseline / wavelength * F.sin(angle - number(roll))


def phase_density(phase, centre, correlation: float, looks: float, terms: int = 400) -> Column:
    """Density of the phase of an interferogram of so many looks, at a correlation below 1: a hypergeometric series, summed after Euler's transformation, in which it converges for all phases."""
    n, g = float(looks), float(correlation)
    beta = g * F.cos(number(phase) - number(centre))
    z = beta * beta
    step = lambda s, i: F.struct((s["sum"] + s["term"]).alias("sum"), (s["term"] * z * (i - 0.5) * (i + 0.5 - n) / ((i + 0.5) * (i + 1.0))).alias("term"))
    series = F.aggregate(F.sequence(F.lit(0), F.lit(terms - 1)), F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).cast("double").alias("term")), step, lambda s: s["sum"])
    even = (1 - g * g) ** n / (2 * math.pi) * series
    odd = math.exp(math.lgamma(n + 0.5) - math.lgamma(n)) / (2 * math.sqrt(math.pi)) * (1 - g * g) ** n * beta
    return (even + odd) * F.pow(1 - z, F.lit(-n - 0.5))


def roll_along(traces_: DataFrame, navigation: DataFrame, key: str, time: str, distance: str, roll: str, shift_deg: float = 0.0) -> DataFrame:
    """key, metre, roll (radians): navigation's roll (degrees, by time) at each trace, then at each whole metre of the traces' distance. Outside either the end values hold. traces_: key, time, distance; navigation: key, time, roll."""
    nav = navigation.select(key, number(time).alias("t"), number(roll).alias("v"))
    at = interpolated(traces_.select(key, number(time).alias("at"), number(distance).alias("d")), nav, key, "at", "t", "v", "roll", hold=True)
    ends = at.groupBy(key).agg(F.floor(F.min("d")).alias("lo_"), F.ceil(F.max("d")).alias("hi_")).where("hi_ > lo_")
    metres = ends.select(key, F.explode(F.sequence(F.col("lo_"), F.col("hi_") - 1)).alias("metre"))
    out = interpolated(metres, at.select(key, F.col("d").alias("t"), F.col("roll").alias("v")), key, "metre", "t", "v", "roll", hold=True)
    return out.select(key, "metre", F.radians(F.col("roll") + shift_deg).alias("roll"))


def chirp_stability(df: DataFrame, key: str, order: str, samples: str, reach: int) -> DataFrame:
    """df with lag: by how many samples, from -reach to reach - 1, a loop-back chirp in decibels has to be rolled to correlate best, with either sign, with the product's first; the least of equals."""
    first = df.groupBy(key).agg(F.min_by(samples, order).alias("first_"))
    level = lambda c: F.transform(c, lambda x: signal.decibel(F.abs(x.cast("double"))))
    lags = F.sequence(F.lit(-reach), F.lit(reach - 1))
    rows = df.join(first, key).withColumns({"a_": level("first_"), "b_": level(samples)})
    fit = F.transform(lags, lambda lag: F.struct((-F.abs(traces.correlation(F.col("a_"), traces.roll(F.col("b_"), lag)))).alias("c"), lag.alias("lag")))
    return rows.withColumn("lag", F.array_min(fit)["lag"]).drop("first_", "a_", "b_")


def power_image(df: DataFrame, key: str, order: str, a: tuple[str, str], b: tuple[str, str], width: int, mode: str = "averaged") -> DataFrame:
    """key, stack, k, power: magnitude in dB of a conj(b), summed or averaged over stacks of traces `width` apart (made odd; the last of an odd width's traces is left out). a and b: columns of magnitudes (dB) and phases, arrays of samples. 'averaged' divides the sum by the width."""
    width = max(1, width - 1 + width % 2)
    rows = df.select(key, order, F.posexplode(F.zip_with(a[0], b[0], lambda x, y: x.cast("double") + y)).alias("k", "x_"))  # magnitudes multiply, phases only turn
    if width == 1:
        return rows.select(key, F.col(order).alias("stack"), "k", F.col("x_").alias("power"))
    out = fresnel_stack(rows, [key, "k"], order, "x_", width)
    return out.select(key, "stack", "k", (F.col("total") / width if mode == "averaged" else F.col("total")).alias("power"))


def pixel_coherence(cells: DataFrame, key: str, order: str, re: str, im: str, reach: int) -> DataFrame:
    """key, k, lag, coherence of each row of samples with itself rolled by 0 to reach traces. cells: key, order (from 0 without gaps), k, re, im."""
    n = cells.groupBy(key, "k").agg(F.count("*").alias("n_"))
    rolled = cells.join(n, [key, "k"]).select(key, "k", F.explode(F.sequence(F.lit(0), F.lit(reach))).alias("lag"), "n_", order, F.col(re).alias("re2_"), F.col(im).alias("im2_"))
    rolled = rolled.withColumn(order, F.pmod(F.col(order) + F.col("lag"), F.col("n_"))).drop("n_")
    return coherence(cells.select(key, "k", order, re, im).join(rolled, [key, "k", order]), [key, "k", "lag"], re, im, "re2_", "im2_").drop("phase")


def feature(image: DataFrame, mask: DataFrame, keys: list[str], picked: str) -> DataFrame:
    """Cells of an image at which a mask with the same keys is 1."""
    return image.join(mask.where(F.col(picked) == 1).select(*keys).distinct(), keys, "left_semi")


def picked_length(mask: DataFrame, key: str, order: str, picked: str) -> DataFrame:
    """key and the number of traces with a cell of 1."""
    return mask.where(F.col(picked) == 1).groupBy(key).agg(F.countDistinct(order).alias("length"))


def phase_differences(df: DataFrame, name: str, keys: list[str], phase: str, baseline: str | None = None) -> DataFrame:
    """first, second, keys and the wrapped difference (second less first) of interferograms by name: all pairs in order of name, or all others against a baseline. Names are few."""
    one, two = (df.select(F.col(name).alias(n), *keys, number(phase).alias(f"{n}_p")) for n in ("first", "second"))
    pairs = F.col("first") < F.col("second") if baseline is None else (F.col("first") == baseline) & (F.col("second") != baseline)
    return one.join(two, keys).where(pairs).select("first", "second", *keys, signal.wrap_phase(F.col("second_p") - F.col("first_p")).alias("difference"))


def _offset(a: np.ndarray, b: np.ndarray, factor: int, reach: int, zero_mean: bool, subsample: bool, levelled: bool = False) -> tuple[float, float]:
    """Shift of b, in finer samples, that fits a best within reach, and the peak of their correlation over its mean. levelled: over the root of the energy of a's part that b lies on."""
    a, b = upsampled(a[None], factor)[0], upsampled(b[None], factor)[0]
    if zero_mean:
        a, b = ((x - x.mean()) / (x.std() or 1.0) for x in (a, b))
    core = b[reach : len(b) - reach + 1]
    n = 1 << (len(a) + len(core)).bit_length()
    full = np.fft.ifft(np.fft.fft(a, n) * np.conj(np.fft.fft(core, n)))
    rho = np.abs(full[: len(a) - len(core) + 1])
    if levelled:
        energy = np.concatenate(([0.0], np.cumsum(np.abs(a) ** 2)))
        part = energy[len(core) :] - energy[: len(rho)]
        rho = rho / np.sqrt(np.maximum(part, 1e-12 * energy[-1] or 1.0))
    i = int(rho.argmax())
    place, peak = 0.0, rho[i]
    if subsample and 2 <= i <= len(rho) - 3:
        place, peak = _vertex(rho[i - 2 : i + 3])
    return i + place - reach, float(peak / (rho.mean() or 1.0))


def _vertex(y: np.ndarray) -> tuple[float, float]:
    """Place and height of the top of the parabola that fits five samples best."""
    c, b, a = np.polynomial.polynomial.polyfit(np.arange(-2.0, 3.0), y, 2)
    return (-b / (2 * a), c - b * b / (4 * a)) if a else (0.0, float(y[2]))


def coregister(df: DataFrame, key: str, order: str, a: tuple[str, str], b: tuple[str, str], factor: int = 10, reach: int = 300, zero_mean: bool = False, subsample: bool = False, adaptive: bool = False, quality: float = 4.0, most: int = 16, levelled: bool = False) -> DataFrame:
    """key, order, shift (samples of b to the right, found on traces `factor` times as fine, within `reach` fine samples), quality (peak of the correlation over its mean), b_re and b_im (b so shifted).

    adaptive: a trace below `quality` takes in its neighbours, one more on each side at a time, up to `most` - 1. Chunks of a product carry that many neighbours along. levelled: a part of a with more energy doesn't draw b to it; a copy of a is then found where it lies.
    """
    halo = most - 1 if adaptive else 0
    rows = df.select(key, order, *(F.col(c).cast("array<double>").alias(n) for c, n in zip((*a, *b), ("ar_", "ai_", "br_", "bi_"), strict=True)))
    rows = rows.withColumn("chunk_", F.explode(F.sequence(F.floor((F.col(order) - halo) / CHUNK), F.floor((F.col(order) + halo) / CHUNK))))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        x, y = (np.stack(pdf[re].to_numpy()) + 1j * np.stack(pdf[im].to_numpy()) for re, im in (("ar_", "ai_"), ("br_", "bi_")))
        own = np.flatnonzero(pdf[order].to_numpy() // CHUNK == pdf["chunk_"].iloc[0])
        found = []
        for i in own:
            for more in range(halo + 1):
                side = slice(max(0, i - more), i + more + 1)
                best = _offset(x[side].sum(axis=0), y[side].sum(axis=0), factor, reach, zero_mean or more > 0, subsample, levelled)
                if best[1] >= quality:
                    break
            found.append(best)
        shift = np.array([f[0] for f in found]) / factor
        moved = delayed(y[own], shift) if len(own) else y[own]
        return pd.DataFrame({key: pdf[key].iloc[own], order: pdf[order].iloc[own], "shift": shift, "quality": [f[1] for f in found], "b_re": pd.Series(list(moved.real), pdf.index[own], object), "b_im": pd.Series(list(moved.imag), pdf.index[own], object)})

    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return rows.groupBy(key, "chunk_").applyInPandas(run, f"{key} {kind[key]}, {order} {kind[order]}, shift double, quality double, b_re array<double>, b_im array<double>")
