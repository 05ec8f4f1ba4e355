"""Bounded searches without derivatives for what an ionosphere did to traces: all traces of a chunk are searched together, each from its own seed, so that chunks don't change the result."""

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import CHIRP_S, HIGH_HZ, LOW_HZ, SAMPLE_S, TEC_PER_E, band_window

#: Starts spread over the bounds, how many of them are followed down, hops after them, and steps of the local search.
STARTS, FOLLOWED, HOPS, STEPS = 64, 6, 8, 40
GOLDEN = (5**0.5 - 1) / 2


def uniform(seeds: np.ndarray, no: int) -> np.ndarray:
    """The no-th number in [0, 1) of each seed."""
    with np.errstate(over="ignore"):
        x = seeds.astype(np.uint64) + np.uint64(no + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53


def descended(f: Callable[[np.ndarray], np.ndarray], low: np.ndarray, high: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The least value of f between low and high by golden sections: where it is and what. f has one minimum there, or one of them is found."""
    a, d = low.copy(), high.copy()
    b, c = d - GOLDEN * (d - a), a + GOLDEN * (d - a)
    fb, fc = f(b), f(c)
    for _ in range(steps):
        left = fb <= fc
        a, d = np.where(left, a, b), np.where(left, c, d)
        new = np.where(left, d - GOLDEN * (d - a), a + GOLDEN * (d - a))
        value = f(new)
        b, c, fb, fc = np.where(left, new, c), np.where(left, b, new), np.where(left, value, fc), np.where(left, fb, value)
    return np.where(fb <= fc, b, c), np.minimum(fb, fc)


def minimise(f: Callable[[np.ndarray], np.ndarray], low: float, high: float, seeds: np.ndarray, starts: int = STARTS, hops: int = HOPS, temperature: float = 0.05, share: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Basin hopping in one bounded variable for many functions together: f takes a value for each and gives theirs. Where each is least, and the least value.

    A function is looked at on the bounds and once in each of `starts` equal parts between them, and followed down from the best FOLLOWED of these that are no higher than their neighbours, and from further ones while `share` of their value, the least that there may be near them, is below what was found. Then each hop goes to a uniform place within a quarter of the bounds, is followed down, and is kept if it is lower, or by chance if hardly higher (the temperature is relative to the least value). Hops beyond the bounds are refused. A minimum narrower than a part may be missed.
    """
    n, part = len(seeds), (high - low) / starts
    tried = np.stack([*(np.full(n, float(x)) for x in (low, high)), *(low + (i + uniform(seeds, i)) * part for i in range(starts))])
    values = np.stack([f(x) for x in tried])
    x, value = np.full(n, low, float), np.full(n, np.inf)
    in_order = np.concatenate(([0], np.arange(2, starts + 2), [1]))
    tried, values = tried[in_order], values[in_order]
    around = np.pad(values, ((1, 1), (0, 0)), constant_values=np.inf)
    pits = np.where((values <= around[:-2]) & (values <= around[2:]), values, np.inf)
    for no, at in enumerate(np.argsort(pits, axis=0, kind="stable")):
        there = pits[at, np.arange(n)]
        if not (np.isfinite(there) if no < FOLLOWED else share * there < value).any():
            break
        near = tried[at, np.arange(n)]
        to, reached = descended(f, np.maximum(near - part, low), np.minimum(near + part, high))
        x, value = np.where(reached < value, to, x), np.minimum(reached, value)
    best, least = x.copy(), value.copy()
    for hop in range(hops):
        to = x + (uniform(seeds, starts + 2 * hop) - 0.5) * (high - low) / 2
        inside = (to >= low) & (to <= high)
        to, reached = descended(f, np.clip(to - part, low, high), np.clip(to + part, low, high))
        chance = np.exp(-np.maximum(reached - value, 0) / np.maximum(temperature * np.abs(least), 1e-300))
        go = inside & (uniform(seeds, starts + 2 * hop + 1) < chance)
        x, value = np.where(go, to, x), np.where(go, reached, value)
        lower = value < least
        best, least = np.where(lower, x, best), np.where(lower, value, least)
    return best, least


def _measure(name: str, noise: int) -> Callable[[np.ndarray], np.ndarray]:
    """What is to be small: the inverse of the highest sample's power, or the noise's variance over it."""
    if name == "peak":
        return lambda traces: 1 / np.maximum((np.abs(traces) ** 2).max(1), 1e-300)
    if name == "signal_to_noise":
        return lambda traces: np.var(traces[:, :noise], axis=1) / np.maximum((np.abs(traces) ** 2).max(1), 1e-300)
    raise ValueError(f"no such measure: {name}")


def chirp_spectra(samples: int, electrons: np.ndarray) -> np.ndarray:
    """Spectra of the chirp, right-aligned and time-reversed, after ionospheres of those electron contents."""
    t = np.arange(0, CHIRP_S, SAMPLE_S)[:samples]
    rate = (HIGH_HZ - LOW_HZ) / CHIRP_S
    angle = 2 * np.pi * (LOW_HZ * t + rate / 2 * t * t) - electrons[:, None] * (LOW_HZ + rate * t) ** -1.93
    padded = np.zeros((len(electrons), samples), complex)
    padded[:, samples - len(t) :] = 1j * np.exp(1j * angle)
    return np.fft.fft(padded[:, ::-1])


def _searched(df: DataFrame, key: str, chunk: str, order: str, arrays: list[str], run: Callable, extra: str) -> DataFrame:
    """run(matrices, seeds) for each chunk, with traces in order; gives columns of `extra` by name. A seed is a hash of key and order."""
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.select(key, chunk, order, *(F.col(a).cast("array<double>").alias(a) for a in arrays), F.xxhash64(key, order).alias("seed_"))

    def each(t: pa.Table) -> pa.Table:
        t = t.sort_by(order).combine_chunks()
        data = [t[a].chunk(0).flatten().to_numpy().reshape(t.num_rows, -1) for a in arrays]
        made = run(*data, t["seed_"].to_numpy().view(np.uint64))
        columns = {c: t[c] for c in (key, chunk, order)}
        for name, x in made.items():
            columns[name] = pa.array(x) if x.ndim == 1 else pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        return pa.table(columns)

    return rows.groupBy(key, chunk).applyInArrow(each, ", ".join([*(f"{c} {kind[c]}" for c in (key, chunk, order)), extra]))


def undispersed(df: DataFrame, key: str, chunk: str, order: str, re: str, im: str, phases: list[float], low: float, high: float, measure: str = "peak", noise: int = 266) -> DataFrame:
    """key, chunk, order, dispersion, peak: for each spectrum (re, im) the a within the bounds for which turning its bins by a * phases gives the best pulse, and that pulse's highest magnitude times the number of bins. Found to 1e-7 of the bounds.

    A pulse varies with a no faster than the spread of the phases does: a start within d of the best one has cos(d * spread / 2) of its magnitude or more. So many starts are taken, and all followed that may lie by the best.
    """
    turn, small = np.asarray(phases, float), _measure(measure, noise)
    spread = (turn.max() - turn.min()) * (high - low)
    starts = max(STARTS, math.ceil(spread / 0.4))
    share = math.cos(spread / starts / 2) ** 2 if measure == "peak" else 1.0

    def run(re_, im_, seeds):
        spectrum = re_ + 1j * im_
        pulses = lambda a: np.fft.ifft(spectrum * np.exp(1j * a[:, None] * turn))
        a, _ = minimise(lambda a: small(pulses(a)), low, high, seeds, starts, share=share)
        return {"dispersion": a, "peak": np.abs(pulses(a)).max(1) * spectrum.shape[1]}

    return _searched(df, key, chunk, order, [re, im], run, "dispersion double, peak double")


def ionosphere(df: DataFrame, key: str, chunk: str, order: str, samples: str, most: float = 1e16 / TEC_PER_E, measure: str = "signal_to_noise", noise: int = 266, filtered: bool = True, together: bool = True) -> DataFrame:
    """key, chunk, order, electron, chunk_electron, delay_s, re, im: traces compressed with the electron content, from 0 to `most`, that does best.

    electron is a trace's own best; chunk_electron is the chunk's mean of these, with which all its traces are compressed, or with together=False the trace's own. delay_s: the delay at 20 MHz that goes with it. measure: 'signal_to_noise' (of the highest sample over the first `noise`) or 'peak'.
    """
    small = _measure(measure, noise)

    def run(data, seeds):
        spectrum = np.fft.fft(data) * (band_window(data.shape[1]) if filtered else 1.0)
        made = lambda e: np.fft.ifft(spectrum * chirp_spectra(data.shape[1], e).conj())
        own, _ = minimise(lambda e: small(made(e)), 0.0, most, seeds)
        used = np.full(len(own), own.mean()) if together else own
        out = made(used)
        return {"electron": own, "chunk_electron": used, "delay_s": used * 20e6**-1.93 / (2 * np.pi * 20e6), "re": out.real, "im": out.imag}

    return _searched(df, key, chunk, order, [samples], run, "electron double, chunk_electron double, delay_s double, re array<double>, im array<double>")
