"""Matched-filter focusing, and delay-Doppler focusing on spherical geometry with the Doppler bin of each aperture.

Apertures are groups of their own: a trace goes to each aperture that holds it, and no product is gathered.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import nearest
from .kernels import HIGH_HZ, LIGHT, SAMPLE_S
from .windows import CHUNK


def opened(data: np.ndarray, delay_s: np.ndarray, sample_s: float = SAMPLE_S) -> np.ndarray:
    """Traces delayed by their spectra."""
    turn = np.exp(-2j * np.pi * delay_s[:, None] * np.fft.fftfreq(data.shape[1], sample_s))
    return np.fft.ifft(np.fft.fft(data) * turn)


def band(data: np.ndarray, high_hz: float, pass_hz: float, cut_hz: float, spacing: float, sample_s: float = SAMPLE_S) -> np.ndarray:
    """Traces by samples, filtered in both spectra: a Hann window from 0 to high_hz and its mirror image in fast time; along track all below pass_hz, with a cosine taper to cut_hz. spacing: along-track sample interval that the frequencies refer to."""
    m, n = data.shape
    width = min(int(math.floor(high_hz * sample_s * n + 0.5)), n // 2)
    across = np.zeros(n)
    across[:width] = np.hanning(width)
    across[n - width :] = np.hanning(width)
    f = np.abs(np.fft.fftfreq(m, spacing))
    along = np.where(f <= pass_hz, 1.0, np.where(f >= cut_hz, 0.0, 0.5 + 0.5 * np.cos(np.pi * (f - pass_hz) / max(cut_hz - pass_hz, 1e-30))))
    return np.fft.ifft2(np.fft.fft2(data) * along[:, None] * across)


def refracted(offset_m: np.ndarray, height_m: float, depth_m: np.ndarray, permittivity: float, rounds: int = 60) -> np.ndarray:
    """Where rays to points at depth_m under the origin cross a flat surface, for an antenna at height_m and offset_m (rows: offsets, columns: depths): Snell's law, bisected between the origin and the antenna."""
    far = np.abs(offset_m)[:, None] + np.zeros_like(depth_m)
    low, high = np.zeros_like(far), far.copy()
    for _ in range(rounds):
        s = (low + high) / 2
        inside, outside = math.sqrt(permittivity) * s / np.sqrt(s * s + depth_m**2), (far - s) / np.sqrt((far - s) ** 2 + height_m**2)
        more = inside < outside
        low, high = np.where(more, s, low), np.where(more, high, s)
    return np.sign(offset_m)[:, None] * (low + high) / 2


def path_excess(offset_m: np.ndarray, top_m: float, samples: int, surface: int, permittivity: float = 1.0, every: int = 1, sample_s: float = SAMPLE_S) -> np.ndarray:
    """Optical path of each trace of an aperture beyond that of its middle, for each sample. Below sample `surface` the ground's permittivity counts, refraction included; there every `every`-th sample is computed and held."""
    step = sample_s * LIGHT / 2
    r = top_m + np.arange(samples) * step
    out = np.sqrt(r**2 + offset_m[:, None] ** 2) - r
    if permittivity == 1 or surface + 1 >= samples:
        return out
    below = np.arange(surface + 1, samples)
    depth = (below[::every] - surface) * step / math.sqrt(permittivity)
    height = top_m + surface * step
    s = refracted(offset_m, height, depth, permittivity)
    excess = np.sqrt(height**2 + (offset_m[:, None] - s) ** 2) - height + math.sqrt(permittivity) * (np.sqrt(depth**2 + s**2) - depth)
    out[:, below] = np.repeat(excess, every, axis=1)[:, : len(below)]
    return out


def matched(data: np.ndarray, offset_m: np.ndarray, delay_s: np.ndarray, middle: int, opening_s: float, permittivity: float, every: int, pass_hz: float, aperture_m: float) -> np.ndarray:
    """One posting: align, filter, multiply the fast-time spectra by the matched filter, and take the zero-Doppler bin."""
    surface = int(np.abs(data[middle]).argmax())
    aligned = band(opened(data, delay_s - opening_s), 13e6, pass_hz, pass_hz + 0.1, 1000.0 / aperture_m)
    turn = np.exp(-1j * 4 * np.pi * HIGH_HZ / LIGHT * path_excess(offset_m, opening_s * LIGHT / 2, data.shape[1], surface, permittivity, every))
    return np.abs(np.fft.ifft(np.fft.fft(aligned) * turn).sum(axis=0)) / math.sqrt(len(data))


def _apertures(df: DataFrame, track_m: str, posting_m: float, aperture_m: float) -> DataFrame:
    half, at = aperture_m / 2, F.col(track_m)
    return df.withColumn("posting", F.explode(F.sequence(F.ceil((at - half) / posting_m), F.floor((at + half) / posting_m))))


def _kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def _complex(pdf: pd.DataFrame, re: str, im: str) -> np.ndarray:
    return np.stack(pdf[re].to_numpy()).astype(float) + 1j * np.stack(pdf[im].to_numpy()).astype(float)


def matched_filter(df: DataFrame, key: str, order: str, re: str, im: str, track_m: str, delay_s: str, posting_m: float, aperture_m: float, permittivity: float = 1.0, every: int = 1, pass_hz: float = 4.0) -> DataFrame:
    """key, posting, traces, sar: a row for every posting_m along track. delay_s: when a trace's receive window opens; the earliest of the product is the top of the image."""
    first = df.groupBy(key).agg(F.min(delay_s).alias("opening_"))
    rows = _apertures(df.select(key, order, re, im, track_m, delay_s), track_m, posting_m, aperture_m).join(first, key)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        place = pdf[track_m].to_numpy(float)
        middle = int(np.abs(place - pdf["posting"].iloc[0] * posting_m).argmin())
        sar = matched(_complex(pdf, re, im), place - place[middle], pdf[delay_s].to_numpy(float), middle, float(pdf["opening_"].iloc[0]), permittivity, every, pass_hz, aperture_m)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "posting": [pdf["posting"].iloc[0]], "traces": [len(pdf)], "sar": [sar]})

    return rows.groupBy(key, "posting").applyInPandas(run, f"{key} {_kinds(df)[key]}, posting long, traces long, sar array<double>")


def doppler_bin(distance_m: np.ndarray, rate_hz: float, frequency: float) -> int:
    """The bin of the Doppler shift at the middle of an aperture."""
    i = min(math.ceil(len(distance_m) / 2), len(distance_m) - 2)
    shift = -2 * frequency / LIGHT * (distance_m[i + 1] - distance_m[i]) * rate_hz
    return int(np.abs(np.fft.fftfreq(len(distance_m), 1 / rate_hz) - shift).argmin())


def spherical(data: np.ndarray, distance_m: np.ndarray, rate_hz: float, frequency: float, sample_s: float) -> np.ndarray:
    """One posting: range and azimuth migration relative to the middle of the aperture, and the bin of its Doppler shift in the spectrum along track."""
    n = len(data)
    away = distance_m - distance_m[min(math.ceil(n / 2), n - 1)]
    spectrum = np.fft.fft(data) * np.exp(2j * np.pi * (2 * away / LIGHT)[:, None] * np.fft.fftfreq(data.shape[1], sample_s))
    moved = np.fft.ifft(spectrum) * np.exp(-4j * np.pi * frequency / LIGHT * away)[:, None]
    return (np.fft.fft(moved, axis=0, norm="ortho") * np.fft.ifftshift(np.hanning(n))[:, None])[-doppler_bin(distance_m, rate_hz, frequency)] if n > 1 else moved[0]


def delay_doppler(df: DataFrame, key: str, order: str, re: str, im: str, track_m: str, lat: str, lon: str, radius_m: str, ground_m: str, posting_m: float, aperture_m: float, rate_hz: float = 175.0, frequency: float = HIGH_HZ, sample_s: float = SAMPLE_S) -> DataFrame:
    """key, posting, traces, re, im: complex focused traces, for each whole aperture. Traces come aligned (`opened`) and at even spacing (`windows.resampled`).

    radius_m, ground_m: of the spacecraft and of the surface below, from the centre of the body. Another instrument's frequency, rate and sample interval may be given.
    """
    ends = df.groupBy(key).agg(F.min(track_m).alias("from_"), F.max(track_m).alias("to_"))
    rows = _apertures(df.select(key, order, re, im, track_m, lat, lon, radius_m, ground_m), track_m, posting_m, aperture_m).join(ends, key)
    centre = F.col("posting") * posting_m
    rows = rows.where((centre - aperture_m / 2 >= F.col("from_")) & (centre + aperture_m / 2 <= F.col("to_"))).drop("from_", "to_")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        middle = int(np.abs(pdf[track_m].to_numpy(float) - pdf["posting"].iloc[0] * posting_m).argmin())
        p, q, r = np.radians(pdf[lat].to_numpy(float)), np.radians(pdf[lon].to_numpy(float)), pdf[radius_m].to_numpy(float)
        ground = float(pdf[ground_m].iloc[middle])
        cosine = np.cos(p) * np.cos(p[middle]) * np.cos(q - q[middle]) + np.sin(p) * np.sin(p[middle])
        out = spherical(_complex(pdf, re, im), np.sqrt(r**2 + ground**2 - 2 * r * ground * cosine), rate_hz, frequency, sample_s)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "posting": [pdf["posting"].iloc[0]], "traces": [len(pdf)], "re": [out.real], "im": [out.imag]})

    return rows.groupBy(key, "posting").applyInPandas(run, f"{key} {_kinds(df)[key]}, posting long, traces long, re array<double>, im array<double>")


def apertures(df: DataFrame, key: str, order: str, track_m: str, every: int, aperture_m: float) -> DataFrame:
    """key, first, middle, last: traces at the ends and the middle of apertures that lie within the product, whose middles are `every` traces apart; ends are the traces nearest to half an aperture away, the lower of two as near."""
    rows, half = df.select(key, order, F.col(track_m).cast("double").alias("d_")), aperture_m / 2
    end = rows.groupBy(key).agg(F.max_by("d_", order).alias("end_"))
    inner = rows.join(end, key).where((F.col("d_") >= half) & (F.col("d_") - F.col("end_") <= -half))
    first = inner.groupBy(key).agg(F.min(order).alias("lo_"), F.max(order).alias("hi_"))
    middles = inner.join(first, key).where((F.col(order) < F.col("hi_")) & ((F.col(order) - F.col("lo_")) % every == 0)).select(key, F.col(order).alias("middle"), (F.col("d_") - half).alias("from_"), (F.col("d_") + half).alias("to_"))
    for name, at in (("first", "from_"), ("last", "to_")):
        middles = nearest(middles, rows.select(key, "d_", F.col(order).alias(name)), key, at, "d_", name)
    return middles.select(key, "first", "middle", "last")


def doppler_looks(df: DataFrame, key: str, order: str, re: str, im: str, place: tuple[str, str, str], ground_m: str, opening: str, width: int, bins: int = 5, ways: int = 1, sample_s: float = SAMPLE_S, chunk: int = CHUNK) -> DataFrame:
    """key, order, bin, magnitude (array): for each trace the bins -bins to bins of the Doppler spectrum of the `width` + 1 traces around it (width is even), which are first shifted by whole samples to lie as if all were as far from the ground below it.

    place: of the spacecraft, in metres from the centre; ground_m: radius of the ground below; opening: of the receive window, in samples. ways: how often the difference in distance counts, 1 as in the archive's processor, 2 for the way there and back. Traces beyond a product's ends are silent. order counts without gaps. Chunks of a product carry width / 2 traces along on either side, so that no trace is sent once for each aperture that it is in.
    """
    half = width // 2
    rows = df.select(key, order, *(F.col(c).cast("array<double>").alias(n) for c, n in ((re, "re_"), (im, "im_"))), *(F.col(c).cast("double").alias(n) for c, n in zip((*place, ground_m, opening), ("x_", "y_", "z_", "g_", "o_"), strict=True)))
    rows = rows.withColumn("chunk_", F.explode(F.sequence(F.floor((F.col(order) - half) / chunk), F.floor((F.col(order) + half) / chunk))))
    turn = np.exp(-2j * np.pi * np.arange(-bins, bins + 1)[:, None] * np.arange(2 * half + 1) / (2 * half + 1))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by(order).combine_chunks()
        at, no = t[order].to_numpy(), t["chunk_"][0].as_py()
        data = np.stack([t[c].chunk(0).flatten().to_numpy().reshape(len(at), -1) for c in ("re_", "im_")])
        data = data[0] + 1j * data[1]
        position, n = np.stack([t[c].to_numpy() for c in ("x_", "y_", "z_")], 1), data.shape[1]
        own = np.flatnonzero(at // chunk == no)
        out = np.zeros((len(own), 2 * bins + 1, n))
        for row, i in enumerate(own.tolist()):
            there = np.arange(max(0, i - half), min(len(at), i + half + 1))
            there = there[np.abs(at[there] - at[i]) <= half]
            below = position[i] * (t["g_"][i].as_py() / np.linalg.norm(position[i]))
            away = np.abs(np.linalg.norm(position[there] - below, axis=1) - np.linalg.norm(position[i] - below))
            late = ways * away / LIGHT / sample_s - t["o_"].to_numpy()[there] + t["o_"][i].as_py()
            sample = np.trunc(np.arange(n) + late[:, None]).astype(int)
            inside = (sample >= 0) & (sample < n)
            lie = np.where(inside, np.take_along_axis(data[there], np.clip(sample, 0, n - 1), 1), 0)
            out[row] = np.abs(turn[:, at[there] - at[i] + half] @ lie)
        many = 2 * bins + 1
        pick = pa.array(np.repeat(own, many))
        return pa.table({key: t[key].take(pick), order: t[order].take(pick), "bin": np.tile(np.arange(-bins, bins + 1, dtype=np.int32), len(own)), "magnitude": pa.ListArray.from_arrays(pa.array(np.arange(len(own) * many + 1, dtype=np.int32) * n), pa.array(out.ravel()))})

    kind = _kinds(df)
    return rows.groupBy(key, "chunk_").applyInArrow(run, f"{key} {kind[key]}, {order} {kind[order]}, bin int, magnitude array<double>")
