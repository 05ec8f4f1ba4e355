"""Electron content of the ionosphere from two sounders at different frequencies over the same ground.

Picks are samples of the surface echo, null where there is none. A group (of like solar zenith angle) of either sounder is a bounded sample of picks: sampled() sees to that.
"""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import number, time
from .kernels import TEC_PER_E, _traces

#: The lower sounder's centre frequencies in MHz by band code for either channel, its clocks, the higher sounder's frequency and sample time, and the constant of the group delay.
BANDS_MHZ = {"1": (4.0, 1.8, 3.0, 5.0), "2": (1.8, 4.0, 3.0, 5.0)}
WINDOW_CLOCK, SAMPLE_CLOCK, SECOND_CHANNEL_S = 2.8e6, 1.4e6, 450e-6
HIGH_HZ, HIGH_SAMPLE_S = 20e6, 0.0375e-6
DELAY, LIGHT = 1.69e-6, 299792458.0


def frequency_hz(band: Column | str, channel: str) -> Column:
    """Null for another code."""
    return F.get(F.array(*(F.lit(f * 1e6) for f in BANDS_MHZ[channel])), F.col(band) if isinstance(band, str) else band)


def muted(pick: Column | str, band: Column | str, keep_mhz: tuple[float, ...], channel: str) -> Column:
    """The pick, or null where its band isn't to be kept. A band of another code stays."""
    f = frequency_hz(band, channel)
    pick = F.col(pick) if isinstance(pick, str) else pick
    return F.when(f.isNull() | f.isin(*(x * 1e6 for x in keep_mhz)), pick)


def low_time(window, pick, channel: str) -> Column:
    """Seconds to the lower sounder's echo: window opening in its clock's ticks, pick in samples."""
    late = SECOND_CHANNEL_S if channel == "2" else 0.0
    return number(window) / WINDOW_CLOCK - late + number(pick) / SAMPLE_CLOCK


def high_time(window_s, pick) -> Column:
    return number(window_s) + number(pick) * HIGH_SAMPLE_S


def sampled(df: DataFrame, group: str, pick: str, n: int | DataFrame, seed: int = 1) -> DataFrame:
    """n picked rows of each group, by a hash of the row; with a frame of group and n, as many as it says. All where there are fewer."""
    rows = df.where(F.col(pick).isNotNull())
    turn = Window.partitionBy(group).orderBy(F.xxhash64(F.lit(seed), *df.columns), *df.columns)
    rows = rows.withColumn("turn_", F.row_number().over(turn))
    if isinstance(n, int):
        return rows.where(F.col("turn_") <= n).drop("turn_")
    return rows.join(n.select(group, F.col("n").alias("n_")), group).where(F.col("turn_") <= F.col("n_")).drop("turn_", "n_")


def electron_content(high: DataFrame, low: DataFrame, group: str, channel: str, known: float = 0.0, most: int = 1000) -> DataFrame:
    """group, high_id, low_id, tec (per square metre): one for each pick of the higher with each of the lower sounder in a group, beyond the content `known` from a step before. Of a group with more than `most` picks of a sounder so many are drawn, by a hash of the row.

    high: group, id, time (s), altitude (km), height (m); low: these and band. Rows without a time don't count.
    """
    f = frequency_hz("l.band", channel)
    df = 1 / (f * f) - 1 / (HIGH_HZ * HIGH_HZ)
    late = F.col("l.time") - F.col("h.time") - 2 / LIGHT * (F.col("l.height") - F.col("h.height") + 1000 * (F.col("l.altitude") - F.col("h.altitude")))
    tec = late / df * (2 * F.pi() / DELAY) - F.lit(float(known))
    high, low = (sampled(x, group, "time", most) for x in (high, low))
    pairs = high.alias("h").join(low.alias("l"), F.col(f"h.{group}") == F.col(f"l.{group}"))
    return pairs.select(F.col(f"h.{group}").alias(group), F.col("h.id").alias("high_id"), F.col("l.id").alias("low_id"), tec.alias("tec")).where("tec IS NOT NULL")


def altimetry_error(altitude_km, height_m, time_s, frequency, tecu) -> Column:
    """Distance to the ground in km by altitude and height, less that by the echo's time without the ionosphere's delay. Null without a pick."""
    f = number(frequency)
    flight = number(time_s) - DELAY * number(tecu) * 1e16 / (2 * F.pi() * f * f)
    return number(altitude_km) - number(height_m) / 1000 - LIGHT * flight / 2000


def by_martian_time(df: DataFrame, latitude: str, electron: str, at: str, south: float, north: float) -> DataFrame:
    """Rows from south to below north with tecu, mars_year and solar_longitude."""
    since = time.seconds_since_j2000(at)
    return df.where((F.col(latitude) >= south) & (F.col(latitude) < north)).withColumns({"tecu": number(electron) * TEC_PER_E, "mars_year": time.mars_year(since), "solar_longitude": time.solar_longitude(since)})


@dataclass(frozen=True)
class Chirp:
    """Centre frequency, sampling rate and bandwidth in Hz, length in seconds; early: the trace begins with the chirp, else it ends with it, in reverse."""

    centre_hz: float
    rate_hz: float
    length_s: float
    band_hz: float
    early: bool = True

    def times(self) -> np.ndarray:
        return np.arange(int(self.length_s * self.rate_hz + 1e-9)) / self.rate_hz

    def padded(self, x: np.ndarray, samples: int) -> np.ndarray:
        if len(x) > samples:
            raise ValueError(f"a chirp of {len(x)} samples in traces of {samples}")
        return np.concatenate((x, np.zeros(samples - len(x), x.dtype)) if self.early else (np.zeros(samples - len(x), x.dtype), x))

    def spectrum(self, samples: int) -> np.ndarray:
        """Of the reference, with unit norm."""
        t = self.times()
        low, slope = self.centre_hz - self.band_hz / 2, self.band_hz / self.length_s
        ref = self.padded(np.exp(2j * np.pi * (low * t + slope / 2 * t * t)), samples)
        return np.fft.fft(ref if self.early else ref[::-1], norm="ortho")

    def delay_phase(self, samples: int, content: float) -> np.ndarray:
        """Phase that an ionosphere of this content (per square metre) gives each bin."""
        frequency = self.centre_hz + self.band_hz / 2 - self.band_hz / self.length_s * self.times()
        return self.padded(-DELAY * content / frequency, samples)


def _complex(df: DataFrame, columns: list[str], re: str, im: str, extra: list[str], run) -> DataFrame:
    """columns and re, im of what run makes of complex traces and the extra columns."""

    def each(pdf: pd.DataFrame, data: np.ndarray) -> pd.DataFrame:
        out = run(data + 1j * np.stack(pdf[im].to_numpy()).astype(float), *(pdf[c].to_numpy(float) for c in extra))
        return pdf[columns].assign(re_=list(out.real), im_=list(out.imag))

    rows = _traces(df.select(*dict.fromkeys([*columns, re, im, *extra])), columns, re, each, "re_ array<double>, im_ array<double>")
    return rows.withColumnsRenamed({"re_": "re", "im_": "im"})


def compressed(df: DataFrame, columns: list[str], re: str, im: str, chirp: Chirp) -> DataFrame:
    """columns, re, im: spectra (re, im) of traces, compressed with the reference chirp; in fast time."""
    return _complex(df, columns, re, im, [], lambda z: np.fft.ifft(np.conj(chirp.spectrum(z.shape[1])) * z, norm="ortho"))


def corrected(df: DataFrame, columns: list[str], re: str, im: str, chirp: Chirp, content: float) -> DataFrame:
    """columns, re, im: traces in fast time, each bin of their spectra turned back by the ionosphere's phase."""
    return _complex(df, columns, re, im, [], lambda z: np.fft.ifft(np.fft.fft(z) * np.exp(-1j * chirp.delay_phase(z.shape[1], content))))


def aligned(df: DataFrame, columns: list[str], re: str, im: str, delay_s: str, sample_s: float) -> DataFrame:
    """columns, re, im: traces delayed by their receive windows' openings, through their spectra."""
    return _complex(df, columns, re, im, [delay_s], lambda z, delay: np.fft.ifft(np.fft.fft(z) * np.exp(-2j * math.pi * delay[:, None] * np.fft.fftfreq(z.shape[1], sample_s))))


def low_delay(window, altitude_km, channel: str) -> Column:
    """The lower sounder's delay beyond that of an altitude of 25 km."""
    return low_time(window, F.lit(0.0), channel) - 2000 * (number(altitude_km) - 25) / LIGHT
