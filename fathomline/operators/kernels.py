"""Numerical kernels without a SQL form: Fourier transforms and model fits, on Arrow batches of traces.

Each works trace by trace or on one chunk of a product, so that Spark spreads the work and a long product is no single task.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the instrument: sample interval and chirp length in seconds, chirp band in Hz, speed of light.
SAMPLE_S, CHIRP_S, LOW_HZ, HIGH_HZ, LIGHT = 0.0375e-6, 85.05e-6, 15e6, 25e6, 299792458.0
TEC_PER_E = 0.29


def chirp_spectrum(samples: int, electron: float = 0.0) -> np.ndarray:
    """Spectrum of the transmitted chirp after an ionosphere of that electron content, right-aligned and time-reversed."""
    t = np.arange(0, CHIRP_S, SAMPLE_S)[:samples]
    rate = (HIGH_HZ - LOW_HZ) / CHIRP_S
    angle = 2 * np.pi * (LOW_HZ * t + rate / 2 * t * t)
    if electron:
        angle = angle - electron * (LOW_HZ + rate * t) ** -1.93
    padded = np.zeros(samples, complex)
    padded[samples - len(t) :] = 1j * np.exp(1j * angle)
    return np.fft.fft(padded[::-1])


def band_window(samples: int) -> np.ndarray:
    """Half a sine over the chirp's band, reversed."""
    first, last = (int(round(f * samples * SAMPLE_S)) for f in (LOW_HZ, HIGH_HZ))
    out = np.zeros(samples)
    out[first : last + 1] = np.sin(np.linspace(0, np.pi, last - first + 1))
    return out[::-1]


def gaussian_centre(counts: np.ndarray, guess: tuple[float, float, float], rounds: int = 200) -> tuple[float, float]:
    """Centre and width of a Gaussian fitted to counts by damped least squares; the guess's where the fit fails."""
    x, p, damp = np.arange(len(counts), dtype=float), np.array(guess, float), 1e-3

    def model(p):
        e = np.exp(-((x - p[1]) ** 2) / (2 * p[2] ** 2))
        return p[0] * e, np.stack((e, p[0] * e * (x - p[1]) / p[2] ** 2, p[0] * e * (x - p[1]) ** 2 / p[2] ** 3), axis=1)

    y, j = model(p)
    for _ in range(rounds):
        a, g = j.T @ j, j.T @ (counts - y)
        try:
            step = np.linalg.solve(a + damp * np.diag(np.diag(a) + 1e-12), g)
        except np.linalg.LinAlgError:
            return 0.0, -1.0
        if abs((q := p + step)[2]) < 1e-6:
            return 0.0, -1.0
        y2, j2 = model(q)
        if ((counts - y2) ** 2).sum() < ((counts - y) ** 2).sum():
            done = np.abs(step).max() < 1e-8
            p, y, j, damp = q, y2, j2, damp / 3
            if done:
                break
        elif (damp := damp * 4) > 1e12:
            break
    return float(p[1]), float(p[2])


def compressed(data: np.ndarray, iono: bool, filtered: bool = True, resolution: int = 50, noise: int = 266) -> tuple[np.ndarray, float, float]:
    """Pulse compression of a chunk (traces by samples) with the electron content that most of its traces do best with: the traces, the content as a share of the menu, its width."""
    n = data.shape[1]
    spectrum = np.fft.fft(data) * (band_window(n) if filtered else 1.0)
    best, width = 0.0, 0.0
    unit = 1e16 / (TEC_PER_E * resolution)
    if iono:
        ratio = []
        for i in range(resolution):
            trace = np.fft.ifft(spectrum * np.conj(chirp_spectrum(n, i * unit)))
            ratio.append(np.abs(trace).max(axis=1) ** 2 / np.maximum(np.var(trace[:, :noise], axis=1), 1e-300))
        votes = np.bincount(np.argmax(ratio, axis=0), minlength=resolution)
        best, width = gaussian_centre(votes, (len(data) / 2, resolution / 2, 20.0))
        best = min(resolution - 1, max(0.0, best))
    out = np.fft.ifft(spectrum * np.conj(chirp_spectrum(n, best * unit)))
    return out, best / resolution, width / resolution


def range_compress(df: DataFrame, key: str, chunk: str, order: str, samples: str, zenith: str, night_only_above: float = 100.0) -> DataFrame:
    """key, chunk, order, re, im (whole numbers), tec, tec_width. A chunk whose least solar zenith angle is below `night_only_above` is corrected for the ionosphere."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        out, tec, width = compressed(np.stack(pdf[samples].to_numpy()).astype(float), bool(pdf[zenith].min() < night_only_above))
        return pd.DataFrame({key: pdf[key], chunk: pdf[chunk], order: pdf[order], "re": list(np.rint(out.real)), "im": list(np.rint(out.imag)), "tec": tec, "tec_width": width})

    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(key, chunk, order, samples, zenith).groupBy(key, chunk).applyInPandas(run, f"{key} {kind[key]}, {chunk} {kind[chunk]}, {order} {kind[order]}, re array<double>, im array<double>, tec double, tec_width double")


def delayed(data: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Rows shifted by fractions of a sample, by their spectra; the Nyquist bin goes."""
    n = data.shape[1]
    k = np.fft.fftshift(np.arange(n // 2 - n, n // 2))
    turn = np.exp(-2j * np.pi * offset[:, None] / n * k)
    turn[:, n // 2] = 0
    return np.fft.ifft(np.fft.fft(data) * turn)


def upsampled(data: np.ndarray, factor: int) -> np.ndarray:
    """Rows with `factor` times the samples, through a padded spectrum; values are kept."""
    n = data.shape[1]
    pad = (n * factor - n) // 2
    wide = np.pad(np.fft.fftshift(np.fft.fft(data), axes=1), ((0, 0), (pad, pad)))
    return factor * np.fft.ifft(np.fft.ifftshift(wide, axes=1))


def _traces(df: DataFrame, columns: list[str], samples: str, run, out: str) -> DataFrame:
    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            if len(pdf):
                yield run(pdf, np.stack(pdf[samples].to_numpy()).astype(float))

    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.mapInPandas(each, ", ".join([*(f"{c} {kind[c]}" for c in columns), out]))


def shift(df: DataFrame, columns: list[str], samples: str, offset: str) -> DataFrame:
    """columns and the shifted trace as re, im."""

    def run(pdf, data):
        out = delayed(data, pdf[offset].to_numpy(float))
        return pdf[columns].assign(re=list(out.real), im=list(out.imag))

    return _traces(df.select(*dict.fromkeys([*columns, samples, offset])), columns, samples, run, "re array<double>, im array<double>")


def upsample(df: DataFrame, columns: list[str], samples: str, factor: int) -> DataFrame:
    """columns and the real part of the finer trace."""
    return _traces(df.select(*columns, samples), columns, samples, lambda pdf, data: pdf[columns].assign(fine=list(upsampled(data, factor).real)), "fine array<double>")


def erf(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.erf, x.ravel().tolist()), float, x.size).reshape(x.shape)


def retracked(windows_db: np.ndarray, start: tuple[float, float, float] = (100.0, 3.0, 0.05), floor: int = 128, rounds: int = 30) -> np.ndarray:
    """Noise level, amplitude, place, rise and decay of the five-parameter echo model, by bounded damped least squares on windows in decibels, one or a row for each. Each has its own damping and number of steps; they are only worked out together."""
    if windows_db.ndim == 1:
        return retracked(windows_db[None], start, floor, rounds)[0]
    t = np.arange(windows_db.shape[1], dtype=float)
    low, high = np.array([-500.0, 0, 0, 1e-6, 0]), np.array([np.inf, np.inf, np.inf, np.inf, 1.0])
    level = windows_db[:, : min(floor, len(t))].mean(axis=1)
    p = np.clip(np.column_stack((level, windows_db.max(axis=1) - level, *(np.full(len(level), x) for x in start))), low, high)

    def model(p):
        level, size, place, rise, decay = (c[:, None] for c in p.T)
        lag = np.where(t < place - 2 * rise, 0.0, t - (place + 0.5 * rise))
        return level + size * np.exp(np.clip(-decay * lag, -50, 50)) * 0.5 * (1 + erf((t - place) / (math.sqrt(2) * rise)))

    y, damp, on = model(p), np.full(len(p), 1e-2), np.arange(len(p))
    for _ in range(rounds):
        if not len(on):
            break
        x, fit, of = p[on], y[on], windows_db[on]
        h = 1e-6 * np.maximum(np.abs(x), 1e-2)
        j = np.stack([(model(x + np.eye(5)[k] * h[:, k : k + 1]) - fit) / h[:, k : k + 1] for k in range(5)], axis=2)
        a, g = np.stack([m.T @ m for m in j]), np.stack([m.T @ v for m, v in zip(j, of - fit, strict=True)])[:, :, None]
        ridge = np.diagonal(a, axis1=1, axis2=2) + 1e-9
        error, d = ((of - fit) ** 2).sum(axis=1), damp[on]
        step, better = x.copy(), np.zeros(len(on), bool)
        tries = np.flatnonzero(d < 1e12)
        while len(tries):
            q = np.clip(x[tries] + np.linalg.solve(a[tries] + (d[tries, None] * ridge[tries])[:, :, None] * np.eye(5), g[tries])[:, :, 0], low, high)
            z = model(q)
            lower = ((of[tries] - z) ** 2).sum(axis=1) < error[tries]
            step[tries[lower]], fit[tries[lower]], better[tries[lower]] = q[lower], z[lower], True
            d[tries[~lower]] *= 4
            tries = tries[~lower & (d[tries] < 1e12)]
        p[on], y[on], damp[on] = step, fit, np.where(better, d / 3, d)
        on = on[better & ~(np.abs(step - x).max(axis=1) < 1e-5)]
    return p


#: Samples that are fitted together.
FITTED = 1 << 16


def retrack(df: DataFrame, columns: list[str], power: str, first: str) -> DataFrame:
    """columns, delta (the echo's place in the trace), snr (its fitted amplitude in dB). power: a window of the trace that starts at index `first`."""

    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            size = pdf[power].map(len).to_numpy(int)  # those at a trace's end are shorter
            fits = np.empty((len(pdf), 5))
            for n in np.unique(size).tolist():
                at, many = np.flatnonzero(size == n), max(1, FITTED // max(n, 1))
                for some in (at[i : i + many] for i in range(0, len(at), many)):
                    windows = 10 * np.log10(np.maximum(np.stack(pdf[power].iloc[some].to_numpy()).astype(float), 1e-30))
                    fits[some] = retracked(windows, start=(n / 2, 3.0, 0.05), floor=n // 3)
            yield pdf[columns].assign(delta=fits[:, 2] + pdf[first].to_numpy(float), snr=fits[:, 1])

    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.select(*dict.fromkeys([*columns, power, first]))
    return rows.mapInPandas(each, ", ".join([*(f"{c} {kind[c]}" for c in columns), "delta double, snr double"]))


def focused(traces: np.ndarray, delay_s: np.ndarray, distance_m: float, time_s: np.ndarray, speed: np.ndarray) -> np.ndarray:
    """One posting of delay-Doppler focusing: align, undo range and azimuth migration over the aperture, and take the zero-Doppler look of Hann-weighted traces."""
    f = np.fft.fftfreq(traces.shape[1], SAMPLE_S)
    away = np.sqrt(distance_m**2 + (time_s * speed) ** 2) - distance_m
    spectrum = np.fft.fft(traces) * np.exp(2j * np.pi * (2 * away / LIGHT - (delay_s - delay_s[0]))[:, None] * f)
    aligned = np.fft.ifft(spectrum) * np.exp(-1j * 4 * np.pi * HIGH_HZ / LIGHT * away)[:, None]
    return np.abs((aligned * np.hanning(len(aligned))[:, None]).sum(axis=0))


def focus(df: DataFrame, key: str, order: str, samples: str, track_m: str, time_s: str, distance_m: str, speed: str, delay_s: str, posting_m: float, aperture_m: float) -> DataFrame:
    """key, posting, traces, sar: a row for every posting_m along track, from the traces within half an aperture of it.

    A trace goes to each posting whose aperture holds it, so that apertures are groups of their own and a product isn't gathered.
    """
    half = aperture_m / 2
    at = F.col(track_m)
    rows = df.withColumn("posting", F.explode(F.sequence(F.ceil((at - half) / posting_m), F.floor((at + half) / posting_m))))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        middle = np.abs(pdf[track_m].to_numpy() - pdf["posting"].iloc[0] * posting_m).argmin()
        t = pdf[time_s].to_numpy(float)
        sar = focused(np.stack(pdf[samples].to_numpy()).astype(float), pdf[delay_s].to_numpy(float), float(pdf[distance_m].iloc[middle]), t - t[middle], pdf[speed].to_numpy(float))
        return pd.DataFrame({key: [pdf[key].iloc[0]], "posting": [pdf["posting"].iloc[0]], "traces": [len(pdf)], "sar": [sar]})

    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return rows.select(key, "posting", order, samples, track_m, time_s, distance_m, speed, delay_s).groupBy(key, "posting").applyInPandas(run, f"{key} {kind[key]}, posting long, traces long, sar array<double>")


def without_tone(spectrum: np.ndarray, at: int) -> np.ndarray:
    """Spectra (a row for each trace) with one bin replaced by the mean magnitude and the mean phase of its neighbours."""
    left, right = spectrum[:, at - 1], spectrum[:, (at + 1) % spectrum.shape[1]]
    p, q = np.angle(left), np.angle(right)
    p = np.where(np.abs(p - q) > np.pi, p + 2 * np.pi, p)
    out = spectrum.copy()
    out[:, at] = (np.abs(left) + np.abs(right)) / 2 * np.exp(1j * (p + q) / 2)
    return out


def dechirped(data: np.ndarray, reference: np.ndarray, tones: tuple[float, ...] = (1 / 5, 4 / 5, 2 / 5, 3 / 5)) -> np.ndarray:
    """Traces less their linear trend, rolled to their peaks, without coherent tones (shares of the sampling rate), times the reference spectrum, and rolled back."""
    n = data.shape[1]
    peak = data.argmax(axis=1)
    at = (np.arange(n)[None] + peak[:, None]) % n
    rolled = np.take_along_axis(data, at, axis=1)
    t = np.arange(n) - (n - 1) / 2
    rolled = rolled - rolled.mean(axis=1, keepdims=True) - (rolled @ t / max(t @ t, 1e-30))[:, None] * t
    spectrum = np.fft.fft(rolled)
    for share in tones:
        spectrum = without_tone(spectrum, int(n * share + 1) % n)
    out = np.empty_like(spectrum)
    np.put_along_axis(out, at, np.fft.ifft(spectrum * reference), axis=1)
    return out


def dechirp(df: DataFrame, columns: list[str], samples: str, reference: np.ndarray, tones: tuple[float, ...] = (1 / 5, 4 / 5, 2 / 5, 3 / 5)) -> DataFrame:
    """columns and the dechirped trace as re, im. reference: a spectrum as long as the traces."""

    def run(pdf, data):
        out = dechirped(data, reference, tones)
        return pdf[columns].assign(re=list(out.real), im=list(out.imag))

    return _traces(df.select(*dict.fromkeys([*columns, samples])), columns, samples, run, "re array<double>, im array<double>")
