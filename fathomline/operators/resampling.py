"""Doppler filtering and resampling of airborne lines: traces of a segment pass a range filter and an along-track low pass, and come out at a fixed posting.

The along-track filter has finitely many taps, so a chunk of traces needs only so many neighbours on either side (overlap-save), and any chunk size gives the same rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import gap_filled

#: Traces of a chunk.
CHUNK = 1024


def low_pass(half: int, full: float, none: float) -> np.ndarray:
    """2 * half + 1 taps, with sum 1, of a low pass whose response falls as a raised cosine from `full` to `none` (cycles a trace)."""
    m, fall = np.arange(-half, half + 1, dtype=float), none - full
    turn = 1 - (2 * fall * m) ** 2
    edge = np.abs(turn) < 1e-9
    taps = (full + none) * np.sinc((full + none) * m) * np.where(edge, np.pi / 4, np.cos(np.pi * fall * m) / np.where(edge, 1, turn))
    return taps / taps.sum()


def band_pass(samples: int, low: float, high: float) -> np.ndarray:
    """Response of a range filter over the bins of a trace: half a sine between two shares of the sampling rate, on both sides."""
    first, last = (int(np.floor(f * samples + 0.5)) for f in (low, high))
    out = np.zeros(samples)
    bins = np.arange(first, last + 1)
    wave = np.sin(np.pi * np.linspace(0, 1, len(bins)))
    out[bins % samples] = wave
    out[-bins % samples] = wave
    return out


def range_filtered(data: np.ndarray, low: float, high: float, blank: int = 0, tone: tuple[float, int] | None = None) -> np.ndarray:
    """Traces with their first `blank` samples silenced, without linear trend, through the range filter. tone: a leaking oscillator as a share of the sampling rate, measured on so many samples at the end, which must hold whole periods."""
    n = data.shape[1]
    data = np.where(np.arange(n) < blank, 0.0, data)
    t = np.arange(n) - (n - 1) / 2
    flat = data - data.mean(1, keepdims=True) - (data @ t / max(t @ t, 1e-300))[:, None] * t
    spectrum = np.fft.fft(flat)
    if tone:
        share, tail = tone
        leak = data[:, n - tail :] @ np.exp(-2j * np.pi * share * np.arange(n - tail, n)) * (n / tail)
        spectrum[:, round(share * n)] -= leak
        spectrum[:, -round(share * n)] -= leak.conj()
    return np.fft.ifft(spectrum * band_pass(n, low, high)).real


def along_filtered(data: np.ndarray, taps: np.ndarray) -> np.ndarray:
    """Sums of the rows around each row, weighted by taps, where all of them are there: len(data) - len(taps) + 1 rows. One pair of transforms over the chunk."""
    size = 1 << (len(data) + len(taps) - 2).bit_length()
    out = np.fft.irfft(np.fft.rfft(data, size, axis=0) * np.fft.rfft(taps[::-1], size)[:, None], size, axis=0)
    return out[len(taps) - 1 : len(data)]


def _weights(x: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First of the three traces around each place and their Lagrange weights; linear between two, and the one trace itself where a segment has no more or two don't differ."""
    if n < 3:
        weights = np.zeros((len(at), n))
        weights[:, 0] = 1
        if n == 2 and x[1] > x[0]:
            weights[:, 1] = (at - x[0]) / (x[1] - x[0])
            weights[:, 0] = 1 - weights[:, 1]
        return np.zeros(len(at), int), weights
    near = np.searchsorted((x[1:] + x[:-1]) / 2, at, "left")
    first = np.clip(near - 1, 0, n - 3)
    p = np.stack([x[first + i] for i in range(3)], 1)
    weights = np.zeros((len(at), 3))
    good = (p[:, 1] > p[:, 0]) & (p[:, 2] > p[:, 1])
    weights[np.flatnonzero(~good), (near - first)[~good]] = 1
    d, p = (at[:, None] - p)[good], p[good]
    for i, (j, k) in enumerate(((1, 2), (0, 2), (0, 1))):
        weights[good, i] = d[:, j] * d[:, k] / ((p[:, i] - p[:, j]) * (p[:, i] - p[:, k]))
    return first, weights


def _segments(df: DataFrame, key: str, segment: str, order: str, distance: str, posting: float) -> DataFrame:
    """key, segment, first_, last_ (traces), from_, to_ (lines): whole postings from the segment's first place, less a hair, to its last."""
    x = F.col(distance).cast("double")
    ends = df.groupBy(key, segment).agg(F.min(order).alias("first_"), F.max(order).alias("last_"), F.min_by(x, order).alias("x0_"), F.max_by(x, order).alias("x1_"))
    return ends.select(key, segment, "first_", "last_", F.floor(F.col("x0_") / posting + 0.99999).alias("from_"), F.floor(F.col("x1_") / posting).alias("to_"))


def line_counts(df: DataFrame, key: str, segment: str, order: str, distance: str, posting: float) -> DataFrame:
    """key, lines: how many lines filtered_lines gives for each product, gaps between segments included, from places alone."""
    ends = _segments(df, key, segment, order, distance, posting).where("to_ >= from_")
    return ends.groupBy(key).agg((F.max("to_") - F.min("from_") + 1).alias("lines"))


def filtered_lines(
    df: DataFrame, key: str, segment: str, order: str, distance: str, samples: str, posting: float,
    half: int = 50, full: float = 35 / 400, none: float = 40 / 400, low: float = 0.05, high: float = 0.35,
    blank: int = 0, tone: tuple[float, int] | None = None, gap_width: int = 10, chunk: int = CHUNK,
) -> DataFrame:
    """key, line, samples, filled: a row for each multiple `line` of the posting, from a product's first segment to its last.

    Traces of a segment are filtered in range and along track, its ends repeated as far as the taps reach; a line is quadratic between the three traces nearest to it. Between segments lines are filled from the lines at their edges (filled: true). order counts traces without gaps within a segment, distances don't fall. Segments shorter than a posting give no line. Null samples or distances are an error.
    """
    taps, reach = low_pass(half, full, none), half + 2
    ends = _segments(df, key, segment, order, distance, posting).withColumn("chunks_", F.floor((F.col("last_") - F.col("first_")) / chunk))
    rows = df.select(key, segment, F.col(order).cast("long").alias("o_"), F.col(distance).cast("double").alias("x_"), F.col(samples).cast("array<double>").alias("s_")).join(ends, [key, segment])
    place = F.col("o_") - F.col("first_")
    begin, stop = F.greatest(F.lit(0), F.floor((place - reach) / chunk)), F.least(F.col("chunks_"), F.floor((place + reach) / chunk))
    rows = rows.withColumn("chunk_", F.explode(F.sequence(begin, stop)))
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("o_").combine_chunks()
        o, x = t["o_"].to_numpy(), t["x_"].to_numpy()
        first, last, lines, end, no = (t[c][0].as_py() for c in ("first_", "last_", "from_", "to_", "chunk_"))
        data = range_filtered(t["s_"].chunk(0).flatten().to_numpy().reshape(len(o), -1), low, high, blank, tone)
        own = np.arange(max(first + no * chunk - 1, first), min(first + (no + 1) * chunk + 1, last + 1))  # a trace more on either side, for the parabola
        if len(own) < 3:
            own = np.arange(max(own[0] - 1, first), min(own[-1] + 1, last) + 1)
        around = np.clip(np.arange(own[0] - half, own[-1] + half + 1), first, last) - o[0]
        smooth = along_filtered(data[around], taps)
        x = x[own - o[0]]
        # a chunk has the lines from the middle before its first trace to the middle behind its last
        lo = -np.inf if no == 0 else (x[own == first + no * chunk - 1][0] + x[own == first + no * chunk][0]) / 2
        hi = np.inf if first + (no + 1) * chunk > last else (x[own == first + (no + 1) * chunk - 1][0] + x[own == first + (no + 1) * chunk][0]) / 2
        line = np.arange(lines, end + 1) if np.isinf(lo) and np.isinf(hi) else np.arange(max(lines, -(10**18) if np.isinf(lo) else int(np.floor(lo / posting))), min(end, 10**18 if np.isinf(hi) else int(np.ceil(hi / posting))) + 1)
        line = line[(line * posting > lo) & (line * posting <= hi)]
        begin, weights = _weights(x, line * posting, len(own))
        out = sum(weights[:, i, None] * smooth[begin + i] for i in range(weights.shape[1])) if len(line) else np.zeros((0, data.shape[1]))
        cut = pa.array(np.arange(len(line) + 1, dtype=np.int32) * data.shape[1])
        return pa.table({key: pa.array([t[key][0].as_py()] * len(line), t[key].type), "line": line.astype(np.int64), samples: pa.ListArray.from_arrays(cut, pa.array(out.ravel()))})

    lines = rows.groupBy(key, segment, "chunk_").applyInArrow(run, f"{key} {kind[key]}, line long, {samples} array<double>")
    return gap_filled(lines, key, "line", samples, gap_width)
