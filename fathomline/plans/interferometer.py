"""The interferometer from two antennas' traces to phases: loop-back correction, co-registration, roll, multilook, phases against the surface and against clutter off nadir."""

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import number, signal, traces
from ..operators import interferometry
from .work import written


@dataclass(frozen=True)
class Antennas:
    """Baseline and wavelength in metres; reach of the loop-back search in samples; co-registration's fineness and reach in fine samples; traces of a look and samples of its running mean; sample of the pulse's start."""

    baseline: float
    wavelength: float
    loopback_reach: int = 20
    factor: int = 10
    reach: int = 300
    look: int = 15
    smooth: int = 2
    start: float = 0.0


def stabilised(df: DataFrame, key: str, order: str, samples: tuple[str, str], loopback: str, reach: int) -> DataFrame:
    """df with the traces (re, im) rolled as the loop-back chirp of the same trace has to be to lie like the product's first."""
    rows = interferometry.chirp_stability(df, key, order, loopback, reach)
    return rows.withColumns({c: traces.roll(F.col(c), F.col("lag")) for c in samples}).drop("lag")


def roll_phase(roll, antennas: Antennas):
    """What a roll angle (radians) adds to the phase between the antennas at nadir."""
    return 2 * math.pi * antennas.baseline / antennas.wavelength * F.sin(number(roll))


def registered(df: DataFrame, rolls: DataFrame | None, key: str, order: str, antennas: Antennas) -> DataFrame:
    """A written table: key, order, ar, ai, br, bi (arrays), roll (phase): both antennas stabilised, b moved onto a, and the phase that roll takes off; all later steps read it. df: also loop_a and loop_b, the loop-back windows. rolls: key, order, roll in radians; traces without one have none to take off."""
    rows = stabilised(df, key, order, ("ar", "ai"), "loop_a", antennas.loopback_reach)
    rows = stabilised(rows, key, order, ("br", "bi"), "loop_b", antennas.loopback_reach)
    moved = interferometry.coregister(rows, key, order, ("ar", "ai"), ("br", "bi"), antennas.factor, antennas.reach, levelled=True)
    out = rows.select(key, order, "ar", "ai").join(moved.select(key, order, "shift", F.col("b_re").alias("br"), F.col("b_im").alias("bi")), [key, order])
    if rolls is None:
        return written(out.withColumn("roll", F.lit(0.0)))
    turned = rolls.select(key, order, roll_phase("roll", antennas).alias("roll"))
    return written(out.join(turned, [key, order], "left").withColumn("roll", F.coalesce("roll", F.lit(0.0))))


def interferogram(table: DataFrame, key: str, order: str, antennas: Antennas) -> DataFrame:
    """key, look, k, phase, correlation of a registered table."""
    return interferometry.looks(table, key, order, ("ar", "ai"), ("br", "bi"), antennas.look, antennas.smooth, "roll")


def power(table: DataFrame, key: str, order: str, antennas: Antennas) -> DataFrame:
    """key, stack, k, power: the power image of the same looks."""
    level = lambda re, im: F.zip_with(re, im, lambda x, y: signal.decibel(F.hypot(x, y)))
    rows = table.select(key, order, level("ar", "ai").alias("a_"), level("br", "bi").alias("b_"))
    return interferometry.power_image(rows, key, order, ("a_", "a_"), ("b_", "b_"), antennas.look)


def clutter(phases: DataFrame, surface: DataFrame, features: DataFrame, rolls: DataFrame | None, key: str, order: str, antennas: Antennas) -> DataFrame:
    """key, look, k, phase, correlation, expected, difference (wrapped): the phase of each feature's pixel against the surface, and what it would be if it were clutter off nadir at the surface's level.

    surface: key, look, k (its sample). features: key, look, k. rolls as for registered; a look's is their mean.
    """
    level = interferometry.normalised(phases, surface, key)
    picked = level.join(features.select(key, "look", "k"), [key, "look", "k"], "left_semi").join(surface.select(key, "look", F.col("k").alias("surface_")), [key, "look"])
    if rolls is None:
        picked = picked.withColumn("roll_", F.lit(0.0))
    else:
        width = max(1, antennas.look - 1 + antennas.look % 2)
        mean = rolls.groupBy(key, F.floor(F.col(order) / width).alias("look")).agg(F.avg("roll").alias("roll_"))
        picked = picked.join(mean, [key, "look"], "left").withColumn("roll_", F.coalesce("roll_", F.lit(0.0)))
    expected = interferometry.off_nadir_phase("surface_", "k", "roll_", antennas.baseline, antennas.wavelength, antennas.start)
    return picked.select(key, "look", "k", "phase", "correlation", expected.alias("expected")).withColumn("difference", signal.wrap_phase(F.col("phase") - F.col("expected")))
