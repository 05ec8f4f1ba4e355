"""Statistics of interferometric phases: how many azimuth samples are independent, and how far the mean of several phases may be from the true one."""

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .interferometry import phase_density

#: Quantiles of a phase density that draws choose from.
QUANTILES = 1 << 14
#: Standard deviation in degrees below which phases count as Gaussian.
GAUSSIAN = 30.0


def independent_samples(coherences: DataFrame, counts: DataFrame, keys: list[str], lag: str = "lag", coherence: str = "coherence", level: float = math.exp(-1), n: str = "n") -> DataFrame:
    """keys, n, spacing, looks: from coherences of rows of pixels with themselves by lag (from 0), the lag at which they first fall below `level`, linear between lags and 1 at least; looks is how many such spacings n (of counts, by keys) holds, 1 at least. Rows that never fall below it within the lags are one look, and their spacing is null."""
    before = Window.partitionBy(*keys).orderBy("lag_")
    rows = coherences.select(*keys, F.col(lag).cast("double").alias("lag_"), F.col(coherence).cast("double").alias("c_"))
    rows = rows.withColumns({"lag0_": F.lag("lag_").over(before), "c0_": F.lag("c_").over(before)})
    share = (F.col("c0_") - level) / (F.col("c0_") - F.col("c_"))
    falls = F.when((F.col("c_") < level) & (F.col("c0_") >= level), F.col("lag0_") + share * (F.col("lag_") - F.col("lag0_")))
    first = rows.groupBy(*keys).agg(F.min(falls).alias("spacing"))
    first = first.withColumn("spacing", F.when(F.col("spacing").isNotNull(), F.greatest("spacing", F.lit(1.0))))
    return first.join(counts.select(*keys, F.col(n).alias("n")), keys).withColumn("looks", F.greatest(F.coalesce(F.col("n") / F.col("spacing"), F.lit(1.0)), F.lit(1.0))).select(*keys, "n", "spacing", "looks")


def empirical_density(spark: SparkSession, correlation: float, looks: float, centre_deg: float = 0.0, points: int = 10_000) -> DataFrame:
    """phase (radians, `points` of them evenly from -pi to pi) and density."""
    phase = -math.pi + F.col("id") * (2 * math.pi / (points - 1))
    return spark.range(points).select(phase.alias("phase")).withColumn("density", phase_density("phase", math.radians(centre_deg), correlation, looks))


def _density(phase: np.ndarray, centre: float, correlation: float, looks: float, terms: int = 400) -> np.ndarray:
    """phase_density of an array, for tables that depend on parameters alone."""
    beta = correlation * np.cos(phase - centre)
    z = beta * beta
    total, term = np.zeros_like(z), np.ones_like(z)
    for i in range(terms):
        total += term
        term = term * z * (i - 0.5) * (i + 0.5 - looks) / ((i + 0.5) * (i + 1.0))
    scale = (1 - correlation**2) ** looks
    odd = math.exp(math.lgamma(looks + 0.5) - math.lgamma(looks)) / (2 * math.sqrt(math.pi)) * beta
    return scale * (total / (2 * math.pi) + odd) * (1 - z) ** (-looks - 0.5)


def quantiles(correlation: float, looks: float, centre_deg: float = 0.0, count: int = QUANTILES, points: int = 10_000) -> np.ndarray:
    """Phases of the middles of `count` equally likely parts, by trapezoids over `points` steps, linear between them."""
    phase = np.linspace(-math.pi, math.pi, points + 1)
    f = _density(phase, math.radians(centre_deg), correlation, looks)
    total = np.concatenate(([0.0], np.cumsum((f[1:] + f[:-1]) / 2)))
    return np.interp((np.arange(count) + 0.5) / count, total / total[-1], phase)


def deviation_deg(correlation: float, looks: float, centre_deg: float = 0.0, points: int = 10_000) -> float:
    """Root of the mean square of the phase, in degrees: its standard deviation where the centre is 0."""
    phase = np.linspace(-math.pi, math.pi, points + 1)
    f = _density(phase, math.radians(centre_deg), correlation, looks)
    weight = f * np.where((np.arange(points + 1) == 0) | (np.arange(points + 1) == points), 0.5, 1.0) * (2 * math.pi / points)
    return math.degrees(math.sqrt((weight * phase**2).sum()))


def _turn(row: Column, draw: Column, seed: int, count: int) -> Column:
    """Which of `count` parts a draw falls into: 52 bits of a hash of seed, row and draw."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), row.cast("string"), draw.cast("string"))), 1, 13), 16, 10).cast("long")
    return F.floor(bits / (2.0**52 / count)).cast("int")


def drawn_means(rows: DataFrame, key: str, draws: int, correlation: float, looks: float, centre_deg: float = 0.0, seed: int = 1, count: int = QUANTILES) -> DataFrame:
    """key and mean, of `draws` phases (radians) drawn from the density for each row. A draw depends on seed, key and its number alone, so that neither partitions nor reruns change it. The table of quantiles is of `count` rows, which is broadcast."""
    spark = rows.sparkSession
    parts = spark.createDataFrame(list(enumerate(quantiles(correlation, looks, centre_deg, count).tolist())), "part int, phase double")
    each = rows.select(key, F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw")).select(key, _turn(F.col(key), F.col("draw"), seed, count).alias("part"))
    return each.join(F.broadcast(parts), "part").groupBy(key).agg(F.avg("phase").alias("mean"))


def sample_mean_deviation(spark: SparkSession, pixels: int, correlation: float, looks: float, centre_deg: float = 0.0, simulations: int = 500_000, seed: int = 1) -> DataFrame:
    """One row: deviation (degrees, of a phase), mean_deviation (of the mean of so many pixels' phases). Phases that scatter little count as Gaussian; else means are simulated, in as many tasks as the session deals rows to."""
    one = deviation_deg(correlation, looks, centre_deg)
    if one < GAUSSIAN:
        return spark.range(1).select(F.lit(one).alias("deviation"), F.lit(one / math.sqrt(pixels)).alias("mean_deviation"))
    means = drawn_means(spark.range(simulations), "id", pixels, correlation, looks, centre_deg, seed)
    return means.agg(F.stddev_pop(F.degrees("mean")).alias("mean_deviation")).select(F.lit(one).alias("deviation"), "mean_deviation")
