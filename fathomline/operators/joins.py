"""Joins by place along track, by range and by nearness. Range conditions become equi-joins on buckets, so that no side is paired with the whole of the other."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import islands, neighbours, sliding, united


def within(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, reach: float) -> DataFrame:
    """Pairs of rows with equal keys and |left_at - right_at| <= reach."""
    width = float(reach) if reach else 1.0
    a = left.withColumn("bucket_", F.explode(F.sequence(F.floor((F.col(left_at) - reach) / width), F.floor((F.col(left_at) + reach) / width))))
    b = right.withColumn("bucket_", F.floor(F.col(right_at) / width))
    return a.join(b, [*keys, "bucket_"]).where(F.abs(F.col(left_at) - F.col(right_at)) <= reach).drop("bucket_")


def interpolated(points: DataFrame, track: DataFrame, key: str, at: str, t: str, value: str, out: str, hold: bool = False) -> DataFrame:
    """points with `value` of the track, linear between the track's rows before and after; outside it null, or the end's value with hold."""
    posts = track.select(key, F.col(t).cast("double").alias("at_"), F.struct(F.col(t).cast("double").alias("t"), F.col(value).cast("double").alias("v")).alias("post_"))
    both = points.withColumn("at_", F.col(at).cast("double")).withColumn("asks_", F.lit(True))
    rows = neighbours(united(both, posts, key), key, "at_", "post_", "lo_", "hi_").where("asks_")
    blend = F.col("lo_.v") + F.coalesce(F.try_divide(F.col("at_") - F.col("lo_.t"), F.col("hi_.t") - F.col("lo_.t")), F.lit(0.0)) * (F.col("hi_.v") - F.col("lo_.v"))
    blend = F.coalesce(blend, "lo_.v", "hi_.v") if hold else blend
    return rows.withColumn(out, blend).drop("at_", "asks_", "post_", "lo_", "hi_")


def crossovers(df: DataFrame, order: str, value: str, key: str | None = None) -> DataFrame:
    """Rows 0 and 1, 2 and 3, ... of an order without gaps are pairs: pair, residual (even minus odd)."""
    keys = [key] if key else []
    v = F.col(value).cast("double")
    pairs = df.groupBy(*keys, F.floor(F.col(order) / 2).alias("pair")).agg(F.max(F.when(F.col(order) % 2 == 0, v)).alias("even"), F.max(F.when(F.col(order) % 2 == 1, v)).alias("odd"))
    return pairs.where("even IS NOT NULL AND odd IS NOT NULL").select(*keys, "pair", (F.col("even") - F.col("odd")).alias("residual"))


def nearest(points: DataFrame, grid: DataFrame, key: str, at: str, place: str, index: str) -> DataFrame:
    """points with the index of the grid's nearest place, the lowest of equally near ones. The rows before and after are looked at, not the grid."""
    g = grid.groupBy(key, F.col(place).cast("double").alias("at_")).agg(F.min(index).alias("i_"))
    g = g.select(key, "at_", F.struct(F.col("at_").alias("p"), F.col("i_").alias("i")).alias("g_"))
    both = points.withColumn("at_", F.col(at).cast("double")).withColumn("q_", F.lit(True))
    rows = neighbours(united(both, g, key), key, "at_", "g_", "lo_", "hi_").where("q_")
    choice = lambda g: F.when(F.col(g).isNotNull(), F.struct(F.abs(F.col(f"{g}.p") - F.col("at_")), F.col(f"{g}.i").alias("i")))
    return rows.withColumn(index, F.least(choice("lo_"), choice("hi_"))["i"]).drop("at_", "q_", "g_", "lo_", "hi_")


def gather(facts: DataFrame, orbits: DataFrame, bad: DataFrame, flags: DataFrame, key: str, order: str, conditions: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows of wanted orbits that aren't bad, with the flags of the same trace, strictly within the conditions."""
    rows = facts.join(orbits.select(key).distinct(), key, "left_semi").join(bad.select(key).distinct(), key, "left_anti")
    for name, (low, high) in conditions.items():
        rows = rows.where((F.col(name) > low) & (F.col(name) < high))
    return rows.join(flags, [key, order])


def crossings(pairs: DataFrame, tracks: DataFrame, key: str, order: str, value: str, above: float) -> DataFrame:
    """pairs (key1, order1, key2, order2, of two tracks that cross) with value1 and value2 of the tracks there, where both are above a bound."""
    side = lambda i: tracks.select(F.col(key).alias(f"{key}{i}"), F.col(order).alias(f"{order}{i}"), F.col(value).alias(f"{value}{i}")).where(F.col(f"{value}{i}") > above)
    return pairs.join(side(1), [f"{key}1", f"{order}1"]).join(side(2), [f"{key}2", f"{order}2"])


def smoothed_hold(df: DataFrame, key: str, order: str, value: str, out: str, epsilon: float = 0.0) -> DataFrame:
    """df with out: values that were sampled and held, linear between the middles of their runs and beyond the first and last. A product of one run keeps its value."""
    runs = islands(df, key, order, value, epsilon).select(key, "island", F.col("t").cast("double").alias("t"), F.col("value").cast("double").alias("v"))
    point = F.struct("t", "v")
    runs = sliding(runs, key, "island", 1, 1, before_=F.first(point), after_=F.last(point))
    slope = lambda p, q: F.try_divide(q["v"] - p["v"], q["t"] - p["t"])
    here = F.struct("t", "v")
    posts = runs.select(key, F.col("t").alias("at_"), F.struct("t", "v", slope(F.col("before_"), here).alias("behind"), slope(here, F.col("after_")).alias("ahead")).alias("post_"))
    asks = df.withColumn("at_", F.col(order).cast("double")).withColumn("asks_", F.lit(True))
    rows = neighbours(united(asks, posts, key), key, "at_", "post_", "lo_", "hi_").where("asks_")
    lo, hi, x = F.col("lo_"), F.col("hi_"), F.col("at_")
    inside = lo["v"] + F.coalesce(F.try_divide(x - lo["t"], hi["t"] - lo["t"]), F.lit(0.0)) * (hi["v"] - lo["v"])
    level = F.coalesce(inside, hi["v"] + F.coalesce(hi["ahead"], F.lit(0.0)) * (x - hi["t"]), lo["v"] + F.coalesce(lo["behind"], F.lit(0.0)) * (x - lo["t"]))
    return rows.withColumn(out, level).drop("at_", "asks_", "post_", "lo_", "hi_")
