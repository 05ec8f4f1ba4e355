"""Stacks, statistics and cubes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outliers(df: DataFrame, keys: list[str], value: str, threshold: float = 1.0, out: str = "outlier") -> DataFrame:
    """Marks rows whose modified z-score, 0.6745 |x - median| / MAD, is above the threshold. Null where x is null; with a MAD of 0 all that differ from the median are outliers."""
    v = F.col(value).cast("double")
    middle = df.groupBy(*keys).agg(F.percentile(v, F.lit(0.5)).alias("median_"))
    rows = df.join(middle, keys).withColumn("d_", F.abs(v - F.col("median_")))
    spread = rows.groupBy(*keys).agg(F.percentile("d_", F.lit(0.5)).alias("mad_"))
    return rows.join(spread, keys).withColumn(out, 0.6745 * F.col("d_") > threshold * F.col("mad_")).drop("median_", "d_", "mad_")


def histogram_quantiles(df: DataFrame, keys: list[str], value: str, shares: tuple[float, ...] = (0.16, 0.5, 0.84), bins: int = 50) -> DataFrame:
    """The middle of the bin at which the histogram's running share comes nearest to each of `shares`, first of equals: key, share, value. Bins are equal parts of a key's range."""
    v = F.col(value).cast("double")
    ends = df.groupBy(*keys).agg(F.min(v).alias("lo_"), F.max(v).alias("hi_"), F.count(v).alias("n_"))
    ends = ends.withColumn("w_", F.when(F.col("hi_") > F.col("lo_"), (F.col("hi_") - F.col("lo_")) / bins).otherwise(1.0 / bins)).withColumn("lo_", F.when(F.col("hi_") > F.col("lo_"), F.col("lo_")).otherwise(F.col("lo_") - 0.5))
    filled = df.join(ends, keys).withColumn("bin", F.least(F.floor((v - F.col("lo_")) / F.col("w_")), F.lit(bins - 1))).groupBy(*keys, "bin").agg(F.count(v).alias("c_"))
    bars = filled.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", "c_"))).alias("bars_"))  # `bins` entries at most
    step = lambda s, i: F.struct((s["sum"] + F.coalesce(F.try_element_at("bars_", i), F.lit(0))).alias("sum"), F.concat(s["all"], F.array(s["sum"] + F.coalesce(F.try_element_at("bars_", i), F.lit(0)))).alias("all"))
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all"))
    rows = bars.join(ends, keys).withColumn("cum_", F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")), zero, step)["all"])
    rows = rows.withColumn("share", F.explode(F.array(*map(F.lit, shares))))
    gap = F.transform("cum_", lambda c: F.abs(c / F.col("n_") - F.col("share")))
    best = F.array_position(gap, F.array_min(gap)) - 1
    return rows.select(*keys, "share", (F.col("lo_") + (best + 0.5) * F.col("w_")).alias("value"))


def overlapping_cube(df: DataFrame, axes: dict[str, tuple[float, float, float]], value: str, source: str) -> DataFrame:
    """Statistics over cells that overlap. axes: column to (first edge, step, width); a cell [edge, edge + width) holds a row if its value on each axis does. Empty cells aren't listed.

    Rows of the same cells are put together before they are dealt to each of them. Of a source, the cells of the first axis that it is in are bits of a number, 64 cells each, so that its rows aren't dealt to them singly.
    """
    rows, (one, *others) = df, axes
    for name, (first, step, width) in axes.items():
        x, low, high = F.col(name).cast("double"), F.col(f"{name}_low_"), F.col(f"{name}_high_")
        rows = rows.where(x >= first).withColumn(f"{name}_low_", F.greatest(F.floor((x - first - width) / step) + 1, F.lit(0)))
        rows = rows.withColumn(f"{name}_high_", F.greatest(low, F.floor((x - first) / step)))
        ends = {f"{name}_low_": F.when(x < first + low * step + width, low).otherwise(low + 1), f"{name}_high_": F.when(x >= first + high * step, high).otherwise(high - 1)}
        rows = rows.withColumns(ends).where(low <= high)
    cells, spans = [f"{name}_cell" for name in axes], [f"{name}_{end}_" for name in axes for end in ("low", "high")]
    dealt = lambda df, name: df.withColumn(f"{name}_cell", F.explode(F.sequence(f"{name}_low_", f"{name}_high_")))
    parts = rows.groupBy(*spans).agg(F.count(value).alias("n_"), F.sum(F.col(value).cast("double")).alias("s_"), F.min(value).alias("least"), F.max(value).alias("most"))
    masks = rows.where(F.col(source).isNotNull()).select(F.col(source).alias("source_"), *spans)
    for name in axes:
        parts = dealt(parts, name)
    for name in others:
        masks = dealt(masks, name)
    out = parts.groupBy(*cells).agg(F.sum("n_").alias("n"), F.try_divide(F.sum("s_"), F.sum("n_")).alias("mean"), F.min("least").alias("least"), F.max("most").alias("most"))
    masks = masks.withColumn("word_", F.explode(F.sequence(F.floor(F.col(f"{one}_low_") / 64), F.floor(F.col(f"{one}_high_") / 64))))
    masks = masks.withColumns({"a_": F.greatest(F.col(f"{one}_low_") - F.col("word_") * 64, F.lit(0)).cast("int"), "b_": F.least(F.col(f"{one}_high_") - F.col("word_") * 64, F.lit(63)).cast("int")})
    masks = masks.groupBy("source_", *cells[1:], "word_").agg(F.bit_or(F.expr("shiftleft(shiftrightunsigned(-1L, 63 - b_ + a_), a_)")).alias("mask_"))
    masks = masks.withColumn("bit_", F.explode(F.sequence(F.lit(0), F.lit(63)))).where(F.bit_get("mask_", F.col("bit_")) == 1)
    sources = masks.groupBy((F.col("word_") * 64 + F.col("bit_")).alias(cells[0]), *cells[1:]).agg(F.count(F.lit(1)).alias("sources"))
    return out.join(sources, cells, "left").withColumn("sources", F.coalesce("sources", F.lit(0).cast("long")))


def coherence(df: DataFrame, keys: list[str], re1: str, im1: str, re2: str, im2: str) -> DataFrame:
    """Complex correlation coefficient of two signals and the interferogram's phase: coherence (magnitude) and phase."""
    re, im = F.col(re1) * F.col(re2) + F.col(im1) * F.col(im2), F.col(im1) * F.col(re2) - F.col(re1) * F.col(im2)
    out = df.groupBy(*keys).agg(F.avg(re).alias("re"), F.avg(im).alias("im"), F.avg(F.col(re1) * F.col(re1) + F.col(im1) * F.col(im1)).alias("p1"), F.avg(F.col(re2) * F.col(re2) + F.col(im2) * F.col(im2)).alias("p2"))
    return out.select(*keys, F.try_divide(F.hypot("re", "im"), F.sqrt(F.col("p1") * F.col("p2"))).alias("coherence"), F.atan2("im", "re").alias("phase"))


def fresnel_stack(df: DataFrame, keys: list[str], order: str, value: str, width: int) -> DataFrame:
    """Sums of 2 (width // 2) neighbours around centres `width` apart; rows past an odd width's even part are left out, as is an incomplete last stack."""
    used = 2 * (width // 2)
    rows = df.withColumn("stack", F.floor(F.col(order) / width)).where(F.col(order) % width < used)
    return rows.groupBy(*keys, "stack").agg(F.sum(value).alias("total"), F.count("*").alias("n_")).where(F.col("n_") == used).drop("n_")


def strongest(df: DataFrame, keys: list[str], power: str, tie: str, share: float = 0.2) -> DataFrame:
    """The strongest share of each group's rows, rounded half to even."""
    from pyspark.sql import Window

    n = df.groupBy(*keys).agg(F.rint(F.count("*") * share).alias("keep_"))
    by = Window.partitionBy(*keys).orderBy(F.col(power).desc(), tie)
    return df.withColumn("rank", F.row_number().over(by)).join(n, keys).where(F.col("rank") <= F.col("keep_")).drop("keep_")


def paired_stacks(stacks: DataFrame, specs: DataFrame, block: str, samples: str, depth: int) -> DataFrame:
    """chanout, block, samples: weighted sums of two channels' stacks, over the depth. stacks: block, channel, samples. specs: chanout, chan0in, scalef0, chan1in, scalef1, few rows; a channel of 0 takes no part. A block that lacks a channel asked for goes."""
    each = specs.select("chanout", F.explode(F.filter(F.array(*(F.struct(F.col(f"chan{i}in").alias("channel"), F.col(f"scalef{i}").cast("double").alias("scale")) for i in (0, 1))), lambda x: x["channel"] > 0)).alias("s"), ((F.col("chan0in") > 0).cast("int") + (F.col("chan1in") > 0).cast("int")).alias("want_")).select("chanout", "s.*", "want_")
    rows = stacks.join(F.broadcast(each), "channel")  # a row for each input of a configuration written by hand
    scaled = rows.withColumn("x_", F.transform(samples, lambda x: x * F.col("scale") / depth))
    out = scaled.groupBy("chanout", block, "want_").agg(F.count("*").alias("n_"), F.min_by("x_", "channel").alias("a_"), F.max_by("x_", "channel").alias("b_")).where(F.col("n_") == F.col("want_"))
    return out.select("chanout", block, F.when(F.col("n_") == 1, F.col("a_")).otherwise(F.zip_with("a_", "b_", lambda p, q: p + q)).alias(samples))


def incoherent_stack(df: DataFrame, keys: list[str], order: str, re: str, im: str, depth: int) -> DataFrame:
    """keys, block, k, magnitude (the mean) and phase (of the trace in the middle, the later of two) of whole blocks of `depth` traces. df: a row for each sample, k its place."""
    middle = F.col(order) % depth == int(depth / 2 + 0.5) - 1 if depth > 1 else F.lit(True)
    rows = df.groupBy(*keys, F.floor(F.col(order) / depth).alias("block"), "k").agg(F.count("*").alias("n_"), F.avg(F.hypot(re, im)).alias("magnitude"), F.max(F.when(middle, F.atan2(im, re))).alias("phase"))
    return rows.where(F.col("n_") == depth).drop("n_")


def shift_differences(df: DataFrame, name: str, baseline: str, keys: list[str], shift: str) -> DataFrame:
    """name and the median of |shift - baseline's shift| over rows with equal keys, for all names but the baseline."""
    base = df.where(F.col(name) == baseline).select(*keys, F.col(shift).alias("base_"))
    rows = df.where(F.col(name) != baseline).join(base, keys)
    return rows.groupBy(name).agg(F.percentile(F.abs(F.col(shift) - F.col("base_")), F.lit(0.5)).alias("difference"))
