"""Along-track operators: rows are traces of a product, in order of an index without gaps.

A product may be long: sliding sums work on chunks of its index, each with the few rows around it that its windows reach, so that a window never needs a whole product in one task.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 4096
#: Traces of a chunk whose samples are summed in one task.
TRACES = 256
#: Buckets of keys whose rows are counted together.
KEYS = 1 << 20


def united(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The rows of both, with nulls for columns that one lacks. Spark 4.1 takes a union of sides that are dealt by one key for dealt by it too, even where adaptive coalescing has cut them differently, and then gives wrong groups; a key that comes from a generator isn't taken so."""
    return one.unionByName(other.withColumn(key, F.explode(F.array(key))), allowMissingColumns=True)


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added to those that df has, so that an operator's own columns don't meet its caller's."""
    taken = {c.lower() for c in df.columns}
    return [n + "_" * next(i for i in range(len(taken) + 1) if n + "_" * i not in taken) for n in names]


def _chunked(df: DataFrame, order: str, before: int, after: int, size: int | None = None) -> DataFrame:
    """Rows once for each chunk that needs them; own: whether the row is the chunk's."""
    size = size or CHUNK
    home = F.floor(F.col(order) / size)
    first, last = F.floor((F.col(order) - after) / size), F.floor((F.col(order) + before) / size)
    return df.withColumn("chunk_", F.explode(F.sequence(first, last))).withColumn("own_", F.col("chunk_") == home)


def sliding(df: DataFrame, key: str, order: str, before: int, after: int, **aggregates: Column) -> DataFrame:
    """Aggregates over `before` rows before to `after` rows after each row, and frame_rows, how many there are."""
    frame = Window.partitionBy(key, "chunk_").orderBy(order).rowsBetween(-before, after)
    rows = _chunked(df, order, before, after).withColumns({k: c.over(frame) for k, c in aggregates.items()} | {"frame_rows": F.count(F.lit(1)).over(frame)})
    return rows.where("own_").drop("own_", "chunk_")


def centred_mean(df: DataFrame, key: str, order: str, value: str, n: int, out: str, edge: str = "zero") -> DataFrame:
    """Mean of n rows around each. Where they aren't all there: 0 (edge 'zero'), or the end rows are repeated (edge 'repeat')."""
    before, after = (n // 2, n - 1 - n // 2) if edge == "zero" else ((n - 1) // 2, n - 1 - (n - 1) // 2)
    total = F.sum(F.col(value).cast("double"))
    if edge == "zero":
        return sliding(df, key, order, before, after, **{out: total}).withColumn(out, F.when(F.col("frame_rows") == n, F.col(out) / n).otherwise(0.0)).drop("frame_rows")
    ends = df.groupBy(key).agg(F.min(order).alias("first_i"), F.max(order).alias("last_i"), F.min_by(value, order).alias("first_v"), F.max_by(value, order).alias("last_v"))
    rows = sliding(df, key, order, before, after, **{out: total}).join(ends, key)
    under = F.greatest(F.lit(0), F.col("first_i") + before - F.col(order))
    over = F.greatest(F.lit(0), F.col(order) + after - F.col("last_i"))
    return rows.withColumn(out, (F.col(out) + under * F.col("first_v") + over * F.col("last_v")) / n).drop("frame_rows", "first_i", "last_i", "first_v", "last_v")


def trailing_mean(df: DataFrame, key: str, order: str, value: str, n: int, out: str) -> DataFrame:
    """Mean of each row and the n - 1 after it; the last n - 1 rows go."""
    return sliding(df, key, order, 0, n - 1, **{out: F.avg(F.col(value).cast("double"))}).where(F.col("frame_rows") == n).drop("frame_rows")


def prefix_sum(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Running sum by way of chunk totals, so that a product's sum doesn't run in one task."""
    rows = df.withColumn("chunk_", F.floor(F.col(order) / CHUNK))
    earlier = Window.partitionBy(key).orderBy("chunk_").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(key, "chunk_").agg(F.sum(value).alias("t_")).withColumn("base_", F.coalesce(F.sum("t_").over(earlier), F.lit(0))).drop("t_")
    own = Window.partitionBy(key, "chunk_").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(base, [key, "chunk_"]).withColumn(out, F.col("base_") + F.sum(value).over(own)).drop("base_", "chunk_")


def numbered(df: DataFrame, key: str, chunk: Column, order: list[str], out: str) -> DataFrame:
    """df with out, the number of each row within its key from 0. chunk: a part of the order, such as a day or thousands of an id, that grows with it; rows are put in order within parts, and the parts' counts added up."""
    rows = df.withColumn("chunk_", chunk)
    earlier = Window.partitionBy(key).orderBy("chunk_").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(key, "chunk_").count().withColumn("base_", F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count")
    own = F.row_number().over(Window.partitionBy(key, "chunk_").orderBy(*order)) - 1
    return rows.join(base, [key, "chunk_"]).withColumn(out, (F.col("base_") + own).cast("long")).drop("base_", "chunk_")


def trace_sums(df: DataFrame, key: str, order: str, samples: str, before: int, after: int) -> DataFrame:
    """df with samples (array of double) summed over `before` traces before to `after` traces after, where all of those are there; other traces have null.

    Differences of running sums over a chunk of TRACES traces and the few around it: a trace is added once, whatever the window's length.
    """
    rows = _chunked(df.withColumn(samples, F.col(samples).cast("array<double>")), order, before, after, TRACES)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by(order).combine_chunks()
        at, own = t[order].to_numpy(), t["own_"].to_numpy()
        data = t[samples].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
        total = np.concatenate((np.zeros((1, data.shape[1])), np.cumsum(data, axis=0)))
        place = np.arange(len(at))
        whole = (place >= before) & (place + after < len(at))
        low, high = np.maximum(place - before, 0), np.minimum(place + after, len(at) - 1)
        whole &= (at[high] - at[low] == before + after)
        out = (total[high + 1] - total[low])[own & whole]
        size = np.where(whole[own], data.shape[1], 0)
        sums = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(out.ravel()), mask=pa.array(~whole[own]))
        t = t.filter(pa.array(own)).drop_columns(["own_", "chunk_"])
        return t.set_column(t.schema.get_field_index(samples), samples, sums)

    schema = rows.drop("own_", "chunk_").schema
    return rows.groupBy(key, "chunk_").applyInArrow(run, schema)


def zero_doppler(df: DataFrame, key: str, order: str, samples: str, before: int = 30, after: int = 29) -> DataFrame:
    """Each trace becomes the sum of the traces around it (the zero-frequency bin along track); the first `before` and last `before` stay as they are."""
    last = df.groupBy(key).agg(F.max(order).alias("last_"))
    rows = trace_sums(df.withColumn("own_trace_", F.col(samples)), key, order, samples, before, after).join(last, key)
    inner = (F.col(order) >= before) & (F.col(order) <= F.col("last_") - before)
    return rows.withColumn(samples, F.when(inner & F.col(samples).isNotNull(), F.col(samples)).otherwise(F.col("own_trace_").cast("array<double>"))).drop("own_trace_", "last_")


def islands(df: DataFrame, key: str, order: str, value: str, epsilon: float = 0.0) -> DataFrame:
    """Runs of neighbours that differ by epsilon at most: key, island, value (the first), t (the middle of the run), n. A product of one run gives a second point at its start."""
    rows = sliding(df, key, order, 1, 0, before_=F.first(value))
    rows = rows.withColumn("new_", F.coalesce(((F.col("frame_rows") == 2) & (F.abs(F.col(value) - F.col("before_")) > epsilon)).cast("int"), F.lit(0))).drop("frame_rows", "before_")
    rows = prefix_sum(rows, key, order, "new_", "island")
    runs = rows.groupBy(key, "island").agg(F.min_by(value, order).alias("value"), F.min(order).alias("lo_"), F.max(order).alias("hi_"), F.count("*").alias("n"))
    runs = runs.withColumn("t", (F.col("lo_") + F.col("hi_")) / 2)
    single = runs.groupBy(key).agg(F.max("island").alias("m")).where("m = 0").select(key)
    start = runs.join(single, key, "left_semi").withColumn("t", F.col("lo_").cast("double")).withColumn("island", F.lit(-1).cast("long"))
    return united(runs, start, key).drop("lo_", "hi_")


def neighbours(df: DataFrame, key: str, at: str, post: str, before: str, after: str) -> DataFrame:
    """df with before and after, the last post at or before each row's place and the first at or after it; post: a struct column whose first field is its place, null in rows that are none.

    Places are cut into parts of about CHUNK rows each, and parts hand their last and first posts on, so that no key is a single task. Rows are counted by buckets of keys, KEYS of them at most: keys of a bucket of fewer than CHUNK rows are one part, and nothing is looked up for them. Rows are put in order once.
    """
    bucket, low, high, parts, part, cut, place, carried, coming = spare(df, "bucket_", "from_", "to_", "parts_", "part_", "cut_", "x_", "carried_", "coming_")
    x = F.col(at).cast("double")
    rows = df.where(F.col(key).isNotNull()).withColumn(bucket, F.pmod(F.hash(key), F.lit(KEYS)))
    full = rows.groupBy(bucket).agg(F.min(x).alias(low), F.max(x).alias(high), F.ceil(F.count(F.lit(1)) / CHUNK).alias(parts)).where(F.col(parts) > 1)
    share = F.coalesce(F.try_divide(x - F.col(low), F.col(high) - F.col(low)), F.lit(0.0))
    own = F.least(F.floor(share * F.col(parts)), F.col(parts) - 1)
    rows = rows.join(F.broadcast(full), bucket, "left").withColumn(part, F.coalesce(own, F.lit(0).cast("long"))).withColumn(cut, F.col(parts).isNotNull()).drop(bucket, low, high, parts)
    heads = rows.where(F.col(cut)).groupBy(key, part).agg(F.max(post).alias("last_"), F.min(post).alias("first_"))
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(key).orderBy(part).rowsBetween(1, Window.unboundedFollowing)
    heads = heads.select(key, part, F.last("last_", ignorenulls=True).over(earlier).alias(carried), F.first("first_", ignorenulls=True).over(later).alias(coming))
    rows = rows.drop(cut).withColumn(place, x)
    upto = Window.partitionBy(key, part).orderBy(place).rangeBetween(Window.unboundedPreceding, 0)
    following = F.expr(f"lead(`{post}`) IGNORE NULLS OVER (PARTITION BY `{key}`, `{part}` ORDER BY `{place}`)")
    rows = rows.withColumns({before: F.last(post, ignorenulls=True).over(upto), after: following}).join(heads, [key, part], "left")
    here = F.col(before).isNotNull() & F.col(before)[df.schema[post].dataType.names[0]].cast("double").eqNullSafe(F.col(place))
    return rows.withColumns({before: F.coalesce(before, carried), after: F.when(here, F.col(before)).otherwise(F.coalesce(after, coming))}).drop(part, place, carried, coming)


def fixed_chunks(df: DataFrame, key: str, order: str, size: int = 512, least: int = 32, out: str = "chunk") -> DataFrame:
    """Numbers chunks of `size` rows; a last one of fewer than `least` joins the one before."""
    n = df.groupBy(key).agg((F.max(order) + 1).alias("n_"))
    tail = (F.col("n_") % size < least) & (F.col("n_") > size)
    most = F.floor((F.col("n_") - 1) / size) - F.when(tail, 1).otherwise(0)
    most = F.when(tail & (F.col("n_") % size == 0), F.floor(F.col("n_") / size) - 2).otherwise(most)
    return df.join(n, key).withColumn(out, F.least(F.floor(F.col(order) / size), most)).drop("n_")


def distance_chunks(df: DataFrame, key: str, order: str, distance: str, length: float = 30.0, out: str = "chunk") -> DataFrame:
    """Greedy chunks by distance: one ends where the distance has grown by more than `length`; a last one shorter than half joins the one before. An error where the track goes back before the chunk's start.

    Where a chunk begins depends on all before it: a track's places and distances, two numbers for each trace, are looked at in one task, which jumps from cut to cut. Samples stay out of it.
    """

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by(order)
        d = t["d_"].to_numpy()
        most = np.maximum.accumulate(d)
        cuts = [0]
        while (nxt := int(np.searchsorted(most, d[cuts[-1]] + length, "right"))) < len(d):
            cuts.append(nxt)
        begin = d[cuts]
        if len(cuts) > 1 and d[-1] - begin[-1] < length / 2:
            cuts.pop()
        chunk = np.searchsorted(cuts, np.arange(len(d)), "right") - 1
        if (d < d[cuts][chunk]).any():
            raise ValueError("the track goes backwards")
        return t.drop_columns(["d_"]).append_column(out, pa.array(chunk.astype(np.int32)))

    places = df.select(key, order, F.col(distance).cast("double").alias("d_"))
    schema = places.drop("d_").withColumn(out, F.lit(None).cast("int")).schema
    return df.join(places.groupBy(key).applyInArrow(run, schema), [key, order])


def block_stack(df: DataFrame, keys: list[str], order: str, samples: str, depth: int) -> DataFrame:
    """Sums of whole blocks of `depth` traces; an incomplete last block goes."""
    n = F.get("all_", F.lit(0))
    add = F.aggregate(F.slice("all_", 2, depth), F.transform(n, lambda x: x.cast("double")), lambda s, x: F.zip_with(s, x, lambda p, q: p + q))
    rows = df.groupBy(*keys, F.floor(F.col(order) / depth).alias("block")).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(samples).alias("s")))), lambda x: x["s"]).alias("all_"))
    return rows.where(F.size("all_") == depth).withColumn(samples, add).drop("all_")


def resampled(df: DataFrame, key: str, order: str, distance: str, step: float, values: list[str] = (), arrays: list[str] = ()) -> DataFrame:
    """key, line (from 0), distance (line * step from the product's start), and the columns linear between the rows before and after. Distances grow with order; rows that stay in place give way to the last of them, and the line at the very end goes."""
    columns = [*values, *arrays]
    start = df.groupBy(key).agg(F.min(distance).alias("start_"))
    rows = df.select(key, order, F.col(distance).cast("double").alias("x_"), *columns)
    here = F.struct("x_", *columns)
    rows = sliding(rows, key, order, 0, 1, next_=F.last(here)).where("frame_rows = 2").join(start, key)
    low, high = F.ceil((F.col("x_") - F.col("start_")) / step), F.ceil((F.col("next_.x_") - F.col("start_")) / step) - 1
    rows = rows.where(high >= low).withColumn("line", F.explode(F.sequence(low, high)))
    share = (F.col("start_") + F.col("line") * step - F.col("x_")) / (F.col("next_.x_") - F.col("x_"))
    mixed = [(F.col(c) + share * (F.col(f"next_.{c}") - F.col(c))).alias(c) for c in values]
    mixed += [F.zip_with(c, f"next_.{c}", lambda p, q: p + share * (q - p)).alias(c) for c in arrays]
    return rows.select(key, "line", (F.col("line") * step).alias(distance), *mixed)


def skipped(df: DataFrame, key: str, order: str, first: int, last: int) -> DataFrame:
    """Without the first and last traces of each product."""
    ends = df.groupBy(key).agg(F.min(order).alias("lo_"), F.max(order).alias("hi_"))
    return df.join(ends, key).where((F.col(order) >= F.col("lo_") + first) & (F.col(order) <= F.col("hi_") - last)).drop("lo_", "hi_")


def region(df: DataFrame, order: str, start: int, stop: int, most: int | None = None) -> DataFrame:
    """Rows from start to before stop, the first `most` of them; 0 or None is no bound."""
    return df.where((F.col(order) >= start) & (F.col(order) < (min(stop, start + most) if most else stop)))


def padded(df: DataFrame, key: str, order: str, samples: str, before: int, after: int, mode: str = "edge") -> DataFrame:
    """key, order (from 0 again), samples: each product with traces added at its ends, copies of the end ones or zeros."""
    if mode not in ("edge", "zeros"):
        raise ValueError(f"no such mode: {mode}")
    rows = df.select(key, order, samples)
    ends = rows.groupBy(key).agg(F.min(order).alias("lo_"), F.max(order).alias("hi_"), F.min_by(samples, order).alias("first_"), F.max_by(samples, order).alias("last_"))
    edge = lambda c: F.col(c) if mode == "edge" else F.transform(c, lambda x: x * 0)
    added = []
    for n, trace, at in ((before, "first_", lambda i: F.col("lo_") - i), (after, "last_", lambda i: F.col("hi_") + i)):
        if n > 0:
            added.append(ends.withColumn("i_", F.explode(F.sequence(F.lit(1), F.lit(n)))).select(key, at(F.col("i_")).alias(order), edge(trace).alias(samples)))
    for more in added:
        rows = united(rows, more, key)
    return rows.join(ends.select(key, "lo_"), key).withColumn(order, F.col(order) - F.col("lo_") + before).drop("lo_")


def gap_filled(df: DataFrame, key: str, order: str, samples: str, width: int) -> DataFrame:
    """key, order, samples (array of double), filled: traces, and what fills the gaps between them: silence, with cosine tapers of `width` traces from the trace before and to the trace after, laid over each other in gaps shorter than both. In gaps shorter than `width`, the weight of the trace before grows with the distance from it over the gap's length, and that of the trace after likewise.

    Only the edges of gaps are put in order, not the traces.
    """
    rows = df.select(key, order, F.col(samples).cast("array<double>").alias(samples))
    there = rows.select(key, F.col(order).alias("other_"), F.lit(True).alias("there_"))
    edges = lambda step: rows.withColumn("other_", F.col(order) + step).join(there, [key, "other_"], "left").where("there_ IS NULL")
    turn = Window.partitionBy(key).orderBy(order)
    begin = edges(1).select(key, F.col(order).alias("from_"), F.col(samples).alias("a_"), F.row_number().over(turn).alias("no_"))
    stop = edges(-1).select(key, F.col(order).alias("to_"), F.col(samples).alias("b_"), (F.row_number().over(turn) - 1).alias("no_"))
    gaps = begin.join(stop, [key, "no_"]).withColumn("n_", F.col("to_") - F.col("from_") - 1)
    x = F.col(order) - F.col("from_")
    weight = lambda d: F.when(F.col("n_") < width, d / F.col("n_")).otherwise(0.5 * F.cos(F.pi() / width * F.least(d, F.lit(width))) + 0.5)
    new = gaps.withColumn(order, F.explode(F.sequence(F.col("from_") + 1, F.col("to_") - 1))).withColumns({"u_": weight(x), "v_": weight(F.col("n_") + 1 - x)})
    new = new.select(key, order, F.zip_with("a_", "b_", lambda p, q: p * F.col("u_") + q * F.col("v_")).alias(samples), F.lit(True).alias("filled"))
    return united(rows.withColumn("filled", F.lit(False)), new, key)
