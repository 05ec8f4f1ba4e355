"""Mixing sources to target weights, with DataFrame functions only.

Each record gets a hash-random key. A source is range-sorted by that key: its key space is cut into equal ranges, which hold about as many rows each, however hot the source. Sums of the ranges give each range's offset in its source, a running sum within the range gives each record's, and a source is cut where its budget ends: whole passes first, then the records up to the rest.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import WORD, partitions, prefix_of, replaced, words_of, written

KEY_BITS = 60


def key_of(*parts: Column | str) -> Column:
    """A 60-bit hash of values as text, the same in any engine that has md5."""
    text = F.concat_ws(":", *(F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def range_of(key: Column, bits: int) -> Column:
    return F.shiftright(key, KEY_BITS - bits).cast("int")


def targets(totals: DataFrame, share: float, most: float, weights: tuple[float, ...]) -> DataFrame:
    """totals: source, source_size; a row for each source, of which there are few. Adds target: share times all sizes by weight, but no more than most times the source's size; what lies above goes to the others by weight."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    one = totals.withColumn("no", F.row_number().over(order)).withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("no") - 1) % len(weights) + 1))
    one = one.withColumn("cap", F.col("source_size") * float(most)).withColumn("whole", F.sum("source_size").over(Window.partitionBy()) * float(share))
    rank = Window.orderBy(F.col("cap") / F.col("weight"), "no")  # sources reach their caps in this order
    before, rest = rank.rowsBetween(Window.unboundedPreceding, -1), rank.rowsBetween(0, Window.unboundedFollowing)
    one = one.withColumn("left", F.col("whole") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("shares", F.sum("weight").over(rest))
    one = one.withColumn("full", F.col("cap") * F.col("shares") <= F.col("weight") * F.col("left"))
    every = Window.partitionBy()
    level = (F.max("whole").over(every) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)) / F.nullif(F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(every), F.lit(0.0))
    return one.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight"))).alias("target"))


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with helper columns of prefix_of(df): size (words), key and range of the key space."""
    p, bits = prefix_of(df), max(1, math.ceil(math.log2(4 * partitions(df.sparkSession))))
    rows = df.withColumns({f"{p}size": words_of(F.col(f"`{text_col}`")), f"{p}key": key_of(F.col(f"`{id_col}`"))})
    return rows.withColumn(f"{p}range", range_of(F.col(f"{p}key"), bits))


def budgeted(rows: DataFrame, p: str, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = (3.0, 1.0, 2.0), id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """rows of sized() with p its prefix; see mix."""
    size, source, range_ = F.col(f"{p}size"), F.col(f"`{source_col}`"), F.col(f"{p}range")
    sums = rows.groupBy(source.alias("source"), range_.alias("range")).agg(F.sum(size).alias("size"))
    goal = targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), share, most, weights)
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0))).drop("size")
    offsets = offsets.alias("o").join(goal.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source"))).select(F.col("o.source").alias(f"{p}source2"), F.col("range").alias(f"{p}range2"), F.col("before").alias(f"{p}before"), F.col("source_size").alias(f"{p}source_size"), F.col("target").alias(f"{p}target"))
    rows = rows.join(offsets, source.eqNullSafe(F.col(f"{p}source2")) & (range_ == F.col(f"{p}range2")))
    running = Window.partitionBy(source, range_).orderBy(f"{p}key", F.col(f"`{id_col}`"), size).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    source_size, budget = F.col(f"{p}source_size"), F.floor(F.col(f"{p}target") + 0.5)
    rows = rows.withColumn(f"{p}start", F.col(f"{p}before") + F.sum(size).over(running) - size)
    rows = rows.withColumn(f"{p}whole", F.when(source_size > 0, F.floor(budget / F.greatest(source_size, F.lit(1)))).otherwise(0).cast("long"))
    whole = F.col(f"{p}whole")
    part = F.greatest(F.lit(0), F.least(size, budget - whole * source_size - F.col(f"{p}start")))
    return replaced(rows, {"size": size, "source_size": source_size, "target": F.col(f"{p}target"), "whole": whole, "taken": (whole * size + part).cast("long")}, p)


def mix(df: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = (3.0, 1.0, 2.0), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """df's rows with size (words), source_size, target, whole (passes over the source) and taken (words that the mix takes).

    Sources in order of code point, null last, have the weights in turn. A source's budget is its target, rounded. A null or blank text has size 0 and takes nothing. Rows that repeat an id, or have none, each count for themselves. An empty table gives none. All of df's columns stay, but for those with the names of results, which these replace.
    """
    return budgeted(sized(df, id_col, text_col), prefix_of(df), share, most, weights, id_col, source_col)


def digest(df: DataFrame, **params) -> DataFrame:
    """doc_id, size, source_size, target, taken. Texts are read once: sizes and keys are written, without them."""
    slim = written(sized(df.select("doc_id", "source", "text")).drop("text"))
    return budgeted(slim, prefix_of(df.select("doc_id", "source", "text")), **params).select("doc_id", "size", "source_size", "target", "taken")


def mixed_rows(df: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """The mix itself, with df's columns: a row for each pass over a record, and the first words of the record at which a source is cut, joined by one space.

    Records of no words (null, empty or blank texts) stay once. Rows that repeat an id, or have none, are records of their own. An empty table gives none. n_chars, where there is one, follows a text that is cut.
    """
    p = prefix_of(df)
    own = lambda c: F.col(f"{p}row.`{c}`")
    taken = mix(df.withColumn(f"{p}row", F.struct(*(F.col(f"`{c}`") for c in df.columns))), text_col=text_col, **params)
    part = F.col("taken") - F.col("whole") * F.col("size")
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("whole") + F.when(part > 0, 1).otherwise(0)).cast("int")
    rows = taken.withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(1))))).where(F.col(f"{p}copy") <= copies)
    cut = (F.col(f"{p}copy") > F.col("whole")) & (part < F.col("size")) & (F.col("size") > 0)
    rows = rows.withColumn(f"{p}text", F.when(cut, F.array_join(F.slice(F.regexp_extract_all(own(text_col), F.lit(WORD), F.lit(0)), 1, part.cast("int")), " ")).otherwise(own(text_col)))
    follows = lambda c: F.coalesce(F.char_length(f"{p}text").cast(df.schema[c].dataType), own(c))
    return rows.select(*((F.col(f"{p}text") if c == text_col else follows(c) if c == "n_chars" else own(c)).alias(c) for c in df.columns))
