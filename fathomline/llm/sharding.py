"""Sharding by rendezvous hashing, with DataFrame functions only.

Each record's key is hashed with each shard; the record goes to the shard with the least -ln(u) / weight. A further shard takes the rows that it wins and moves no other. Slots number a shard's rows by hash ranges: counts of the ranges give offsets, a row number within the range the rest, so that a shard is never gathered into one task.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import partitions, prefix_of, replaced, written
from .mixing import key_of, range_of


def bids(key: Column | str, weights: list[float]) -> Column:
    """An array of structs, one for each shard; the least wins."""
    out = []
    for shard, w in enumerate(weights):
        u = key_of(key, F.lit(shard))
        out.append(F.struct((-F.log((F.shiftright(u, 8) + 0.5) / 2.0**52) / w).alias("cost"), (-u).alias("tie"), F.lit(shard).alias("shard")))
    return F.array(*out)


def dealt(df: DataFrame, weights: list[float], more: float | None, key_col: str, text_col: str) -> DataFrame:
    """df with helper columns of prefix_of(df): size, crc, shard, grown and at, a hash that orders a shard's rows."""
    p, n = prefix_of(df), len(weights)
    key, text = F.col(f"`{key_col}`"), F.col(f"`{text_col}`")
    rows = df.withColumns({f"{p}size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1, f"{p}crc": F.crc32(F.coalesce(text, F.lit("")).cast("binary")), f"{p}bids": bids(key, [*weights, *([more] if more else [])])})
    return rows.withColumns({f"{p}shard": F.array_min(F.slice(f"{p}bids", 1, n))["shard"], f"{p}grown": F.array_min(f"{p}bids")["shard"] if more else F.lit(None).cast("int"), f"{p}at": key_of(key, F.col(f"{p}size"))}).drop(f"{p}bids")


def numbered(rows: DataFrame, p: str, shards: int, key_col: str) -> DataFrame:
    """rows of dealt() with p its prefix; see shard."""
    bits = max(1, math.ceil(math.log2(max(2, 4 * partitions(rows.sparkSession) / shards))))
    rows = rows.withColumn(f"{p}range", range_of(F.col(f"{p}at"), bits))
    earlier = Window.partitionBy(f"{p}s").orderBy(f"{p}r").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col(f"{p}shard").alias(f"{p}s"), F.col(f"{p}range").alias(f"{p}r")).agg(F.count("*").alias(f"{p}n"))
    counts = counts.withColumn(f"{p}before", F.coalesce(F.sum(f"{p}n").over(earlier), F.lit(0))).drop(f"{p}n")
    rows = rows.join(counts, (F.col(f"{p}shard") == F.col(f"{p}s")) & (F.col(f"{p}range") == F.col(f"{p}r")))
    own = Window.partitionBy(f"{p}shard", f"{p}range").orderBy(f"{p}at", F.col(f"`{key_col}`"), f"{p}crc")
    rows = rows.withColumn(f"{p}slot", (F.col(f"{p}before") + F.row_number().over(own) - 1).cast("long"))
    return replaced(rows, {"size": F.col(f"{p}size"), "text_crc32": F.col(f"{p}crc"), "shard": F.col(f"{p}shard"), "slot": F.col(f"{p}slot"), "grown_shard": F.col(f"{p}grown")}, p)


def shard(df: DataFrame, weights: list[float] | int = 16, more: float | None = 1.0, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df's rows with size (UTF-8 bytes of the text and 1), text_crc32, shard, slot (from 0 without gaps in each shard) and grown_shard, the shard once another of weight `more` stands last.

    weights: of the shards, above 0, or their number. A null text has no bytes. Rows that repeat a key go to one shard, as do all with a null key; each has its own slot. An empty table gives no rows. All of df's columns stay, but for those with the names of results, which these replace.
    """
    weights = [1.0] * weights if isinstance(weights, int) else list(weights)
    return numbered(dealt(df, weights, more, key_col, text_col), prefix_of(df), len(weights), key_col)


def digest(df: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id and the results. Texts are read once: sizes, sums and shards are written, without them."""
    df = df.select("doc_id", "text")
    slim = written(dealt(df, [1.0] * shards, 1.0, "doc_id", "text").drop("text"))
    return numbered(slim, prefix_of(df), shards, "doc_id")
