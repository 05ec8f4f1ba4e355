"""Exact top-k search with vector-approximation files.

The file holds each vector's cells, a byte for each dimension, on a grid that spans its block. A query scans it for bounds of its inner product with each vector; the kth largest lower bound so far rules out every vector whose upper bound lies below. What is left is read exactly, best bound first, and the kth exact score rules out the rest. Exact scores are sums of whole numbers.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import QUERIES, ROWS, Best, meet, packed, slabs_of
from .frames import written
from .vectors import distinct, finite, query_vectors, ranked

BITS = 8


#: Whole numbers of this size and beyond don't fit 64 bits.
LONG = 2.0**63


def scaled(x: Column, scale: float) -> Column:
    """floor(scale * x) as a double; doubles from 2^52 on are whole already."""
    y = x * F.lit(scale)
    return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)


def exact_scores(pairs: DataFrame) -> DataFrame:
    """qid, cid, score of pairs with their vectors q and v of whole numbers, without the pairs whose score takes more than 64 bits. Sums that may come near that are made of Python's whole numbers."""
    most = F.aggregate(F.zip_with("q", "v", lambda a, b: F.abs(a * b)), F.lit(0.0), lambda a, x: a + x)
    large = lambda c: F.exists(c, lambda x: F.abs(x) >= LONG / 2)
    rows = pairs.withColumn("safe", (most < LONG / 2) & ~large("q") & ~large("v"))
    whole = lambda x: x.cast("long")
    fast = F.aggregate(F.zip_with("q", "v", lambda a, b: whole(a) * whole(b)), F.lit(0).cast("long"), lambda a, x: a + x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sum(int(a) * int(b) for a, b in zip(q, v, strict=True)) for q, v in zip(batch["q"].to_pylist(), batch["v"].to_pylist(), strict=True)]
            scores = [s if -(2**63) <= s < 2**63 else None for s in scores]
            yield pa.record_batch([batch["qid"], batch["cid"], pa.array(scores, pa.int64())], ["qid", "cid", "score"])

    slow = rows.where("NOT safe").select("qid", "cid", "q", "v").mapInArrow(run, "qid long, cid long, score long")
    return rows.where("safe").select("qid", "cid", fast.alias("score")).unionByName(slow.where("score IS NOT NULL"))


def search(df: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, bits: int = BITS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible by `every` the k other rows with the largest inner product of floor(scale * component), ties to the smaller id.

    Vectors null, empty, or with a component that is null, not finite or no longer finite when scaled take no part, as do rows without id; of rows repeating an id the greatest vector counts. Vectors of different lengths have no inner product: each length is searched by itself. With fewer than k others, all are returned. Scores are exact; a pair whose score takes more than 64 bits is no result, and the next best take its place. Other columns are not read.
    """
    rows = finite(df, id_col, vector_col).withColumn("v", F.transform("v", lambda x: scaled(x, scale)))
    rows = rows.where(F.forall("v", lambda x: F.abs(x) < float("inf")))
    classes = written(distinct(rows, k))
    queries = written(query_vectors(rows, classes, every))
    asked = classes.join(queries.select(F.col("qid").alias("cid")).distinct(), "cid", "left_semi")
    cell = np.uint8 if bits <= 8 else np.uint16

    def encode(m: np.ndarray) -> bytes:
        with np.errstate(over="ignore", invalid="ignore"):
            low = m.min(axis=0)
            step = np.maximum(np.floor((m.max(axis=0) - low) / 2**bits) + 1, 1)  # whole numbers: so are the cells' edges
            cells = np.nan_to_num(np.minimum((m - low) // step, 2**bits - 1))
        return low.tobytes() + step.tobytes() + cells.astype(cell).tobytes()

    best = Best(k + 1)

    def bounds(qids, q, cids, block) -> Iterator[pa.RecordBatch]:
        low, step = np.frombuffer(block, np.float64, 2 * q.shape[1]).reshape(2, -1)
        with np.errstate(over="ignore", invalid="ignore"):
            lo = np.frombuffer(block, cell, offset=16 * q.shape[1]).reshape(len(cids), -1) * step + low
            hi = lo + step - 1
            up, down = np.maximum(q, 0), np.minimum(q, 0)
            least, most = up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T
            slack = np.abs(q) @ np.maximum(np.abs(low), np.abs(low + step * 2**bits)) * q.shape[1] * 2.0**-51  # what doubles may lose; nothing below 2^53
            slack = np.where(slack < 4, 0, slack)[:, None]
            least, most = least - slack, most + slack
        # what no double holds is unknown, and a score that may take more than 64 bits is no lower bound for others
        most = np.where(np.isnan(most), np.inf, most)
        least = np.where(np.isnan(least) | (most >= LONG), -np.inf, least)
        i, j = np.nonzero(most >= best.floor(qids, least)[:, None])
        yield pa.record_batch([pa.array(qids[i]), pa.array(cids[j]), pa.array(least[i, j]), pa.array(most[i, j])], ["qid", "cid", "least", "most"])

    slabs = slabs_of(classes)
    near = written(meet(packed(asked, QUERIES, None), packed(classes, ROWS, slabs, encode), slabs, bounds, "qid long, cid long, least double, most double"))
    by_least = Window.partitionBy("qid").orderBy(F.col("least").desc())
    sure = near.withColumn("r", F.row_number().over(by_least)).where(F.col("r") <= k + 1).groupBy("qid").agg(F.when(F.count("*") > k, F.min("least")).otherwise(F.lit(float("-inf"))).alias("kth"))
    first = Window.partitionBy("qid").orderBy(F.col("most").desc(), "cid")
    left = near.join(sure, "qid").where(F.col("most") >= F.col("kth")).withColumn("turn", F.row_number().over(first))
    left = written(left.select("qid", "cid", "most", "turn"))
    vectors = classes.select("cid", "v")
    asked_vectors = asked.select(F.col("cid").alias("qid"), F.col("v").alias("q"))
    by_score = Window.partitionBy("qid").orderBy(F.col("score").desc(), "cid")
    found, rest, read, more = None, left, 0, k + 1
    while True:  # best bounds first, four times as many each time, until the kth score rules out what is left
        pairs = rest.where(F.col("turn") <= read + more).select("qid", "cid").join(vectors, "cid").join(asked_vectors, "qid")
        scores = exact_scores(pairs)
        scores = scores if found is None else scores.unionByName(found)
        found = written(scores.withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= k + 1).drop("r"))
        read, more = read + more, 4 * more
        reached = found.groupBy("qid").agg(F.when(F.count("*") > k, F.min("score").cast("double")).alias("reached"))
        rest = left.where(F.col("turn") > read).join(reached, "qid", "left").where(F.col("reached").isNull() | (F.col("most") >= F.col("reached"))).drop("reached")
        if rest.isEmpty():
            return ranked(found, classes, queries, k)
