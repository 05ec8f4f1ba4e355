"""Approximate nearest neighbours: a hash-prefix forest.

Each tree is a sorted array of long strings of hash bits (signs of random projections). A query descends each tree to its longest prefix matches, whose lengths vary, and then ascends in all trees at once. After each ascent the new matches are scored exactly; the angle of the kth best so far gives the chance that one as near has matched in no tree, and the ascent ends when that is small enough: where near vectors exist few rows are scored, and where none do, many. The index is dealt in blocks of bounded size, each with a forest over all its rows; a query visits each block and the best of all blocks stand. Every row is indexed; nothing is fitted.

Lengths may differ: vectors get a further coordinate that makes those of a block equally long, so that the largest inner product is the smallest angle.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import QUERIES, ROWS, Best, meet, packed, slabs_of
from .frames import written
from .vectors import distinct, finite, query_vectors, ranked

#: Trees, bits of a string, and the chance with which a neighbour as near as the kth may be missed.
TREES, BITS, MISS = 48, 24, 0.05
#: Scores this near to each other, as a share, may change places when they are summed in another order.
NEAR = 1e-9


@lru_cache(4)
def planes(dims: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dims]).standard_normal((dims + 1, count))


def strings(m: np.ndarray, extra: np.ndarray, trees: int, bits: int, seed: int) -> np.ndarray:
    """A row for each tree: the vectors' strings as whole numbers."""
    p = planes(m.shape[1], trees * bits, seed)
    worth = (1 << np.arange(bits - 1, -1, -1)).astype(np.float64)
    return (((m @ p[:-1] + extra[:, None] * p[-1]) > 0).reshape(len(m), trees, bits) @ worth).astype(np.int32).T


def level_for(cosine: np.ndarray, trees: int, miss: float) -> np.ndarray:
    """The longest prefix that two vectors at this cosine share in one tree or more, with probability 1 - miss."""
    same = np.clip(1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi, 1e-9, 1 - 1e-9)
    return np.floor(np.log(1 - miss ** (1 / trees)) / np.log(same)).astype(np.int64)


class Forest:
    """The trees of one block, as encode() has packed them."""

    def __init__(self, block, n: int, dims: int, trees: int, bits: int):
        self.n, self.bits = n, bits
        self.m = np.frombuffer(block, np.float64, n * dims).reshape(n, dims)
        self.codes, self.order = np.frombuffer(block, np.int32, offset=self.m.nbytes).reshape(2, trees, n)
        self.norm = np.sqrt((self.m**2).sum(1).max())

    @staticmethod
    def encode(m: np.ndarray, trees: int, bits: int, seed: int) -> bytes:
        square = (m * m).sum(1)
        codes = strings(m, np.sqrt(np.maximum(square.max() - square, 0)), trees, bits, seed)
        order = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
        return m.tobytes() + np.take_along_axis(codes, order, 1).tobytes() + order.tobytes()

    def ranges(self, own: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each tree and query, where the strings lie that share `level` bits."""
        low = own >> (self.bits - level) << (self.bits - level)
        find = lambda x: np.stack([np.searchsorted(c, y) for c, y in zip(self.codes, x, strict=True)])
        return find(low), find(low + (1 << (self.bits - level)))

    def nearest(self, q: np.ndarray, own: np.ndarray, k: int, miss: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows scored and their scores, for each query."""
        trees, count = own.shape
        score = np.full((count, self.n), -np.inf)
        length = np.sqrt((q**2).sum(1)) * self.norm
        level = np.full(count, self.bits)
        b, e = self.ranges(own, self.bits)
        for step in range(self.bits - 1, 0, -1):  # descended: the longest prefixes with enough matches
            few = (e - b).sum(0) < 2 * k
            if not few.any():
                break
            level[few] = step
            b[:, few], e[:, few] = self.ranges(own[:, few], step)
        todo = np.arange(count)
        while len(todo):
            for step in np.unique(level[todo]):
                some = todo[level[todo] == step]
                b, e = self.ranges(own[:, some], int(step))
                match = np.zeros((len(some), self.n), bool)
                for order, lo, size in zip(self.order, b, e - b, strict=True):
                    at = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
                    match.ravel()[order[at] + np.repeat(np.arange(len(some)) * self.n, size)] = True
                match &= score[some] == -np.inf
                if match.sum() > match.size // 16:  # so many that reading the block through is cheaper
                    score[some] = np.where(match, q[some] @ self.m.T, score[some])
                    continue
                for i, row in zip(some, match, strict=True):
                    new = np.flatnonzero(row)
                    score[i, new] = self.m[new] @ q[i]
            kth = np.partition(score[todo], self.n - min(k, self.n), axis=1)[:, self.n - min(k, self.n)]
            want = np.where(kth == -np.inf, 0, level_for(kth / np.maximum(length[todo], 1e-300), trees, miss))
            open_ = want < level[todo]
            todo, want = todo[open_], want[open_]
            level[todo] = np.maximum((level[todo] + want) // 2, 0)  # the angle still falls: half of the way
        return [(f := np.flatnonzero(s > -np.inf), s[f]) for s in score]


def search(df: DataFrame, k: int = 20, every: int = 20, trees: int = TREES, bits: int = BITS, miss: float = MISS, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible by `every` the k other rows found with the largest inner product, ties to the smaller id. A score is the sum of the products of components in their order.

    Vectors null, empty, zero, or with a null or non-finite component take no part, as do rows without id; of rows repeating an id the greatest vector counts. Vectors of different lengths have no inner product: each length is searched by itself. Other columns are not read.
    """
    rows = finite(df, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    classes = written(distinct(rows, k))
    queries = written(query_vectors(rows, classes, every))
    asked = classes.join(queries.select(F.col("qid").alias("cid")).distinct(), "cid", "left_semi")
    best = Best(k + 1)

    def nearest(qids, q, cids, block) -> Iterator[pa.RecordBatch]:
        forest = Forest(block, len(cids), q.shape[1], trees, bits)
        own = strings(q, np.zeros(len(q)), trees, bits, seed)
        out = forest.nearest(q, own, k + 1, miss)
        top = np.full((len(q), k + 1), -np.inf)
        for row, (_, s) in zip(top, out, strict=True):
            row[: min(len(s), k + 1)] = np.partition(s, len(s) - k - 1)[-(k + 1) :] if len(s) > k else s
        floor = best.floor(qids, top)
        keep = [s >= f - NEAR * (abs(f) if f > -np.inf else 0) for (_, s), f in zip(out, floor, strict=True)]  # with all ties
        yield pa.record_batch([pa.array(np.repeat(qids, [x.sum() for x in keep])), pa.array(np.concatenate([cids[f[x]] for (f, _), x in zip(out, keep, strict=True)])), pa.array(np.concatenate([s[x] for (_, s), x in zip(out, keep, strict=True)]))], ["qid", "cid", "score"])

    slabs = slabs_of(classes)
    index = packed(classes, ROWS, slabs, lambda m: Forest.encode(m, trees, bits, seed))
    found = written(meet(packed(asked, QUERIES, None), index, slabs, nearest, "qid long, cid long, score double"))
    kth = found.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc()))).where(F.col("r") == k + 1).select("qid", (F.col("score") - NEAR * F.abs("score")).alias("kth"))
    few = found.join(kth, "qid", "left").where(F.col("kth").isNull() | (F.col("score") >= F.col("kth"))).select("qid", "cid")
    # block products add up in orders of their own: the scores that count are summed again, component by component
    vectors = classes.select("cid", "v")
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    pairs = few.join(vectors, "cid").join(asked.select(F.col("cid").alias("qid"), F.col("v").alias("q")), "qid")
    return ranked(pairs.select("qid", "cid", score.alias("score")), classes, queries, k)
