"""A stated query set against all rows, block by block: rows of one length are packed into blocks, blocks are dealt to slabs, and each block of queries visits each slab."""

from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import partitions

#: Rows of a block, of vectors and of queries.
ROWS, QUERIES = 4096, 512
#: Blocks of the index that a task holds, some 40 MB of vectors of 64 components.
HELD = 16


def packed(df: DataFrame, rows: int, slabs: int | None, encode: Callable | None = None) -> DataFrame:
    """df: cid, v. Blocks of vectors of one length: slab, dims, cids, block (binary, doubles row by row, or what encode makes of the matrix). With slabs, a block goes to one slab; else slab is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[int, pa.Table] = {}  # of each length, fewer rows than a block
        n = TaskContext.get().partitionId()

        def emit(t: pa.Table, dims: int):
            nonlocal n
            n += 1
            m = t["v"].combine_chunks()
            m = (m.chunk(0) if isinstance(m, pa.ChunkedArray) else m).flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, dims)
            block = (encode or np.ndarray.tobytes)(np.ascontiguousarray(m, np.float64))
            return pa.record_batch([pa.array([n % slabs if slabs else None], pa.int32()), pa.array([dims], pa.int32()), pa.array([t["cid"].to_numpy().astype(np.int64).tobytes()], pa.binary()), pa.array([block], pa.binary())], ["slab", "dims", "cids", "block"])

        for batch in batches:
            size = pc.list_value_length(batch["v"])
            for dims in pc.unique(size).to_pylist():
                t = pa.Table.from_batches([batch.filter(pc.equal(size, dims))])
                t = pa.concat_tables([rest[dims], t]) if dims in rest else t
                while t.num_rows >= rows:
                    yield emit(t.slice(0, rows), dims)
                    t = t.slice(rows)
                rest[dims] = t
        for dims, t in rest.items():
            if t.num_rows:
                yield emit(t, dims)

    return df.select("cid", "v").mapInArrow(run, "slab int, dims int, cids binary, block binary")


def meet(queries: DataFrame, index: DataFrame, slabs: int, kernel: Callable, schema: str) -> DataFrame:
    """kernel(query cids, query matrix, cids, block) yields record batches of schema, for each block of queries and each block of the index of the same length.

    A slab's index blocks, about HELD, reach its task once and wait there; the blocks of queries pass by them one by one.
    """
    visiting = queries.select(F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab"), "dims", F.lit(1).alias("turn"), "cids", "block")
    both = index.select("slab", "dims", F.lit(0).alias("turn"), "cids", "block").unionByName(visiting)
    dealt = both.repartition(slabs, "slab").sortWithinPartitions("slab", "dims", "turn").select("slab", "dims", "turn", "cids", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            for slab, dims, turn, c, b in zip(*(batch[i].to_pylist() for i in range(3)), batch["cids"], batch["block"], strict=True):
                if here != (slab, dims):
                    here, held = (slab, dims), []
                cids = np.frombuffer(c.as_buffer(), np.int64)
                if turn == 0:
                    held.append((cids.copy(), bytes(b.as_buffer())))
                    continue
                q = np.frombuffer(b.as_buffer(), np.float64).reshape(-1, dims)
                for own, block in held:
                    yield from kernel(cids, q, own, block)

    return dealt.mapInArrow(run, schema)


class Best:
    """The k greatest values that a task has seen so far for each query of a block; of few blocks, those visited last. What falls below the least of them can't be among the query's best."""

    def __init__(self, k: int, blocks: int = 16):
        self.k, self.blocks, self.kept = k, blocks, OrderedDict()

    def floor(self, qids: np.ndarray, values: np.ndarray) -> np.ndarray:
        """values: a row for each query. Takes them in; the kth greatest so far, -inf while there are fewer."""
        key = qids.tobytes()
        old = self.kept.pop(key, np.full((len(qids), self.k), -np.inf))
        all_ = np.concatenate((old, values), axis=1)
        self.kept[key] = new = np.partition(all_, all_.shape[1] - self.k, axis=1)[:, -self.k :]
        if len(self.kept) > self.blocks:
            self.kept.popitem(last=False)
        return new.min(axis=1)


def slabs_of(rows: DataFrame) -> int:
    """As many slabs as the session has shuffle partitions, and more where these would hold more than HELD blocks each. rows: a written table."""
    return max(partitions(rows.sparkSession), -(-rows.count() // (ROWS * HELD)))
