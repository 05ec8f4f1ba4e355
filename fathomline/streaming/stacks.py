"""Coherent stacks of a stream of traces."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stacks(stream: DataFrame, key: str, order: str, samples: str, depth: int, incoherent: bool = False) -> DataFrame:
    """key, block, samples (sum of depth traces; of their magnitudes with incoherent) as soon as a block of depth consecutive values of order is complete, whatever order they come in.

    The state of a block is one sum and is dropped when the block is emitted; a block that stays incomplete is never emitted. Traces without key, order or samples take no part. Each trace must come once.
    """
    columns = stream.select(F.col(key).cast("string").alias("key"), F.floor(F.col(order) / depth).alias("block"), F.col(samples).cast("array<double>").alias("samples")).dropna()

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, data = state.get if state.exists else (0, b"")
        total = np.frombuffer(data) if n else 0.0
        for frame in frames:
            rows = np.stack(frame["samples"].to_list())
            total = total + (np.abs(rows) if incoherent else rows).sum(axis=0)
            n += len(rows)
        if n < depth:
            state.update((n, np.asarray(total).tobytes()))
            return
        if state.exists:
            state.remove()
        yield pd.DataFrame({"key": [group[0]], "block": [group[1]], "samples": [total.tolist()]})

    out = columns.groupBy("key", "block").applyInPandasWithState(run, "key string, block long, samples array<double>", "n long, total binary", "append", GroupStateTimeout.NoTimeout)
    return out.withColumnRenamed("key", key).withColumnRenamed("samples", samples)
