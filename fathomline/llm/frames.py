"""What the operators share: one row per id, work tables in the shared folder, and words and hashes of whole batches of texts."""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of every contract: a run of bytes other than these.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
WORD = r"[^\x20\x09-\x0D]+"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one under the warehouse where the session has none, as in tests."""
    if not (at := spark.conf.get("spark.checkpoint.dir", None)):
        at = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return at.rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """This application's work tables."""
    return f"{shared_folder(spark)}/fathomline/{spark.sparkContext.applicationId}"


def cleared(spark: SparkSession) -> None:
    """Deletes this application's work tables; frames that still read them fail from then on."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """df as a table in the shared folder: it is computed once, and a lost executor costs no more than reading it again."""
    path = f"{work_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_per_id(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row for each key that isn't null. Of rows that repeat a key, the greatest value stays (null is least); only where a look at the keys alone finds such rows are the values shuffled for it."""
    df = df.select(F.col(key).cast("long").alias(key), value).where(F.col(key).isNotNull())
    if df.groupBy(key).count().where("count > 1").isEmpty():
        return df
    return df.groupBy(key).agg(F.max(value).alias(value))


def prefix_of(df: DataFrame) -> str:
    """A start for the names of helper columns that no column of df has."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def replaced(df: DataFrame, results: dict[str, Column], prefix: str) -> DataFrame:
    """df without its helper columns, then the results; these replace columns with the same names."""
    taken = {c.lower() for c in results}
    stay = [F.col(f"`{c}`") for c in df.columns if not c.startswith(prefix) and c.lower() not in taken]
    return df.select(*stay, *(x.alias(c) for c, x in results.items()))


def words_of(text: Column | str) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x9E3779B97F4A7C15))


BASE = seeds(1, 7)[0] | np.uint64(1)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.concatenate(([np.uint64(1)], np.cumprod(np.full(n + (n >> 2), b)))) for b in (BASE, UNBASE)]
    return _POWERS


class Rolling:
    """Hashes of any slices of a sequence of 64-bit codes: a polynomial's prefix sums modulo 2^64, mixed with the length."""

    def __init__(self, codes: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(codes * _powers(len(codes) + 1)[0][: len(codes)])))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (self.sums[last] - self.sums[first]) * _powers(len(self.sums))[1][first]
            return mixed(x + (last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


BYTE_CODES = seeds(256, 3)


def pieces(texts: pa.Array, limit: int = 1 << 20):
    """Runs of whole texts of about limit bytes: first row, the bytes, and where each text starts (and the last ends). A null is empty."""
    col = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def word_slices(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last+1 byte of each word, and where each text's words start (and the last end)."""
    full = ~BLANK[data]
    before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    before[1:], after[:-1] = full, full
    before[at] = False
    begins = np.flatnonzero(full & ~before[:-1])
    edge = after[1:].copy()
    edge[at[(at > 0)] - 1] = False
    ends = np.flatnonzero(full & ~edge) + 1
    return begins, ends, np.searchsorted(begins, at)


def word_hashes(data: np.ndarray, at: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word and where each text's words start; lower: A-Z count as a-z."""
    begins, ends, words = word_slices(data, at)
    return Rolling(BYTE_CODES[LOWER[data] if lower else data]).of(begins, ends), words
