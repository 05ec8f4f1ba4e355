"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata of a text.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pairwise part is half of (sum v_i x_i)^2 - sum (v_i x_i)^2, so a text is scored in time linear in its features. Features are made by Spark tasks from whole texts; the machine is fitted on a bounded sample of labelled documents, and its weights, whose size is fixed, go to the tasks that score.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import BYTE_CODES, LOWER, Rolling, one_per_id, pieces, word_slices
from .superwindows import marks

#: Buckets of hashed words, bins of a statistic, rank of the interactions.
BUCKETS, BINS, RANK = 1 << 15, 16, 8
#: Labelled documents to fit on, at most: those with the least hashes of their ids.
SAMPLE = 8000
THRESHOLD = 0.7


def _kinds() -> list[np.ndarray]:
    c = np.arange(256)
    chars = lambda s: np.isin(c, [ord(x) for x in s])
    upper, lower, digit = (c >= 65) & (c < 91), (c >= 97) & (c < 123), (c >= 48) & (c < 58)
    mark = (c > 32) & (c < 127) & ~upper & ~lower & ~digit
    return [upper, lower, digit, mark, chars(".,"), chars("!?"), chars("|"), chars("#$%&*@"), chars("<>{}[]=/\\"), c >= 128, chars("\n")]


KINDS = _kinds()
STATISTICS = len(KINDS) + 9
SIZE = BUCKETS + STATISTICS * BINS


def statistics(data: np.ndarray, at: np.ndarray, begins: np.ndarray, ends: np.ndarray, words: np.ndarray, unique: np.ndarray) -> np.ndarray:
    """A row of shares from 0 to 1 for each text: structure, then sizes."""
    sums = lambda mask, edge: np.diff(np.concatenate(([0], np.cumsum(mask)))[edge])
    size, n = np.maximum(np.diff(at), 1), np.maximum(np.diff(words), 1)
    length = ends - begins
    last = data[np.maximum(ends - 1, 0)] if len(ends) else data[:0]
    upper = np.concatenate(([0], np.cumsum(KINDS[0][data])))
    shout = (upper[ends] - upper[begins] == length) & (length > 1)
    out = [sums(k[data], at) / size for k in KINDS]
    out += [sums(m, words) / n for m in (KINDS[3][last], KINDS[7][last], KINDS[5][last], shout, length == 1, length > 20)]
    out += [unique / n, np.log1p(np.diff(at)) / 20, sums(length, words) / n / 20]
    return np.minimum(np.stack(out, axis=1), 1.0)


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of whole texts: first row, feature numbers, their values, and where each text's start."""
    for lo, data, at in pieces(texts):
        begins, ends, words = word_slices(data, at)
        h = Rolling(BYTE_CODES[LOWER[data]]).of(begins, ends)
        doc = np.repeat(np.arange(len(at) - 1), np.diff(words))
        key = np.sort(doc * BUCKETS + (h >> np.uint64(49)).astype(np.int64))
        new = np.flatnonzero(marks(key))
        doc, no, count = key[new] // BUCKETS, key[new] % BUCKETS, np.diff(np.append(new, len(key)))
        value = np.log1p(count)
        norm = np.sqrt(np.bincount(doc, value * value, len(at) - 1))
        value = value / np.maximum(norm, 1e-9)[doc]
        s = statistics(data, at, begins, ends, words, np.bincount(doc, minlength=len(at) - 1))
        bins = np.minimum((np.sqrt(s) * BINS).astype(np.int64), BINS - 1) + np.arange(STATISTICS) * BINS + BUCKETS
        edge = np.searchsorted(doc, np.arange(len(at)))
        order = np.argsort(np.concatenate((doc, np.repeat(np.arange(len(at) - 1), STATISTICS))), kind="stable")
        yield lo, np.concatenate((no, bins.ravel()))[order], np.concatenate((value, np.full(bins.size, 0.25)))[order], edge + np.arange(len(at)) * STATISTICS


@dataclass
class Machine:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def parts(self, no: np.ndarray, x: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Raw scores, and what the gradient needs: v x of each feature and its sum over each text."""
        vx = self.v[no] * x[:, None]
        add = lambda a: np.add.reduceat(a, edge[:-1], axis=0)  # noqa: E731  every text has its statistics: no empty run
        total = add(vx)
        return self.bias + add(self.w[no] * x) + 0.5 * (total**2 - add(vx**2)).sum(axis=1), vx, total

    def score(self, no: np.ndarray, x: np.ndarray, edge: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.parts(no, x, edge)[0], -40, 40)))


def fitted(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, rate: float = 0.02, decay: float = 1e-4, seed: int = 5) -> Machine:
    """Adam on the logistic loss, in a fixed order of draws."""
    r = np.random.default_rng(seed)
    m = Machine(float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))), np.zeros(SIZE), r.normal(0, 0.02, (SIZE, RANK)))
    state = [np.zeros_like(m.w), np.zeros_like(m.w), np.zeros_like(m.v), np.zeros_like(m.v)]
    step = 0
    for _ in range(epochs):
        order = r.permutation(len(rows))
        for lo in range(0, len(order), 128):
            some = order[lo : lo + 128]
            no, x = (np.concatenate([rows[i][k] for i in some]) for k in (0, 1))
            size = np.array([len(rows[i][0]) for i in some])
            edge = np.concatenate(([0], np.cumsum(size)))
            raw, vx, total = m.parts(no, x, edge)
            g = np.repeat((1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[some]) / len(some), size)
            touched, to = np.unique(no, return_inverse=True)
            step += 1
            m.bias -= rate * g[edge[:-1]].sum()
            gw = np.bincount(to, g * x, len(touched)) + decay * m.w[touched]
            slope = (g * x)[:, None] * (np.repeat(total, size, axis=0) - vx)
            gv = np.stack([np.bincount(to, slope[:, f], len(touched)) for f in range(RANK)], axis=1) + decay * m.v[touched]
            for p, d, a, b in ((m.w, gw, state[0], state[1]), (m.v, gv, state[2], state[3])):
                a[touched] = 0.9 * a[touched] + 0.1 * d
                b[touched] = 0.99 * b[touched] + 0.01 * d * d
                p[touched] -= rate * (a[touched] / (1 - 0.9**step)) / (np.sqrt(b[touched] / (1 - 0.99**step)) + 1e-6)
    return m


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """Fits on the `sample` labelled documents with the least hashes, without those held out. None without labels."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.crc32(F.concat(F.lit("sample"), F.col("doc_id").cast("string")).cast("binary")), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, no, x, edge in features(batch["text"]):
                cut = list(zip(edge[:-1], edge[1:], strict=True))
                yield pa.record_batch([batch["doc_id"].slice(lo, len(cut)), batch["quality"].slice(lo, len(cut)), pa.array([no[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary()), pa.array([x[a:b].astype(np.float32).tobytes() for a, b in cut], pa.binary())], ["doc_id", "quality", "no", "x"])

    some = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").mapInArrow(run, "doc_id long, quality int, no binary, x binary")  # at most `sample` rows of 12 bytes
    got = sorted(some.collect(), key=lambda r: r["doc_id"])
    if not got:
        return None
    rows = [(np.frombuffer(r["no"], np.int32), np.frombuffer(r["x"], np.float32).astype(np.float64)) for r in got]
    return fitted(rows, np.array([r["quality"] for r in got], float))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out (kept out of learning: crc32 of the id as text, modulo 4, is 2), score (0 to 1) and predicted (1 if score >= threshold).

    Every row is scored on its whole text; a null text counts as empty. Without labels every score is 1: nothing is known against a document. Labels that are null or neither 0 nor 1 don't count; of labels repeating an id the least does. Rows with a null id are scored but never learnt from. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    of_one = one_per_id(docs, "doc_id", "text") if docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").limit(1).count() else docs
    machine = fit(of_one, labels, sample)
    if machine:
        machine = Machine(machine.bias, machine.w.astype(np.float32), machine.v.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, no, x, edge in features(batch["text"]):
                n = len(edge) - 1
                s = machine.score(no, x.astype(np.float32), edge).astype(float) if machine else np.ones(n)
                yield pa.record_batch([batch["doc_id"].slice(lo, n), pa.array(s)], ["doc_id", "score"])

    out = docs.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that the classifier doesn't reject."""
    machine = fit(one_per_id(docs, "doc_id", "text"), labels, sample)
    if not machine:
        return docs
    machine = Machine(machine.bias, machine.w.astype(np.float32), machine.v.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, no, x, edge in features(batch["text"]):
                keep = machine.score(no, x.astype(np.float32), edge) >= threshold
                yield batch.slice(lo, len(edge) - 1).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
