"""Whitening of embeddings by the largest principal components, found with a block Jacobi-Davidson method.

The covariance is never made: a product with a block of directions is one pass over the rows, which are centred before they are multiplied, and the tasks' sums are added by key. The driver keeps a search space of at most four directions for each component. A Rayleigh-Ritz step gives the best components in it; each that isn't locked yet asks for a correction, the solution of (1 - QQ')(V - t)(1 - QQ') z = -r with the locked and the current components in Q, and inner MINRES steps approach it, one pass for all components together. A component is locked when its residual is down to what doubles can hold.
"""

import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written

SCALE, OFFSET, COMPONENTS = 64.0, 1_000_000, 32
#: Rows of a block; directions that a search space begins and ends with, by components; inner steps; outer rounds at most.
ROWS, BEGIN, END, INNER, ROUNDS = 4096, 1.25, 4.0, 6, 200
#: A residual counts as zero below so many units in the last place of the largest eigenvalue; one that no longer falls, below the second.
SHARP, DULL = 16 * 2.0**-52, 4096 * 2.0**-52
#: Whole numbers of this size or more are not exact as doubles.
WHOLE = 2.0**53
#: Doubles of a partial sum that are sent together.
SLICE = 1024


def blocks(df: DataFrame, scale: float, offset: int, id_col: str, vector_col: str) -> DataFrame:
    """A written table: dims, ids (array<long>), x (binary: whole numbers of 64 bits, row by row); blocks of rows of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch["n"])
            for dims in np.unique(size).tolist():
                t = batch.filter(pa.array(size == dims))
                m = t["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                x = np.floor(scale * m) + offset
                some = np.flatnonzero((np.abs(x) < WHOLE).all(1))
                for lo in range(0, len(some), ROWS):
                    part = some[lo : lo + ROWS]
                    yield pa.record_batch([pa.array([dims], pa.int32()), pa.array([t["vec_id"].take(pa.array(part)).to_pylist()], pa.list_(pa.int64())), pa.array([x[part].astype("<i8").tobytes()], pa.binary())], ["dims", "ids", "x"])

    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return written(rows.withColumn("n", F.size("v")).mapInArrow(run, "dims int, ids array<long>, x binary"))


def matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch["x"]:
            yield np.frombuffer(x.as_buffer(), "<i8").reshape(-1, dims)


def summed(table: DataFrame, dims: int, partial: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Adds up partial(matrix), a flat array of `width` doubles for each block: in each task, then in a shuffle that deals slices of the array. Slices are added in the tasks' order, so that a rerun gives the same."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(width), TaskContext.get().partitionId()
        for x in matrices(batches, dims):
            total += partial(x)
        at = range(0, width, SLICE)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array([part] * len(at), pa.int32()), pa.array([total[i : i + SLICE].tobytes() for i in at], pa.binary())], ["at", "part", "s"])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, s in zip(batch["at"].to_pylist(), batch["s"], strict=True):
                new = np.frombuffer(s.as_buffer())
                totals[at] = totals[at] + new if at in totals else new
        yield pa.record_batch([pa.array(totals, pa.int64()), pa.array([x.tobytes() for x in totals.values()], pa.binary())], ["at", "s"])

    parts = table.select("x").mapInArrow(first, "at long, part int, s binary").repartition("at").sortWithinPartitions("at", "part")
    out = np.zeros(width)
    for at, s in parts.mapInArrow(second, "at long, s binary").collect():
        out[at : at + SLICE] = np.frombuffer(s)
    return out


class Fit:
    """The rows of one length: n, exact sums S, and products with the covariance. The centre is S // n and a rest below 1, taken off one after the other, so that nothing is rounded before it is small."""

    def __init__(self, table: DataFrame, dims: int):
        self.table, self.dims = table, dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, np.zeros(dims, object)
            for x in matrices(batches, dims):
                n += len(x)
                total += (x >> 32).sum(0).astype(object) * 2**32 + (x & 0xFFFFFFFF).sum(0).astype(object)
            yield pa.record_batch([pa.array(range(dims)), pa.array([n] * dims), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], ["d", "n", "s"])

        got = table.select("x").mapInArrow(run, "d long, n long, s decimal(38,0)").groupBy("d").agg(F.sum("n"), F.sum("s")).collect()
        self.n = got[0][1]
        whole, rest = zip(*(divmod(int(s), self.n) for _, _, s in sorted(got)), strict=True)
        self.whole, self.over = np.array(whole, np.int64), np.array(rest, np.int64)
        self.rest = self.over / self.n
        self.trace = self.total(lambda c: np.array([(c * c).sum()]), 1)[0] / self.n

    def total(self, f: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        """f(centred matrix), added up over all blocks: one pass."""
        whole, rest = self.whole, self.rest
        return summed(self.table, self.dims, lambda x: f((x - whole) - rest), width)

    def product(self, u: np.ndarray) -> np.ndarray:
        """The covariance times the columns of u."""
        return self.total(lambda c: (c.T @ (c @ u)).ravel(), u.size).reshape(u.shape) / self.n

    def identity_error(self, w: np.ndarray) -> float:
        """The largest absolute entry of the covariance of centred rows times w, less the identity."""
        k = w.shape[1]
        mean = self.total(lambda c: (c @ w).sum(0), k) / self.n

        def outer(c: np.ndarray) -> np.ndarray:
            y = c @ w - mean
            return (y.T @ y).ravel()

        return float(np.abs(self.total(outer, k * k).reshape(k, k) / self.n - np.eye(k)).max())


def orthonormal(z: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Columns that span what z adds to the basis; what lies within it up to rounding is left out."""
    for _ in range(3):
        size = np.sqrt((z * z).sum(0))
        z = z[:, size > 0] / size[size > 0]
        z = z - basis @ (basis.T @ z)
        if not z.shape[1]:
            return z
        u, s, _ = np.linalg.svd(z, full_matrices=False)
        z = u[:, s > 1e-8]
    return z


def minres(product: Callable, right: np.ndarray, steps: int) -> np.ndarray:
    """Columns z for which product(z) is as near right as the Krylov spaces of `steps` dimensions allow: a symmetric Lanczos process for each column, all advanced by the same products, and the least residual in each space."""
    norm = np.sqrt((right * right).sum(0))
    vs, t = [right / np.where(norm > 0, norm, 1)], np.zeros((right.shape[1], steps + 1, steps))
    beta = np.zeros(right.shape[1])
    for j in range(steps):
        y = product(vs[j])
        alpha = (vs[j] * y).sum(0)
        y = y - alpha * vs[j] - (beta * vs[j - 1] if j else 0)
        for v in vs:  # what rounding has brought back
            y = y - (v * y).sum(0) * v
        t[:, j, j] = alpha
        if j:
            t[:, j - 1, j] = beta
        beta = np.sqrt((y * y).sum(0))
        beta = np.where(beta > 1e-12 * np.abs(t).max((1, 2), initial=0), beta, 0)
        t[:, j + 1, j] = beta
        vs.append(y / np.where(beta > 0, beta, 1) * (beta > 0))
    start = np.zeros((steps + 1, right.shape[1]))
    start[0] = norm
    y = np.stack([np.linalg.lstsq(a, b, rcond=1e-14)[0] for a, b in zip(t, start.T, strict=True)], 1)
    return sum(v * c for v, c in zip(vs, y, strict=False))


def largest(product: Callable[[np.ndarray], np.ndarray], dims: int, k: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric operator, falling, unit eigenvectors in columns, and the norms of their residuals."""
    k = min(k, dims)
    random = np.random.default_rng(seed)
    locked, basis = np.zeros((dims, 0)), np.zeros((dims, 0))
    basis = orthonormal(random.standard_normal((dims, min(dims, math.ceil(BEGIN * k)))), basis)
    image, before, top = product(basis), None, 0.0
    for _ in range(ROUNDS):
        h = basis.T @ image
        e, s = np.linalg.eigh((h + h.T) / 2)
        e, s = e[::-1], s[:, ::-1]
        basis, image = basis @ s, image @ s
        want = k - locked.shape[1]
        u, r = basis[:, :want], image[:, :want] - basis[:, :want] * e[:want]
        r = r - locked @ (locked.T @ r)
        size = np.sqrt((r * r).sum(0))
        top = max(top, abs(e[0]))
        full = locked.shape[1] + basis.shape[1] == dims
        done = (size <= SHARP * top) | full
        if before is not None:  # as small as rounding lets it be
            done |= (size <= DULL * top) & (size > before[-want:] / 2)
        before = size
        n = want if done.all() else int(np.argmin(done))  # from the largest on: one that is still missing can't be passed over
        locked, basis, image = np.hstack((locked, basis[:, :n])), basis[:, n:], image[:, n:]
        if n == want:
            break
        u, r, theta = u[:, n:], r[:, n:], e[n:want]
        if basis.shape[1] + u.shape[1] > END * k:
            basis, image = basis[:, : max(math.ceil(BEGIN * k), u.shape[1])], image[:, : max(math.ceil(BEGIN * k), u.shape[1])]
        known = np.hstack((locked, u))
        out = lambda y: y - known @ (known.T @ y)
        todo = ~done[n:]
        z = minres(lambda y: out(product(y) - theta[todo] * y), -out(r[:, todo]), INNER)
        both = np.hstack((locked, basis))
        new = orthonormal(z, both)
        if not new.shape[1]:
            new = orthonormal(random.standard_normal((dims, 1)), both)
        basis, image = np.hstack((basis, new)), np.hstack((image, product(new)))
    else:
        raise ArithmeticError(f"residuals still at {size.max() / top:.1e} of the largest eigenvalue after {ROUNDS} rounds")
    q = np.linalg.qr(locked)[0]
    image = product(q)
    h = q.T @ image
    e, s = np.linalg.eigh((h + h.T) / 2)
    e, q, image = e[::-1], (q @ s)[:, ::-1], (image @ s)[:, ::-1]
    return e, q, np.sqrt(((image - q * e) ** 2).sum(0))


def whiten(df: DataFrame, k: int = COMPONENTS, scale: float = SCALE, offset: int = OFFSET, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error: a row for each row that takes part and each of its first k components, or as many as it has dimensions.

    A component c becomes floor(scale * c) + offset. Rows without a vector, with an empty one, or with a null or non-finite component take no part, nor do those with a value of 2^53 or more after scaling, which doubles don't hold. Rows that repeat an id, or have none, count each for itself. Vectors of different lengths have no common covariance: each length is fitted by itself, one after the other, and n is its rows. A component of no variance (one row alone, equal rows, fewer rows than components) has whitened null and explained 0, or null where there is no variance at all; identity_error is over the others. deviation is null beyond 64 bits. Other columns are not read.
    """
    table = blocks(df, scale, offset, id_col, vector_col)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = [_whitened(table.where(F.col("dims") == d), d, k, schema) for (d,) in sorted(table.select("dims").distinct().collect())]
    return reduce(DataFrame.unionByName, out) if out else df.sparkSession.createDataFrame([], schema)


def _whitened(table: DataFrame, dims: int, k: int, schema: str) -> DataFrame:
    fit = Fit(table, dims)
    e, q, _ = largest(fit.product, dims, k)
    some = e > dims * 2.0**-52 * max(e[0], 0)
    w = q[:, some] / np.sqrt(e[some])
    error = fit.identity_error(w) if some.any() else None
    explained = [(float(x) if own else 0.0) / fit.trace if fit.trace > 0 else None for x, own in zip(e, some, strict=True)]
    n, whole, over, rest, names = fit.n, fit.whole, fit.over, fit.rest, [f.split()[0] for f in schema.split(", ")]
    count = len(e)
    column = np.flatnonzero(some)

    def deviations(x: np.ndarray) -> list[int | None]:
        a = x - whole
        far = (np.abs(a).max(1) + 1.0) * n
        safe = far * far * dims < 2.0**62
        y = np.where(safe[:, None], a, 0) * n - over
        sums = (y * y).sum(1).tolist()
        for i in np.flatnonzero(~safe):
            exact = sum((n * int(v) - int(o)) ** 2 for v, o in zip(a[i], over, strict=True))
            sums[i] = exact if exact < 2**63 else None
        return sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch["ids"].to_pylist(), matrices([batch], dims), strict=True):
                for lo in range(0, len(ids), 256):
                    part, own = x[lo : lo + 256], ids[lo : lo + 256]
                    white = np.full((len(own), count), np.nan)
                    white[:, column] = ((part - whole) - rest) @ w
                    times = np.repeat(np.arange(len(own)), count)
                    yield pa.record_batch(
                        [
                            pa.array(own, pa.int64()).take(pa.array(times)),
                            pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(own))),
                            pa.array(np.full(len(times), n)),
                            pa.array(deviations(part), pa.int64()).take(pa.array(times)),
                            pa.array(white.ravel(), from_pandas=True),
                            pa.array(explained * len(own), pa.float64()),
                            pa.array([error] * len(times), pa.float64()),
                        ],
                        names,
                    )

    return table.select("ids", "x").mapInArrow(run, schema)
