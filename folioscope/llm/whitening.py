"""Whitening of embeddings by contour integration of their covariance (FEAST).

Entries become integers, so counts and sums are exact. The covariance is centred before it is
multiplied: each task adds up the products of its own rows, and the sums of tasks meet in a tree,
row by row of the matrix. Only the matrix, as large as the square of the dimension whatever the
number of vectors, reaches the driver. Its leading eigenpairs are found as follows.

1. Inertia: by a symmetric factorisation of the covariance less a shift, the signs of its pivots
   count the eigenvalues above the shift. Shifts are counted side by side in Spark tasks until one
   is known that as many eigenvalues as wanted lie above, and the spectrum above it is dealt into
   intervals of a few eigenvalues each.
2. Projection: around each interval a circle is drawn, and the spectral projector is a Gauss-
   Legendre quadrature of the resolvent on it. Each node is a solve of the covariance, shifted by a
   complex number, for a block of vectors; intervals and nodes are rows that Spark deals out.
3. Rayleigh-Ritz in the projected space gives eigenpairs of the interval, and the block of the
   next round, until the residuals are as small as double precision allows.
4. The pairs of all intervals are brought together by one more Rayleigh-Ritz step, and their
   number has to be the inertia count. If not, the work is repeated with larger blocks.

Defined cases: a vector that is null, empty, holds a null or a value that isn't finite (or that no
64-bit integer can hold) is dropped. Vectors of different lengths have no common covariance; those
of each length are whitened by themselves. Components whose variance is below ``FLOOR`` of the
largest can't be told from rounding and are left out, so equal vectors, or a single one, have no
components and give no rows. Of equal eigenvalues any orthonormal basis is taken, the same for all
rows. Repeated rows are rows like any other. An empty table gives no rows. Other columns, of any
name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
#: Least share of the largest eigenvalue that counts as variance.
FLOOR = 1e-11
NODES = 8
SHIFTS = 32
PER_INTERVAL = 6
ROUNDS = 40


# --- vectors ------------------------------------------------------------------


def usable(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``id, vector, length`` of the vectors that can be used."""
    vector = F.col(embedding).cast("array<double>")
    sound = F.forall(vector, lambda c: F.coalesce(F.abs(c) < 2.0**52, F.lit(False)))
    found = rows.select(F.col(vec_id).alias("id"), vector.alias("vector")).where(F.col(embedding).isNotNull() & sound)
    return found.withColumn("length", F.size("vector")).where("length > 0")


def _integers(batch: pa.RecordBatch, length: int) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, length) + OFFSET


class _Centre:
    """Takes the exact mean ``sums / n`` from integers: its whole part first, so that nothing is
    lost to the offset."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.part = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part


def _row_sums(groups: pa.Table, total) -> pa.Table:
    """The sum of the lists of a group."""
    values = np.stack([np.asarray(v) for v in groups.column("values").to_pylist()])
    first = groups.slice(0, 1).drop_columns(["values"])
    return first.append_column("values", pa.array([total(values)], groups.schema.field("values").type))


def _summed(parts: DataFrame, kind: str) -> dict[int, list]:
    """Lists by ``row`` added up over ``part``, in two steps."""
    schema = f"branch int, row int, values array<{kind}>"

    def add(group: pa.Table) -> pa.Table:
        return _row_sums(group, lambda v: v.sum(axis=0))

    branches = parts.select((F.col("part") % 64).alias("branch"), "row", "values")
    once = branches.groupBy("branch", "row").applyInArrow(add, schema)
    twice = once.select(F.lit(0).alias("branch"), "row", "values").groupBy("row").applyInArrow(add, schema)
    return {r["row"]: r["values"] for r in twice.collect()}


def _partial(vectors: DataFrame, fn, kind: str) -> dict[int, list]:
    """Sums over all rows of the matrices that ``fn`` makes of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = fn(batch)
                total = one if total is None else total + one
        if total is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(total), pa.int32()),
                    pa.array(range(len(total)), pa.int32()),
                    pa.array(list(total), pa.list_(pa.from_numpy_dtype(total.dtype))),
                ],
                names=["part", "row", "values"],
            )

    return _summed(vectors.mapInArrow(run, f"part int, row int, values array<{kind}>"), kind)


def _sums(vectors: DataFrame, length: int) -> tuple[int, list[int]]:
    def one(batch: pa.RecordBatch) -> np.ndarray:
        x = _integers(batch, length)
        return np.append(x.sum(axis=0), len(x))[None, :]

    *sums, n = _partial(vectors, one, "bigint")[0]
    return n, sums


def _covariance(vectors: DataFrame, length: int, centre: _Centre) -> np.ndarray:
    def one(batch: pa.RecordBatch) -> np.ndarray:
        y = centre(_integers(batch, length))
        return y.T @ y

    found = _partial(vectors, one, "double")
    matrix = np.array([found[i] for i in range(length)]) / centre.n
    return (matrix + matrix.T) / 2


# --- eigenpairs ---------------------------------------------------------------


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``: the positive pivots of a symmetric
    factorisation with pivots of one or two rows."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0
    bound = (1 + np.sqrt(17)) / 8
    while k < n:
        size, swap = 1, k
        below = np.abs(a[k + 1 :, k])
        most = below.max() if len(below) else 0.0
        if max(abs(a[k, k]), most) == 0:
            k += 1
            continue
        if abs(a[k, k]) < bound * most:
            far = k + 1 + int(below.argmax())
            row = np.abs(a[far, k:])
            row[far - k] = 0
            if abs(a[k, k]) * row.max() < bound * most**2:
                if abs(a[far, far]) >= bound * row.max():
                    swap = far
                else:
                    size, swap = 2, far
        at = k + size - 1
        if swap != at:
            a[[at, swap], k:] = a[[swap, at], k:]
            a[k:, [at, swap]] = a[k:, [swap, at]]
        after = k + size
        if size == 1:
            positive += a[k, k] > 0
            a[after:, after:] -= np.outer(a[after:, k], a[after:, k] / a[k, k])
        else:
            # such a pivot has one eigenvalue of either sign
            positive += 1
            block = a[after:, k:after]
            a[after:, after:] -= block @ np.linalg.solve(a[k:after, k:after], block.T)
        k = after
    return int(positive)


def _counts(spark: SparkSession, shared, shifts: list[float]) -> dict[float, int]:
    def run(batches):
        for batch in batches:
            yield batch.assign(above=[count_above(shared.value, s) for s in batch["shift"]])

    rows = spark.createDataFrame([(float(s),) for s in shifts], "shift double").repartition(len(shifts))
    return {r["shift"]: r["above"] for r in rows.mapInPandas(run, "shift double, above bigint").collect()}


def _intervals(spark: SparkSession, shared, top: float, wanted: int) -> tuple[list[tuple[float, float]], int]:
    """Intervals from ``top`` down that hold the ``wanted`` largest eigenvalues, if there are as
    many above the floor, and how many they hold together."""
    low, high = top * FLOOR, top
    known: dict[float, int] = {top: 0}
    for _ in range(ROUNDS):
        known |= _counts(spark, shared, [s for s in np.linspace(low, high, SHIFTS, endpoint=False).tolist() if s not in known])
        enough = [s for s, n in known.items() if n >= wanted]
        if not enough:
            low = top * FLOOR
            break
        low = max(enough)
        high = min(s for s in known if s > low)
        if known[low] <= wanted + PER_INTERVAL or high - low <= 1e-14 * top:
            break
    edges = sorted(s for s in known if s >= low)
    cuts = [edges[0]]
    for now, after in zip(edges[1:], [*edges[2:], None]):
        if after is None or known[cuts[-1]] - known[after] > PER_INTERVAL:
            cuts.append(now)
    pairs = [(a, b) for a, b in zip(cuts, cuts[1:]) if known[a] > known[b]]
    return pairs, known[low]


def _projected(spark: SparkSession, shared, pairs: list[tuple[float, float]], blocks: list[np.ndarray]) -> list[np.ndarray]:
    """Each interval's block, projected by quadrature on a circle around it."""
    places, weights = np.polynomial.legendre.leggauss(NODES)
    asked = [(i, e) for i in range(len(pairs)) for e in range(NODES)]
    given = spark.sparkContext.broadcast(blocks)

    def run(batches):
        for batch in batches:
            out = []
            for i, e in zip(batch["interval"], batch["node"]):
                (a, b), turn = pairs[i], np.exp(0.5j * np.pi * (places[e] + 1))
                matrix, radius = shared.value, (b - a) / 2
                shifted = ((a + b) / 2 + radius * turn) * np.eye(len(matrix)) - matrix
                solved = np.linalg.solve(shifted, given.value[i].astype(complex))
                out.append((weights[e] / 2 * (radius * turn * solved).real).ravel().tolist())
            yield batch[["interval"]].assign(block=out)

    rows = spark.createDataFrame(asked, "interval int, node int").repartition(len(asked))
    found = [np.zeros_like(b) for b in blocks]
    for row in rows.mapInPandas(run, "interval int, block array<double>").collect():
        found[row["interval"]] += np.reshape(row["block"], found[row["interval"]].shape)
    given.unpersist()
    return found


def _ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of the matrix within the span of the columns; columns that add nothing drop out."""
    basis, sizes, _ = np.linalg.svd(block, full_matrices=False)
    basis = basis[:, sizes > 1e-10 * sizes[0]] if sizes[0] > 0 else basis[:, :1]
    values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
    return values, basis @ inner


def leading_pairs(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their eigenvectors as columns."""
    n = len(matrix)
    top = float(np.abs(matrix).sum(axis=1).max()) * 1.01
    if not top > 0:
        return np.zeros(0), np.zeros((n, 0))
    shared = spark.sparkContext.broadcast(matrix)
    pairs, held = _intervals(spark, shared, top, min(wanted, n))
    slack = 1e-12 * top
    for size in (2 * PER_INTERVAL, 4 * PER_INTERVAL, 8 * PER_INTERVAL, n):
        rng = np.random.default_rng(1)
        blocks = [rng.standard_normal((n, min(n, max(size, held + 4)))) for _ in pairs]
        found = [(np.zeros(0), np.zeros((n, 0))) for _ in pairs]
        left = list(range(len(pairs)))
        for _ in range(ROUNDS // 2):
            if not left:
                break
            projected = _projected(spark, shared, [pairs[i] for i in left], [blocks[i] for i in left])
            still = []
            for i, block in zip(left, projected):
                values, vectors = _ritz(matrix, block)
                blocks[i] = vectors
                inside = (values > pairs[i][0] - slack) & (values <= pairs[i][1] + slack)
                found[i] = values[inside], vectors[:, inside]
                rest = matrix @ found[i][1] - found[i][1] * found[i][0]
                if not inside.any() or np.abs(rest).max() > 1e-14 * top * np.sqrt(n):
                    still.append(i)
            left = still
        if not pairs:
            break
        values, vectors = _ritz(matrix, np.hstack([v for _, v in found]))
        if (values > pairs[0][0] - slack).sum() >= held:
            break
    else:
        raise ArithmeticError(f"{held} eigenvalues were counted, but not all were found")
    shared.unpersist()
    if not pairs:
        return np.zeros(0), np.zeros((n, 0))
    order = np.argsort(-values)[:wanted]
    order = order[values[order] > top * FLOOR]
    return values[order], vectors[:, order]


# --- whitening ----------------------------------------------------------------


def _deviation(x: np.ndarray, centre: _Centre) -> list[int | None]:
    """Exact sums of squares of ``n * x - sums``; null where 64 bits don't hold them."""
    n, sums, length = centre.n, centre.sums, x.shape[1]
    most = n * int(np.abs(x).max()) + max(map(abs, sums))
    small = length * most**2 < 1 << 63
    if not small and most < 1 << 62:
        # the difference is far smaller than what it is made of
        off = n * x - np.array(sums, np.int64)
        small = length * int(np.abs(off).max()) ** 2 < 1 << 63
    if small:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def _whitened(vectors: DataFrame, kind: str, length: int, components: int) -> DataFrame | None:
    """Rows of the vectors of one length; none if they don't vary."""
    spark = vectors.sparkSession
    n, sums = _sums(vectors, length)
    centre = _Centre(n, sums)
    matrix = _covariance(vectors, length, centre)
    values, directions = leading_pairs(spark, matrix, components)
    k = len(values)
    if not k:
        return None
    project = spark.sparkContext.broadcast(directions / np.sqrt(values))

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        white = centre(_integers(batch, length)) @ project.value
        return np.vstack([white.T @ white, white.sum(axis=0)])

    found = _partial(vectors, moments, "double")
    mean = np.array(found[k]) / n
    spread = np.array([found[i] for i in range(k)]) / n - np.outer(mean, mean)
    error = float(np.abs(spread - np.eye(k)).max())
    share = (values / np.trace(matrix)).tolist()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            x = _integers(batch, length)
            white = centre(x) @ project.value
            again = pa.array(np.repeat(np.arange(size), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(again),
                    pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                    pa.array(np.full(size * k, n), pa.int64()),
                    pa.array(_deviation(x, centre), pa.int64()).take(again),
                    pa.array(white.ravel()),
                    pa.array(np.tile(share, size)),
                    pa.array(np.full(size * k, error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    return vectors.mapInArrow(rows, schema)


def whiten(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: its id, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``."""
    vectors = usable(rows, vec_id, embedding)
    kind = rows.schema[vec_id].dataType.simpleString()
    lengths = [r["length"] for r in vectors.groupBy("length").count().orderBy("length").collect()]
    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    out = None
    for length in lengths:
        found = _whitened(vectors.where(F.col("length") == length).select("id", "vector"), kind, length, components)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = rows.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("id", vec_id)
