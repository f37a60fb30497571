"""Whitening of embeddings on their leading principal components, found by spectrum slicing.

Tasks add up sums and centred products of their rows; what reaches the driver is one matrix of the dimension's square.
There, the signs of the pivots of V - s I, factored as L D L' with pivots of one or two columns, count the
eigenvalues above a shift s (inertia). Bisection by such counts isolates each leading eigenvalue, or a cluster that is as narrow as
rounding. Inverse iteration that moves its shift to the Rayleigh quotient then converges cubically, and counts
on both sides of the value found certify its number.

Entries are taken as whole numbers floor(64 c); a constant added to all of them cancels out in every result. Rows are
fitted and whitened only if their vector isn't null, has no null, non-finite or unrepresentable entry (floor(64 c) beyond
2^40), and has the length that most such rows have (of equally frequent ones the longer).

Defined results: unusable rows give no rows; repeated rows and null or repeated vec_ids are rows like others; a
component whose eigenvalue isn't above RANK of the trace isn't returned, as it can't be scaled, so few or equal vectors give fewer
components or none; components of equal eigenvalues are any orthonormal basis of their space; a deviation
beyond 2^63 - 1 is null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE = 64.0
LARGEST = float(1 << 40)
RANK = 1e-12
STEPS = 60
EPS = np.finfo(float).eps
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def positive(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix that are above a shift, by the signs of an L D L' factorisation (Bunch-Kaufman pivots)."""
    m = matrix - shift * np.eye(len(matrix))
    above, k, n = 0, 0, len(m)
    alpha = (1 + 17**0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]

    while k < n:
        below = np.abs(m[k + 1 :, k])
        r = k + 1 + int(np.argmax(below)) if k + 1 < n else k
        largest, pivot, two = (below[r - k - 1] if k + 1 < n else 0.0), abs(m[k, k]), False
        if max(largest, pivot) == 0:
            k += 1  # an eigenvalue at the shift itself isn't above it
            continue
        if pivot < alpha * largest:
            row = np.abs(m[k:, r])
            row[r - k] = 0
            beyond = row.max()
            if pivot * beyond < alpha * largest**2:
                if abs(m[r, r]) >= alpha * beyond:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:
            block, rest = m[k : k + 2, k : k + 2], m[k + 2 :, k : k + 2]
            determinant = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            above += 1 if determinant < 0 else 2 * (block[0, 0] > 0)
            inverse = np.array([[block[1, 1], -block[0, 1]], [-block[1, 0], block[0, 0]]]) / determinant
            m[k + 2 :, k + 2 :] -= rest @ inverse @ rest.T
            k += 2
        else:
            above += m[k, k] > 0
            rest = m[k + 1 :, k]
            m[k + 1 :, k + 1 :] -= np.outer(rest / m[k, k], rest)
            k += 1
    return int(above)


def intervals(matrix: np.ndarray, low: float, high: float, wanted: int, width: float) -> list[tuple[float, float, int, int]]:
    """(low, high, first, last): eigenvalues numbered first to last, from 1 by falling value, lie in each interval."""
    done = []
    waiting = [(low, high, positive(matrix, low), positive(matrix, high))]
    while waiting:
        low, high, last, before = waiting.pop()
        if last == before or before >= wanted:
            continue
        if last == before + 1 or high - low <= width:
            done.append((low, high, before + 1, last))
            continue
        middle = (low + high) / 2
        inside = positive(matrix, middle)
        waiting += [(low, middle, last, inside), (middle, high, inside, before)]
    return sorted(done, key=lambda x: x[2])


def eigenvector(matrix: np.ndarray, low: float, high: float, number: int, found: np.ndarray, seed: int) -> tuple[float, np.ndarray]:
    """An eigenpair in the interval, orthogonal to the vectors in `found`: Rayleigh quotient iteration inside, bisection where it leaves."""
    n, size = len(matrix), np.abs(matrix).sum(axis=1).max()
    random = np.random.default_rng(seed)

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - found.T @ (found @ v)
        return v / np.linalg.norm(v)

    def towards(shift: float, v: np.ndarray) -> np.ndarray:
        for nudge in (0.0, 4 * EPS * size, -4 * EPS * size, 64 * EPS * size):
            try:
                w = np.linalg.solve(matrix - (shift + nudge) * np.eye(n), v)
            except np.linalg.LinAlgError:
                continue
            if np.all(np.isfinite(w)) and np.any(w):
                return orthogonal(w / np.abs(w).max())
        return v

    v, shift, value, settled = orthogonal(random.standard_normal(n)), (low + high) / 2, 0.0, 0
    for _ in range(STEPS):
        v = towards(shift, v)
        value = float(v @ (matrix @ v))
        residual = np.linalg.norm(matrix @ v - value * v)
        # Once at rounding level, one more step makes the vector as good as it gets.
        settled += residual <= 32 * EPS * size
        if low <= value <= high:
            if settled > 1:
                break
            shift = value
            continue
        settled = 0
        if high - low <= 8 * EPS * size:
            break  # as narrow as rounding: inverse iteration at its middle was enough
        middle = (low + high) / 2
        low, high = (middle, high) if positive(matrix, middle) >= number else (low, middle)
        shift, v = (low + high) / 2, orthogonal(random.standard_normal(n))
    return value, v


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as rows): the first `wanted` that are above RANK of the trace."""
    n, trace = len(matrix), float(np.trace(matrix))
    values, vectors = np.zeros(0), np.zeros((0, n))
    if not trace > 0:
        return values, vectors
    size = np.abs(matrix).sum(axis=1).max()
    width, slack = 4 * EPS * size, 64 * EPS * n * size
    for low, high, first, last in intervals(matrix, RANK * trace, size * (1 + 4 * EPS), wanted, width):
        members = []
        for number in range(first, min(last, wanted) + 1):
            value, vector = eigenvector(matrix, low, high, number, vectors, number)
            members.append(value)
            vectors = np.vstack([vectors, vector])
        values = np.append(values, members)
        # Fewer than `first` eigenvalues lie above these, and enough of them not below.
        if positive(matrix, max(members) + slack) >= first or positive(matrix, min(members) - slack) < first + len(members) - 1:
            raise ArithmeticError(f"the counts don't confirm eigenvalues {first} to {last}")
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[order]


def usable(df: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, vector) of usable rows, and their dimension (0: none)."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * F.lit(SCALE) <= F.lit(LARGEST)))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0)).where(fine)
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    return rows.where(F.size("vector") == d), d


def entries(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
    return np.floor(flat * SCALE).astype(np.int64)


def sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, exact sum of each dimension)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * d, 0
        for batch in batches:
            if batch.num_rows:
                total = [t + int(x) for t, x in zip(total, entries(batch).sum(axis=0).tolist(), strict=True)]
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(d), -1], pa.int32()), pa.array([Decimal(t) for t in (*total, n)], pa.decimal128(38, 0))], ["i", "total"]
        )

    found = rows.mapInArrow(add, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total")).collect()
    by_place = {r["i"]: int(r["total"]) for r in found}
    return by_place.pop(-1, 0), [by_place.get(i, 0) for i in range(d)]


def scatter(rows: DataFrame, mean: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sum, sum of products) of the centred rows, or of their projections on the columns of `weights`."""
    shared = rows.sparkSession.sparkContext.broadcast((mean, weights))
    d = len(mean) if weights is None else weights.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, weights = shared.value
        total = np.zeros((d + 1, d))
        for batch in batches:
            if batch.num_rows:
                y = entries(batch) - mean
                y = y if weights is None else y @ weights
                total[:d] += y.T @ y
                total[d] += y.sum(axis=0)
        for i in range(d + 1):
            yield pa.RecordBatch.from_arrays([pa.array([i] * d, pa.int32()), pa.array(np.arange(d), pa.int32()), pa.array(total[i])], ["i", "j", "x"])

    found = rows.mapInArrow(add, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros((d + 1, d))
    out[found["i"].to_numpy(), found["j"].to_numpy()] = found["x"].to_numpy()
    return out[d], (out[:d] + out[:d].T) / 2


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each usable row and component."""
    spark = df.sparkSession
    rows, d = usable(df, vec_id, vector)
    n, total = sums(rows, d)
    if not n:
        return spark.createDataFrame([], SCHEMA)
    mean = np.array([t / n for t in total])
    _, products = scatter(rows, mean)
    covariance = products / n
    values, vectors = leading(covariance, components)
    if not len(values):
        return spark.createDataFrame([], SCHEMA)
    weights = vectors.T / np.sqrt(values)
    drift, products = scatter(rows, mean, weights)
    left = products / n - np.outer(drift / n, drift / n) - np.eye(len(values))
    error = float(np.abs(left).max())
    shared = spark.sparkContext.broadcast((mean, weights, total))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, weights, total = shared.value
        whole = np.array(total, dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = entries(batch)
            white = (x - mean) @ weights
            # Whole numbers of 64 bits where the largest possible sum fits into them, else of any size.
            largest = n * int(np.abs(x).max()) + max(map(abs, total))
            kind = np.int64 if d * largest**2 < 1 << 63 else object
            off = n * x.astype(kind) - whole.astype(kind)
            deviation = [v if v < 1 << 63 else None for v in (off * off).sum(axis=1).tolist()]
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)), pa.array(white.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviation, pa.int64()), flat], ["vec_id", "deviation", "white"])

    share = F.array(*[F.lit(float(v)) for v in values / np.trace(covariance)])
    projected = rows.mapInArrow(project, "vec_id long, deviation long, white array<double>")
    projected = projected.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    return projected.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
