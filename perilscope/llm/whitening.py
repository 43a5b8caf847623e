"""Whitening of embeddings by leading eigenvectors of their covariance, found by a block Jacobi-Davidson iteration.

Vectors become whole numbers, x = floor(scale * c) + shift; the fit list holds each distinct one once. The covariance V is never formed:
all the method needs is V times a few columns, one pass over the fit list, in which every task centres its rows exactly
((n * x - S) / n from whole numbers), multiplies, and adds up; the sums of the tasks are added by dimension in a shuffle, so that the
driver gets a number per dimension and column.

1. Rayleigh-Ritz: V projected on the search space gives Ritz values and vectors; their residuals follow from stored products.
2. Pairs are locked in falling order as their residuals reach double precision; later work stays orthogonal to them.
3. For the others the projected correction equations (I - QQ')(V - theta I)(I - QQ') t = -r are solved by some steps of MINRES, all
   columns in one pass each; the solutions extend the search space, which is cut back to the best Ritz vectors when it is full.

The fit list is stored once, in blocks of rows as bytes. Passes are Spark jobs over that table; the state on the driver is some columns
of one vector's length.

Defined results: a vector is dropped if it is NULL or holds a NULL, NaN, an infinity or a number of 2^46 and above, for which x is no
whole number of 64 bits; so is one without entries, or with another number of entries than most have (of equally frequent numbers the larger counts).
Components without variance aren't returned, so there are fewer than ``components`` where the rank is less, and no rows where all vectors are
equal or none is left. Deviation is NULL where it exceeds a long. Repeated ids are rows of their own, a NULL id stays.
Only id and vector are read; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilscope.session import cut_lineage

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
LARGEST = float(1 << 46)
BLOCK_NUMBERS = 1 << 17
GUARD = 4  # more columns than asked for, so that the last of those converge as fast as the first
SPACE = 8  # the search space holds so many times the columns, and half of that after it was cut back
INNER_STEPS = 4
OUTER_STEPS = 200
EPS = float(np.finfo(np.float64).eps)

Multiply = Callable[[np.ndarray], np.ndarray]


def whole_numbers(rows: DataFrame, vector: str) -> DataFrame:
    """``rows`` with column x, without the vectors that have none."""
    usable = F.forall(vector, lambda c: F.abs(c.cast("double")) < LARGEST)  # neither NULL nor NaN is less
    held = rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(usable)
    numbers = held.withColumn("x", F.transform(vector, lambda c: F.floor(SCALE * c.cast("double")) + SHIFT))
    usual = numbers.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return numbers.filter(F.size("x") == (usual["d"] if usual else 0))


def matrix_of(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass(frozen=True)
class FitList:
    """The distinct vectors, stored in blocks; their number, dimension and sums by dimension."""

    blocks: DataFrame
    n: int
    dimension: int
    sums: np.ndarray

    def add_up(self, work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        """The sum of work(centred rows) over all blocks, one job."""
        n, sums, dimension, (height, width) = self.n, self.sums, self.dimension, shape

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((height, width))
            for batch in batches:
                for block in batch.column(0):
                    x = np.frombuffer(block.as_buffer(), dtype=np.int64).reshape(-1, dimension)
                    total += work((x * n - sums) / n)
            arrays = [pa.array(np.arange(height)), *(pa.array(total[:, k]) for k in range(width))]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", *(f"c{k}" for k in range(width))])

        schema = ", ".join(["i bigint", *(f"c{k} double" for k in range(width))])
        parts = self.blocks.select("data").mapInArrow(partial, schema)
        rows = parts.groupBy("i").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(width)]).collect()  # ``height`` rows
        result = np.zeros(shape)
        for row in rows:
            result[row["i"]] = row[1:]
        return result

    def covariance_times(self, columns: np.ndarray) -> np.ndarray:
        return self.add_up(lambda y: y.T @ (y @ columns), columns.shape) / self.n

    def variances(self) -> np.ndarray:
        return self.add_up(lambda y: (y * y).sum(axis=0)[:, None], (self.dimension, 1))[:, 0] / self.n

    def whitened_covariance(self, projection: np.ndarray) -> np.ndarray:
        width = projection.shape[1]

        def moments(y: np.ndarray) -> np.ndarray:
            w = y @ projection
            return np.vstack([w.T @ w, w.sum(axis=0)])

        found = self.add_up(moments, (width + 1, width)) / self.n
        return found[:width] - np.outer(found[width], found[width])


def fit_list(numbers: DataFrame) -> FitList | None:
    """The distinct x of ``numbers``; None if there are none."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.ascontiguousarray(matrix_of(batch.column(0)), dtype=np.int64)
            step = max(BLOCK_NUMBERS // x.shape[1], 1)
            parts = [x[low : low + step] for low in range(0, len(x), step)]
            counts, data = pa.array([len(p) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())
            sums = pa.array([p.sum(axis=0).tolist() for p in parts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([counts, sums, data], names=["n", "sums", "data"])

    distinct = numbers.select("x").distinct()
    blocks = cut_lineage(distinct.mapInArrow(pack, "n bigint, sums array<bigint>, data binary"))
    n = blocks.agg(F.sum("n")).first()[0]
    if not n:
        return None
    by_dimension = blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s"))
    sums = [row["s"] for row in by_dimension.orderBy("i").collect()]  # one row per dimension
    return FitList(blocks, n, len(sums), np.array(sums, dtype=np.int64))


def minres(apply: Multiply, right: np.ndarray, steps: int, reduction: float) -> np.ndarray:
    """Approximate solutions of apply(t) = right for symmetric ``apply``, from zero, all columns side by side."""
    beta = np.linalg.norm(right, axis=0)
    least = beta * 1e-14
    v_old, v = np.zeros_like(right), right / np.where(beta > 0, beta, 1)
    w_old, w, t = (np.zeros_like(right) for _ in range(3))
    eta, first = beta.copy(), beta.copy()
    cos_old, cos, sin_old, sin = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    open_ = beta > 0
    for _ in range(steps):
        if not open_.any():
            break
        z = apply(v)
        alpha = (v * z).sum(axis=0)
        z = z - alpha * v - beta * v_old
        following = np.linalg.norm(z, axis=0)
        delta = cos * alpha - cos_old * sin * beta
        rho = np.hypot(delta, following)
        open_ &= rho > least
        size = np.where(rho > 0, rho, 1)
        w_new = (v - sin_old * beta * w_old - (sin * alpha + cos_old * cos * beta) * w) / size
        cos_old, cos, sin_old, sin = cos, delta / size, sin, following / size
        t = np.where(open_, t + cos * eta * w_new, t)
        eta = -sin * eta
        open_ &= (following > least) & (np.abs(eta) > reduction * first)
        v_old, v, beta = v, z / np.where(following > 0, following, 1), following
        w_old, w = w, w_new
    return t


def orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """What ``columns`` add to the space of the orthonormal ``against``; directions that are there already are left out."""
    found = np.zeros((len(columns), 0))
    for column in columns.T:
        basis, size = np.column_stack([against, found]), np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            column = column - basis @ (basis.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            found = np.column_stack([found, column])
    return found


def leading_pairs(multiply: Multiply, dimension: int, wanted: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their orthonormal vectors (columns) of a symmetric non-negative matrix given by products."""
    wanted = min(wanted, dimension)
    width = min(wanted + GUARD, dimension)
    most = min(SPACE * width, dimension)
    locked, values = np.zeros((dimension, 0)), np.zeros(0)
    space = orthonormal(np.random.default_rng(seed).standard_normal((dimension, width)), locked)
    image = multiply(space)
    for outer in range(OUTER_STEPS):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        scale = max(theta[0] if len(theta) else 0.0, values[0] if len(values) else 0.0, np.finfo(float).tiny)
        ritz, product = space @ turn, image @ turn
        residuals = product - ritz * theta
        if locked.shape[1]:
            residuals = residuals - locked @ (locked.T @ residuals)
        good = np.linalg.norm(residuals, axis=0) <= 4 * np.sqrt(dimension) * EPS * scale
        missing = wanted - locked.shape[1]
        complete = locked.shape[1] + space.shape[1] == dimension
        done = missing if complete else int(np.argmin(np.append(good[:missing], False)))
        locked, values = np.column_stack([locked, ritz[:, :done]]), np.append(values, theta[:done])
        if done == missing:
            break
        space, image, theta, residuals = ritz[:, done:], product[:, done:], theta[done:], residuals[:, done:]
        columns = min(missing - done + GUARD, space.shape[1])
        if most < dimension and space.shape[1] + columns > most:
            space, image = space[:, : most // 2], image[:, : most // 2]
        around = np.column_stack([locked, space[:, :columns]])
        shift = theta[:columns]

        def across(t: np.ndarray) -> np.ndarray:
            return t - around @ (around.T @ t)

        def corrected(t: np.ndarray) -> np.ndarray:
            inside = across(t)
            return across(multiply(inside) - inside * shift)

        steps = minres(corrected, -across(residuals[:, :columns]), INNER_STEPS, 0.5 ** (outer + 1))
        fresh = orthonormal(across(steps), np.column_stack([locked, space]))
        if not fresh.shape[1]:  # nothing new from the equations: go on from any other direction
            other = np.random.default_rng(seed + outer + 1).standard_normal((dimension, 1))
            fresh = orthonormal(other, np.column_stack([locked, space]))
        space, image = np.column_stack([space, fresh]), np.column_stack([image, multiply(fresh)])
    else:
        raise ArithmeticError(f"{wanted - locked.shape[1]} of {wanted} residuals did not reach double precision in {OUTER_STEPS} steps")
    return values, locked


@dataclass(frozen=True)
class Whitening:
    """What projects a row: size and sums of the fit list, a column per component, its share of the variance, the largest error."""

    n: int
    sums: np.ndarray
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(numbers: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """None where no component has any variance."""
    found = fit_list(numbers)
    if found is None:
        return None
    values, vectors = leading_pairs(found.covariance_times, found.dimension, components)
    real = values > found.dimension * EPS * values.max(initial=0.0)
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return None
    heads = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    projection = vectors * np.sign(heads) / np.sqrt(values)
    error = np.abs(found.whitened_covariance(projection) - np.eye(len(values))).max()
    return Whitening(found.n, found.sums, projection, values / found.variances().sum(), float(error))


def squared_lengths(v: np.ndarray) -> np.ma.MaskedArray:
    """Exact sums of squares of whole numbers, by row; masked where a long can't hold them."""
    sizes = (v.astype(np.float64) ** 2).sum(axis=1)
    return np.ma.MaskedArray((v * v).sum(axis=1), mask=sizes >= 9.2e18)


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    numbers = whole_numbers(rows.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector).alias("_vector")), "_vector")
    model = fit(numbers.select("vec_id", "x"), components)
    schema = "vec_id bigint, component int, deviation bigint, whitened double, explained double"

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None or not len(batch):
                continue
            x, width = matrix_of(batch.column(1)), model.projection.shape[1]
            away = x * model.n - model.sums
            deviation = squared_lengths(away)
            arrays = [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), width))),
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                pa.array(np.repeat(deviation.data, width), mask=np.repeat(np.ma.getmaskarray(deviation), width)),
                pa.array(((away / model.n) @ model.projection).ravel()),
                pa.array(np.tile(model.explained, len(x))),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "component", "deviation", "whitened", "explained"])

    found = numbers.select("vec_id", "x").mapInArrow(project, schema)
    n, error = (model.n, model.identity_error) if model else (0, 0.0)
    return found.select("vec_id", "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))
