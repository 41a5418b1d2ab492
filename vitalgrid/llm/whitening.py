"""Embedding whitening: principal components by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors.

Vectors become whole numbers (`SCALE` times an entry, rounded down), and the components are fitted
on each distinct vector once: n rows X, centred on their exact sums.

Each step makes one unit vector u = X g of the rows and one unit vector v of the dimensions:

    u_j = X v_j - beta u_(j-1), orthogonal to all u before, alpha its length
    v_(j+1) = X' u_j - alpha v_j, orthogonal to all v before, beta its length

A pass over the rows computes the entries of u where the rows are, and sums u'u, U'u and X'u. The vectors u
are as long as the table and are never stored: u_j lies in the range of X, so its coefficients
g_j make it again, row by row. What reaches the driver are sums of as many numbers as there are
dimensions and steps. When reorthogonalisation takes a notable part of u away, the pass is repeated.

With U and V orthogonal, X = U B V' with B bidiagonal: singular values of the small B are the deviations, its right
vectors turned by V the components. The steps end when the wanted components have no residual left and the
part of the variance that no step has met is less than the least of them, so that no equal or larger one can
be missing; at the latest after as many steps as dimensions, when B is exact. A start that lies in fewer
dimensions ends its chain; the next one starts orthogonal to it.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

SCALE = 256
COMPONENTS = 4
# passes over the rows until a vector is orthogonal to the ones before; two are enough for any that is not rounding
PASSES = 3
# a residual, and what is left of a vector, below this part of the largest deviation is rounding
ROUNDING = 1e-14
# an eigenvalue below this part of the trace cannot be told from zero: its component is not returned
LEAST_SHARE = 1e-13


@dataclass(frozen=True)
class Fit:
    """n rows with sums `total`; unit `basis` (one column per component), eigenvalues, trace of the covariance."""

    n: int
    total: np.ndarray
    basis: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    steps: int


# --- vectors -----------------------------------------------------------------------------------


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and x, the entries as whole numbers; without the rows whose vector is not all finite numbers.

    An entry that no long holds after scaling counts as not finite.
    """
    vector = F.col("embedding").cast("array<double>")

    def usable(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < 2.0**63)

    good = vector.isNotNull() & F.coalesce(F.forall(vector, usable), F.lit(False))
    x = F.transform(vector, lambda c: F.floor(c * SCALE).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(good, x).alias("x")).filter("x is not null")


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - total / n, by whole numbers as long as these fit."""
    if len(x) and 2 * n * max(int(x.max()), -int(x.min())) < 2**62:
        return (n * x - total) / n
    return x - total / n


def _squares(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Sums of (n x - total)**2, exact; None where no long holds it."""
    if not len(x):
        return []
    bound = 2 * n * max(int(x.max()), -int(x.min()))
    if bound * bound * x.shape[1] < 2**63:
        return ((n * x - total) ** 2).sum(axis=1).tolist()
    sums = ((n * x.astype(object) - total.astype(object)) ** 2).sum(axis=1)
    return [s if s < 2**63 else None for s in sums.tolist()]


# --- passes over the rows ----------------------------------------------------------------------


def _summed(rows: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of what `part` makes of a batch of vectors: `size` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                sums += part(_matrix(batch["x"], width))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(sums)], names=["i", "s"])

    found = rows.select("x").mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(size)
    for row in found:
        out[row["i"]] = row["s"]
    return out


def bidiagonalised(multiply: Callable[[np.ndarray, np.ndarray], tuple], width: int, energy: float, wanted: int):
    """Singular values and right vectors (columns) of X, the largest first, and the number of steps.

    `multiply(g, G)` gives u'u, U'u and X'u for u = X g and U = X G. `energy` is the sum of the squares of X.
    """
    scale = np.sqrt(energy)
    random = np.random.default_rng(width)
    rights = np.empty((width, 0))  # v
    coefficients, products = np.empty((width, 0)), np.empty((width, 0))  # g, and X'u
    diagonal, beside = [], []

    def orthogonal(v):
        for _ in range(2):
            v = v - rights @ (rights.T @ v)
        return v

    v, beta = None, 0.0
    while True:
        if v is None:  # a new chain, orthogonal to the ones before
            v, beta = orthogonal(random.standard_normal(width)), 0.0
            v /= np.linalg.norm(v)
        if diagonal:
            beside.append(beta)
        rights = np.column_stack([rights, v])
        g = v - (beta * coefficients[:, -1] if beta else 0.0)
        for _ in range(PASSES):
            squared, shared, back = multiply(g, coefficients)
            g = g - coefficients @ shared
            straight = np.linalg.norm(shared) <= 1e-6 * np.sqrt(squared)
            if straight:
                break
        alpha = np.sqrt(max(squared - shared @ shared, 0.0))
        if alpha <= ROUNDING * scale or not straight:  # nothing but rounding is left of u
            alpha, g, back = 0.0, np.zeros(width), np.zeros(width)
        else:
            g, back = g / alpha, (back - products @ shared) / alpha
        diagonal.append(alpha)
        coefficients, products = np.column_stack([coefficients, g]), np.column_stack([products, back])
        rest = orthogonal(back - alpha * v)
        beta = float(np.linalg.norm(rest))
        v = rest / beta if beta > ROUNDING * scale else None
        beta = beta if v is not None else 0.0

        left, values, right = np.linalg.svd(np.diag(diagonal) + np.diag(beside, 1))
        steps = len(values)
        top = min(wanted, steps)
        residual = beta * np.abs(left[-1, :top]).max()
        unmet = energy - float(values @ values)
        if steps == width or (top == wanted and residual <= ROUNDING * scale and unmet < values[top - 1] ** 2):
            return values, rights @ right.T, steps


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Fit | None, DataFrame]:
    """The components of the distinct vectors `x` of one length, and those vectors as a written table.

    The length is the one that most distinct vectors have, the longer one of equals. There is no fit without
    vectors, or when they do not vary.
    """
    distinct = written(vectors.select("x").distinct(), "distinct-vectors")
    lengths = distinct.groupBy(F.size("x").alias("d")).count().filter("d > 0")
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None, distinct
    width, n = common["d"], common["count"]
    rows = distinct.filter(F.size("x") == width)
    sums = rows.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s")).collect()
    total = np.zeros(width, np.int64)
    for row in sums:
        total[row["i"]] = row["s"]

    energy = float(_summed(rows, width, lambda x: np.array([(_centred(x, n, total) ** 2).sum()]), 1)[0])
    if not energy > 0:
        return None, rows

    def multiply(g, others):
        def part(x):
            centred = _centred(x, n, total)
            u = centred @ g
            return np.concatenate([[u @ u], (centred @ others).T @ u, centred.T @ u])

        out = _summed(rows, width, part, 1 + others.shape[1] + width)
        return out[0], out[1 : 1 + others.shape[1]], out[1 + others.shape[1] :]

    values, vectors_, steps = bidiagonalised(multiply, width, energy, min(components, width))
    eigenvalues = values[:components] ** 2 / n
    keep = eigenvalues > LEAST_SHARE * energy / n
    basis = vectors_[:, :components][:, keep]
    basis *= np.where(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])] < 0, -1.0, 1.0)
    return Fit(n, total, basis, eigenvalues[keep], energy / n, steps), rows


def _projected(x: np.ndarray, fit: Fit) -> np.ndarray:
    return _centred(x, fit.n, fit.total) @ fit.basis / np.sqrt(fit.eigenvalues)


def identity_error(rows: DataFrame, fit: Fit) -> float:
    """Largest entry of the covariance of the whitened fit rows less the identity."""
    width, k = len(fit.total), fit.basis.shape[1]
    mean = _summed(rows, width, lambda x: _projected(x, fit).sum(axis=0), k) / fit.n

    def part(x):
        centred = _projected(x, fit) - mean
        return (centred.T @ centred).ravel()

    return float(np.abs(_summed(rows, width, part, k * k).reshape(k, k) / fit.n - np.eye(k)).max())


def whitened(vectors: DataFrame, fit: Fit) -> DataFrame:
    """vec_id, deviation and whitened (one number per component) of the rows of `vectors` of the fit's length.

    `deviation` is the sum of (n x - total)**2 over the dimensions, exact; NULL where no long holds it.
    """

    def run(batches):
        for batch in batches:
            x = _matrix(batch["x"], len(fit.total))
            flat = _projected(x, fit).ravel()
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1) * fit.basis.shape[1], pa.int32()), pa.array(flat, pa.float64())
            )
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(_squares(x, fit.n, fit.total), pa.int64()), lists],
                names=["vec_id", "deviation", "whitened"],
            )

    rows = vectors.filter(F.size("x") == len(fit.total)).select("vec_id", "x")
    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whitened_components(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Rows of `rows` (vec_id, embedding) whose vector is NULL or has an entry that is NULL, not finite or too large for
    a long are left out, and those of another length than most distinct vectors have: they have no place in the
    same space. Repeated rows and NULL ids stay and count once in the fit. There are as many components as
    dimensions with variance, at most `components`; vectors that do not vary, and an empty table, give
    an empty result. Of equal eigenvalues any basis is right.
    """
    vectors = written(whole_vectors(rows), "whole-vectors")
    fit, distinct = fitted(vectors, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, fit)
    shares = F.array(*[F.lit(float(e / fit.trace)) for e in fit.eigenvalues])
    found = whitened(vectors, fit).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return found.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
