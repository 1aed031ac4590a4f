"""Whitening of vectors: leading principal components by a block Jacobi-Davidson method.

The covariance matrix is never formed. All that touches the vectors is a distributed
product with it, C B = sum over rows of (x - mean) ((x - mean)' B) / n, for a block B of
columns: each task centres its rows, multiplies twice and returns one block of sums, and
Spark adds those. Everything else works on matrices of the vectors' length by a few dozen
columns. A search subspace is kept with its product. Rayleigh-Ritz in it gives estimates;
those whose residual is at rounding level are locked, largest eigenvalue first. For each of
the others the projected correction equation

    (I - QQ') (C - theta I) (I - QQ') t = -r,    Q = locked components and the estimate

is solved by a few steps of MINRES, for all at once, so a step costs one product. The
corrections, orthogonalised, widen the subspace; one of ``RESTART`` times the components,
where that is not the whole space, restarts from its best estimates. The method ends when all residuals are locked, or when the subspace is the
whole space, where Rayleigh-Ritz is exact.

Vectors are whole numbers, so sums, counts and the centring (n x - S) are exact before the
first division. The fit list holds each distinct vector once, so a vector that a third of
all rows repeat weighs as much as any other. It is written once; a product reads it and
nothing is shuffled but one block of sums per task. To the driver come one count, two sums
per dimension, one block per product.

Defined results: a vector that is null, holds null or non-finite components, is of another
length than most, or has a component beyond 2^40 takes no part. An eigenvalue that is
rounding error of the largest (rank deficiency, or all vectors equal) has no
component; nor has an empty table. Repeated rows are each transformed. Of equal eigenvalues
any orthonormal components are right; the sign of a component is free.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.columns import hidden, position, shown, written
from lendmill.llm.shipping import by_value

by_value(__name__)

COMPONENTS = 16
MOST = 2**40

#: Spare columns of the first subspace, steps of MINRES per correction, and columns (times
#: the components asked for) at which the subspace restarts.
SPARE = 4
INNER_STEPS = 8
RESTART = 4

#: A residual is at rounding level below this many units in the last place of the largest
#: eigenvalue, for each doubling of the length. Rounds end there at the latest.
UNITS = 8
MOST_ROUNDS = 400


def whole(vec: str | Column, scale: int, offset: int) -> Column:
    """floor(scale * component) + offset; null unless all components are finite and below ``MOST``."""
    x = F.col(vec) if isinstance(vec, str) else vec
    x = x.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) < MOST))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * scale) + offset))


# ---- eigenvalues, given a product ---------------------------------------------


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns that span what the block adds to an orthonormal basis; twice is enough."""
    kept = block / np.maximum(np.linalg.norm(block, axis=0), np.finfo(float).tiny)
    for _ in range(2):
        kept = kept - against @ (against.T @ kept)
        left, size, _ = np.linalg.svd(kept, full_matrices=False)
        kept = left[:, size > 1e-8]
    kept = kept - against @ (against.T @ kept)
    return np.linalg.qr(kept)[0] if kept.shape[1] else kept


def minres(apply, right: np.ndarray, steps: int) -> np.ndarray:
    """Some steps of MINRES for symmetric systems side by side, one column each; ``apply``
    takes all columns at once, a system's matrix may differ from its neighbour's."""
    size = np.linalg.norm(right, axis=0)
    tiny = np.finfo(float).tiny
    v_old, v = np.zeros_like(right), right / np.maximum(size, tiny)
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    beta, eta = np.zeros(len(size)), size.copy()
    c_old, c = np.ones(len(size)), np.ones(len(size))
    s_old, s = np.zeros(len(size)), np.zeros(len(size))
    x = np.zeros_like(right)
    going = size > 0
    for _ in range(steps):
        if not going.any():
            break
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        # the column of the tridiagonal matrix under the rotations so far, then a new rotation
        delta = c * alpha - c_old * s * beta
        upper, top = s * alpha + c_old * c * beta, s_old * beta
        rho = np.maximum(np.hypot(delta, beta_new), tiny)
        c_new, s_new = delta / rho, beta_new / rho
        w_new = (v - top * w_old - upper * w) / rho
        x = np.where(going, x + c_new * eta * w_new, x)
        eta = -s_new * eta
        going = going & (beta_new > 1e-14 * (np.abs(alpha) + beta)) & (np.abs(eta) > 1e-12 * size)
        v_old, v = v, p / np.maximum(beta_new, tiny)
        w_old, w, beta = w, w_new, beta_new
        c_old, c, s_old, s = c, c_new, s, s_new
    return x


def jacobi_davidson(
    product, dim: int, k: int, inner_steps: int = INNER_STEPS, restart: int = RESTART, seed: int = 1
) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors of a symmetric matrix of
    ``dim`` rows that is known by its ``product`` with a block of columns."""
    k = min(k, dim)
    width = min(dim, max(restart * k, k + SPARE + 1))
    locked, values = np.zeros((dim, 0)), []
    start = np.random.default_rng(seed).normal(size=(dim, min(dim, k + SPARE)))
    basis = _orthonormal(start, locked)
    image = product(basis)
    for _ in range(MOST_ROUNDS):
        small = basis.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        ritz, applied = basis @ y, image @ y
        residual = applied - ritz * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        largest = max(abs(theta[0]) if len(theta) else 0.0, values[0] if values else 0.0)
        limit = UNITS * np.finfo(float).eps * largest * (1 + math.log2(dim))
        whole_space = locked.shape[1] + basis.shape[1] >= dim
        want = k - len(values)
        done = 0
        while done < min(want, len(theta)) and (size[done] <= limit or whole_space):
            done += 1
        locked = np.hstack([locked, ritz[:, :done]])
        values += theta[:done].tolist()
        if len(values) == k:
            break
        ritz, applied, theta, residual = (a[..., done:] for a in (ritz, applied, theta, residual))
        want -= done
        if width < dim and ritz.shape[1] + want > width - locked.shape[1] and ritz.shape[1] > want + SPARE:
            ritz, applied, theta = (a[..., : want + SPARE] for a in (ritz, applied, theta))
        basis, image = ritz, applied
        aim = min(want, ritz.shape[1])
        own, shift, right = ritz[:, :aim], theta[:aim], -residual[:, :aim]

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - locked @ (locked.T @ t)
            return t - own * (own * t).sum(axis=0)

        right = projected(right)
        active = np.linalg.norm(right, axis=0) > limit  # the others wait for those before them

        def shifted(t: np.ndarray) -> np.ndarray:
            t = projected(t)
            return projected(product(t) - t * shift)

        if active.any():
            own, shift, right = own[:, active], shift[active], right[:, active]
            correction = minres(shifted, right, inner_steps)
        else:
            correction = np.random.default_rng(len(values)).normal(size=(dim, 1))
        more = _orthonormal(correction, np.hstack([locked, basis]))
        if not more.shape[1]:
            more = np.random.default_rng(len(values) + 1).normal(size=(dim, 1))
            more = _orthonormal(more, np.hstack([locked, basis]))
        basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])
    else:
        raise RuntimeError(f"{len(values)} of {k} components settled")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order]


# ---- work inside tasks --------------------------------------------------------


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dim)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, rounded once: the numerator is exact where it fits into 64 bits."""
    mean = sums // n  # whole part first, so the products below stay small
    rest = sums - mean * n
    return (x - mean).astype(np.float64) - rest / n


def _sum_of(batches, fn, shape: tuple[int, ...]):
    """One row per task: the place and value of every entry of the summed blocks."""
    total = np.zeros(shape)
    for batch in batches:
        if len(batch):
            total += fn(batch)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "value"]
    )


# ---- jobs ---------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """Fitted to ``n`` vectors: sums per dimension, components in columns, their eigenvalues."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def transform(self, rows: DataFrame, vec_col: str) -> DataFrame:
        """The rows that take part, with ``whitened``, an array, and ``deviation``, n^2 times the
        squared distance from the mean, exact; null where it is beyond 64 bits."""
        inner, names = hidden(rows), rows.columns
        vec, n, sums = position(rows, vec_col), self.n, self.sums
        weights = self.components / np.sqrt(self.eigenvalues)
        width = weights.shape[1]
        kept = inner.where(F.col(vec).isNotNull() & (F.size(vec) == self.dim)).withColumns(
            {"whitened": F.array().cast("array<double>"), "deviation": F.lit(None).cast("long")}
        )

        def work(batches):
            for batch in batches:
                x = _matrix(batch.column(vec), len(sums))
                w = _centred(x, n, sums) @ weights
                flat = pa.ListArray.from_arrays(np.arange(len(x) + 1) * width, w.ravel())
                yield batch.set_column(
                    batch.schema.get_field_index("whitened"), "whitened", flat
                ).set_column(
                    batch.schema.get_field_index("deviation"),
                    "deviation",
                    pa.array(_deviation(x, n, sums), pa.int64()),
                )

        out = kept.mapInArrow(work, kept.schema)
        return shown(out, names, {"whitened": "whitened", "deviation": "deviation"})


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n x - S)^2 over the dimensions, in whole numbers of any size where 64 bits may not do."""
    mean = sums // n
    rest = sums - mean * n
    apart = x - mean  # n x - S = n (x - mean) - rest
    largest = n * (int(np.abs(apart).max(initial=0)) + 1)
    if largest * largest * max(len(sums), 1) < 2**63:
        return ((n * apart - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest.tolist(), strict=True)) for row in apart.tolist()]
    return [v if v < 2**63 else None for v in exact]


def fit(vectors: DataFrame, vec_col: str, components: int = COMPONENTS, **settings) -> Whitening | None:
    """Mean and leading components of the distinct vectors of whole numbers; None without any."""
    rows = vectors.select(F.col(vec_col).cast("array<long>").alias("x")).where("x IS NOT NULL")
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.where("size > 0").orderBy(F.desc("n"), "size").first()
    if usual is None:
        return None
    dim = usual["size"]
    fitted = written(rows.where(F.size("x") == dim).distinct(), "whitening-fit")
    totals = fitted.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s"))
    n = fitted.count()
    sums = np.zeros(dim, np.int64)
    for r in totals.collect():  # a row per dimension
        sums[r["pos"]] = r["s"]

    def summed(fn, shape: tuple[int, ...]) -> np.ndarray:
        """Entries of a block of the vectors' length by a few columns, added up by Spark."""
        parts = fitted.mapInArrow(lambda b: _sum_of(b, fn, shape), "place long, value double")
        out = np.zeros(shape)
        flat = out.reshape(-1)
        for place, value in parts.groupBy("place").agg(F.sum("value")).collect():
            flat[place] = value
        return out

    def product(block: np.ndarray) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> np.ndarray:
            x = _centred(_matrix(batch.column("x"), dim), n, sums)
            return x.T @ (x @ block)

        return summed(part, block.shape) / n

    def squares(batch: pa.RecordBatch) -> np.ndarray:
        return np.array([(_centred(_matrix(batch.column("x"), dim), n, sums) ** 2).sum()])

    trace = float(summed(squares, (1,))[0] / n)
    values, vectors_ = jacobi_davidson(product, dim, components, **settings) if trace > 0 else ([], None)
    real = int((np.asarray(values) > trace * dim * np.finfo(float).eps).sum())
    values = np.asarray(values)[:real]
    chosen = vectors_[:, :real] if real else np.zeros((dim, 0))
    weights = chosen / np.sqrt(values) if real else chosen

    def white(batch: pa.RecordBatch) -> np.ndarray:
        return _centred(_matrix(batch.column("x"), dim), n, sums) @ weights

    mean = summed(lambda b: white(b).sum(axis=0), (real,)) / n if real else np.zeros(0)

    def spread(batch: pa.RecordBatch) -> np.ndarray:
        w = white(batch) - mean
        return w.T @ w

    error = float(np.abs(summed(spread, (real, real)) / n - np.eye(real)).max()) if real else 0.0
    return Whitening(n, sums, chosen, values, trace, error)
