"""Whitening of embeddings by shifted CholeskyQR.

The rows that are fitted are the distinct vectors, as whole numbers. With their number n and
sums S, a centred row is (n x - S) / n, whose numerator is exact, so nothing is lost to a large
mean. The centred rows A are orthogonalised in passes. Each pass sums up the Gram matrix of

    Q = A R1^-1 R2^-1 ...

over all tasks, every row being solved against the triangles found so far, and its Cholesky
factor is the next triangle. The first Gram matrix gets a shift, so that it has a factor however
ill-conditioned it is (Fukaya et al., "Shifted Cholesky QR for computing the QR factorization of
ill-conditioned matrices"); the passes end when Q's columns are orthonormal. Then A = Q R with
R = ... R2 R1, and the singular values and right singular vectors of R are those of A. Only
matrices as wide and as high as a vector pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stored

# Entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000

# Beyond this an entry's square, summed over a vector, may leave the range of a long.
LARGEST = 2.0 ** 26

# How far from the identity Q's Gram matrix may be, and how many passes there are at most.
ORTHOGONAL, PASSES = 1e-12, 12

# Numbers of a batch that are worked on at once.
CELLS = 2_000_000


def usable(vector: Column) -> Column:
    """Whether a vector has only finite entries, none of them null or beyond ``LARGEST``."""
    return F.coalesce(
        F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False))),
        F.lit(False))


def whole(vector: Column) -> Column:
    """The vector's entries as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)


def matrices(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Lists of whole numbers as rows of matrices of bounded size, with the first one's place.

    A shorter list is filled up as an entry of zero is.
    """
    lengths = np.asarray(pc.list_value_length(column)).astype(np.int64)
    values = np.asarray(column.flatten()).astype(np.int64)
    ends = np.cumsum(lengths)
    step = max(1, CELLS // max(width, 1))
    for first in range(0, len(lengths), step):
        some = lengths[first:first + step]
        filled = np.full((len(some), width), OFFSET, dtype=np.int64)
        before = ends[first] - some[0]
        filled[np.arange(width) < some[:, None]] = values[before:before + some.sum()]
        yield first, filled


@dataclass(frozen=True)
class Centre:
    """The number of fitted rows and their sums."""

    n: int
    sums: np.ndarray

    def numerators(self, rows: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        return rows * self.n - self.sums

    def rows(self, rows: np.ndarray) -> np.ndarray:
        return self.numerators(rows) / self.n


def solved(rows: np.ndarray, triangles: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverse of each upper triangle, one column after the other."""
    for r in triangles:
        q = np.empty_like(rows)
        for j in range(len(r)):
            q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        rows = q
    return rows


def _summed(fit: DataFrame, width: int, product) -> np.ndarray:
    """The sum over all rows of a square matrix that ``product`` makes of some of them."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, rows in matrices(batch.column(0), width):
                found = product(rows)
                total = found if total is None else total + found
        if total is not None:
            size = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(size), size)), pa.array(np.tile(np.arange(size), size)),
                 pa.array(total.ravel())], names=["i", "j", "v"])

    entries = fit.select("x").mapInArrow(partial, "i long, j long, v double").groupBy("i", "j").agg(
        F.sum("v").alias("v")).toPandas()
    size = int(entries["i"].max()) + 1 if len(entries) else 0
    total = np.zeros((size, size))
    total[entries["i"], entries["j"]] = entries["v"]
    return (total + total.T) / 2


@dataclass(frozen=True)
class Whitening:
    """The components of some rows: a row's whitened values are (x - S/n) times ``weights``."""

    centre: Centre
    weights: np.ndarray
    explained: np.ndarray
    passes: int


def centre_of(fit: DataFrame, width: int) -> Centre:
    """Counts and sums, exactly: whole numbers are added as decimals."""
    entries = fit.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(
        F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()
    n = fit.count()
    sums = np.full(width, n * OFFSET, dtype=np.int64)
    for entry in entries:
        sums[entry.j] = int(entry.s) + (n - entry.n) * OFFSET
    return Centre(n, sums)


def fitted(fit: DataFrame, most: int = 16) -> Whitening:
    """The components of the rows ``x`` of ``fit``, by falling variance, ``most`` at most.

    Directions in which the rows do not vary, as far as double precision can tell, have no
    component.
    """
    width = fit.agg(F.max(F.size("x")).alias("w")).first().w or 0
    centre = centre_of(fit, width)
    triangles: list[np.ndarray] = []

    def product(rows: np.ndarray) -> np.ndarray:
        q = solved(centre.rows(rows), triangles)
        return q.T @ q

    eps = np.finfo(float).eps
    r = np.eye(width)
    gram = _summed(fit, width, product) if centre.n and width else np.zeros((width, width))
    size = np.trace(gram)
    passes = 1
    while size > 0 and passes < PASSES:
        values = np.linalg.eigvalsh(gram)
        # Directions without any variance stay near zero, however often they are solved.
        moving = values > (0.5 if len(triangles) > 1 else 0)
        off = np.abs(values - 1)
        if len(triangles) > 1 and np.all(off[moving] <= ORTHOGONAL * width) and np.all(
                values[~moving] <= width * eps ** 0.5):
            break
        # The norm is at most the trace; later passes need a shift only for such directions.
        shift = (11 * (width * centre.n + width * (width + 1)) * eps * np.trace(gram)
                 if not triangles else 0 if values[0] > eps ** 0.5 else 11 * width * width * eps)
        shift = min(shift, np.trace(gram) * 1e-3)
        triangle = np.linalg.cholesky(gram + shift * np.eye(width)).T
        triangles.append(triangle)
        r = triangle @ r
        gram = _summed(fit, width, product)
        passes += 1
    # Q's columns are orthonormal but for directions without variance, which this leaves out.
    values, vectors = np.linalg.eigh(gram) if size > 0 else (np.zeros(0), np.zeros((width, 0)))
    root = np.sqrt(np.clip(values, 0, None))[:, None] * vectors.T
    _, singular, right = np.linalg.svd(root[values > 0.5] @ r, full_matrices=False)
    if not len(singular):
        return Whitening(centre, np.zeros((width, 0)), np.zeros(0), passes)
    spread = singular ** 2 / centre.n
    kept = np.nonzero(singular > singular[0] * width * eps)[0][:most]
    return Whitening(centre, right[kept].T / np.sqrt(spread[kept]),
                     spread[kept] / spread.sum(), passes)


def identity_error(fit: DataFrame, found: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    width, components = found.weights.shape
    if not components:
        return 0.0

    def product(rows: np.ndarray) -> np.ndarray:
        # A column of ones gives the means too.
        q = np.column_stack([found.centre.rows(rows) @ found.weights, np.ones(len(rows))])
        return q.T @ q

    total = _summed(fit, width, product) / found.centre.n
    covariance = total[:-1, :-1] - np.outer(total[-1, :-1], total[-1, :-1])
    return float(np.abs(covariance - np.eye(components)).max())


def _deviations(numerators: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, exactly; None where it is beyond a long."""
    rough = (numerators.astype(float) ** 2).sum(axis=1)
    exact = (numerators * numerators).sum(axis=1).tolist()
    for k in np.nonzero(rough > 2.0 ** 62)[0].tolist():
        value = sum(v * v for v in numerators[k].tolist())
        exact[k] = value if value < 1 << 63 else None
    return exact


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, "
          "explained double, identity_error double")


def whitened(embeddings: DataFrame, most: int = 16) -> DataFrame:
    """The whitened values of all embeddings (vec_id, embedding), a row for each component.

    Rows whose vector is null, or has an entry that is null, not finite or beyond 2^26 in size,
    are left out; a shorter vector counts as filled up with zeros to the longest. Rows are fitted
    once for each distinct vector and returned one by one, also those that share a vec_id or have
    none. ``n`` is the number of distinct vectors, ``deviation`` the sum of (n x - S)^2, null if
    beyond a long. Vectors that do not vary, as of an empty table or of one vector, have no
    components and no rows. Other columns are not read.

    The only shuffle of vectors is the one that finds the distinct ones, which reduces copies
    before it; they are written, and each pass reads them. Each task sends one matrix.
    """
    rows = embeddings.where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding")).alias("x"))
    fit = stored(rows.select("x").distinct(), "fit")
    found = fitted(fit, most)
    width, components = found.weights.shape
    error = identity_error(fit, found)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in matrices(batch.column("x"), width):
                if not components:
                    continue
                numerators = found.centre.numerators(x)
                values = (numerators / found.centre.n) @ found.weights
                ids = batch.column("vec_id").slice(first, len(x))
                each = np.repeat(np.arange(len(x)), components)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(each)),
                     pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(each), found.centre.n, dtype=np.int64)),
                     pa.array(_deviations(numerators), pa.int64()).take(pa.array(each)),
                     pa.array(values.ravel()), pa.array(np.tile(found.explained, len(x))),
                     pa.array(np.full(len(each), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])

    return rows.mapInArrow(projected, SCHEMA)
