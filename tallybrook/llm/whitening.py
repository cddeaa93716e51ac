"""Whitening of embeddings by shifted CholeskyQR.

The fit list is a matrix of many centred rows. Each pass over it adds up one small Gram matrix of the
rows solved against the triangular factor found so far; its Cholesky factor is the next one. The
first pass adds a shift, so that the factor exists however ill-conditioned the rows are; the passes
after it bring the columns to orthogonality in working precision. The factors compose to R, and the
singular values and right vectors of R are those of the rows: the covariance's eigenvectors, without
the squared condition number of a covariance matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import stage

#: Whole numbers: floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Passes at most, and the distance from orthogonality at which they end.
PASSES, ORTHOGONAL = 6, 1e-13
#: Singular values below this share of the largest belong to directions without variance.
RANK_TOLERANCE = 1e-13
#: Rows multiplied at a time.
BLOCK_ROWS = 4096

WHITENED_DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """What the distinct vectors say: their number, sums by dimension, the composed factor R of the
    centred rows, the kept components (columns), their variances and the whole variance."""

    n: int
    sums: np.ndarray
    factor: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float = 0.0


def whole_numbers(embedding: Column) -> Column:
    """The entries as whole numbers; null where the vector is null or empty, or an entry is null,
    not finite or, scaled, beyond 52 bits."""
    scaled = F.transform(embedding, lambda c: F.floor(F.lit(SCALE) * c.cast("double")))
    fits = lambda c: F.coalesce(F.abs(F.lit(float(SCALE)) * c.cast("double")) < float(1 << 52), F.lit(False))
    usable = F.coalesce((F.size(embedding) > 0) & F.forall(embedding, fits), F.lit(False))
    return F.when(usable, F.transform(scaled, lambda c: c.cast("long") + OFFSET))


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector can be used. Vectors of another length than the most
    frequent one, of equals the longest, are left out."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding")).alias("x")).where("x IS NOT NULL")
    width = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (width["d"] if width else 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def solve_right(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular factor, by substitution column after column."""
    out = np.empty_like(rows)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _added(frame: DataFrame, values: Callable[[np.ndarray], np.ndarray], width: int, shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``values`` (a small matrix of each block of rows) over all rows.

    A task sends one row for each row of its own sum; they are added by Spark, so what reaches the
    driver is one matrix whatever the number of tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            rows = _matrix(batch["x"], width)
            for at in range(0, len(rows), BLOCK_ROWS):
                total += values(rows[at : at + BLOCK_ROWS])
        i, j = np.divmod(np.arange(total.size), shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.reshape(-1))], names=["i", "j", "v"])

    cells = frame.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(shape)
    out[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    return out


def _cholesky(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper factor of the Gram matrix, shifted by a bound of its rounding error if asked for or if
    the plain one does not exist. A column without any variance gets the factor one."""
    gram = gram.copy()
    none = np.flatnonzero(np.diag(gram) <= 0)
    gram[none, none] = 1.0
    d = len(gram)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.trace(gram)
    # The bound grows with the rows; as a share of the trace it need not exceed this one.
    shift = min(shift, 1e-8 * np.trace(gram))
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def fit_components(distinct: DataFrame, width: int, most: int = COMPONENTS) -> Fit | None:
    """Components of distinct vectors ``x`` of one width; null if there is none."""
    held = lambda j: F.sum(F.col("x")[j].cast("decimal(38,0)"))
    n = distinct.count()
    if not n:
        return None
    sums = distinct.agg(*[held(j).alias(f"s{j}") for j in range(width)]).first()
    sums = np.array([int(s) for s in sums], object)
    whole = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([(int(s) - int(w) * n) / n for s, w in zip(sums, whole)])
    centred = lambda rows: (rows - whole) - rest  # noqa: E731 - whole parts cancel before the fraction goes

    factor = np.eye(width)
    for round_ in range(PASSES):
        current = factor
        gram = _added(distinct, lambda rows: (lambda q: q.T @ q)(solve_right(centred(rows), current)), width, (width, width))
        off = np.abs(gram - np.diag(np.where(np.diag(gram) > 0.5, 1.0, 0.0))).max()
        if round_ and off < ORTHOGONAL * max(1, width):
            break
        if round_ == PASSES - 1:
            break
        factor = _cholesky(gram, n, shifted=round_ == 0) @ factor
    # The last Gram matrix is the identity up to rounding, or a projection where directions have no
    # variance; its root belongs to R.
    values, vectors = np.linalg.eigh(gram)
    root = (vectors * np.sqrt(np.maximum(values, 0.0))) @ vectors.T
    _, singular, right = np.linalg.svd(root @ factor)
    total = float((singular**2).sum() / n)
    kept = int((singular[:most] > RANK_TOLERANCE * max(singular[0], 1e-300)).sum()) if singular[0] > 0 else 0
    components = right[:kept].T
    if kept:
        components = components * np.sign(components[np.abs(components).argmax(axis=0), np.arange(kept)])
    variances = singular[:kept] ** 2 / n
    fit = Fit(n, sums, root @ factor, components, variances, total)
    if not kept:
        return fit
    scaled = components / np.sqrt(variances)

    def moments(rows: np.ndarray) -> np.ndarray:
        white = np.column_stack([centred(rows) @ scaled, np.ones(len(rows))])
        return white.T @ white

    moment = _added(distinct, moments, width, (kept + 1, kept + 1)) / n
    covariance = moment[:kept, :kept] - np.outer(moment[:kept, kept], moment[:kept, kept])
    return Fit(n, sums, fit.factor, components, variances, total, float(np.abs(covariance - np.eye(kept)).max()))


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable vector
    and component.

    The components come from the distinct vectors, each once; every row, repeated ones and null ids
    included, is projected. A vector that is null or empty or holds a null or an entry that is not
    finite has no rows, nor has one of another length than most. Directions without variance are no
    components, so a table of equal vectors has no rows; nor has an empty one. ``deviation`` is exact,
    and null where it exceeds 63 bits. Rows are not shuffled but for finding the distinct vectors,
    which are combined inside tasks first; the driver holds matrices of the vectors' width only.
    """
    rows = stage(usable_vectors(vectors), "whole-vectors")
    first = rows.select(F.size("x").alias("d")).first()
    spark = vectors.sparkSession
    if first is None:
        return spark.createDataFrame([], WHITENED_DDL)
    width = first["d"]
    distinct = stage(rows.select("x").distinct(), "distinct-vectors")
    fit = fit_components(distinct, width, most)
    kept = fit.components.shape[1]
    if not kept:
        return spark.createDataFrame([], WHITENED_DDL)
    sums = [int(s) for s in fit.sums]
    whole = np.array([s // fit.n for s in sums], np.int64)
    left = np.array([s - int(w) * fit.n for s, w in zip(sums, whole)], np.int64)
    scaled, explained = fit.components / np.sqrt(fit.variances), fit.variances / fit.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                apart = _matrix(part["x"], width) - whole  # n * x - S is n * apart - left
                white = (apart - left / fit.n) @ scaled
                bound = float(np.abs(apart).max(initial=0)) * fit.n + fit.n
                if bound * bound * width < float(1 << 62):
                    deviation = ((apart * fit.n - left) ** 2).sum(axis=1).tolist()
                else:
                    deviation = [sum((a * fit.n - b) ** 2 for a, b in zip(row, left.tolist())) for row in apart.tolist()]
                    deviation = [x if x < 1 << 63 else None for x in deviation]
                count = part.num_rows
                repeat = lambda column: column.take(pa.array(np.repeat(np.arange(count), kept)))
                yield pa.RecordBatch.from_arrays(
                    [
                        repeat(part["vec_id"]), pa.array(np.tile(np.arange(1, kept + 1), count), pa.int32()),
                        pa.array(np.full(count * kept, fit.n), pa.int64()), repeat(pa.array(deviation, pa.int64())),
                        pa.array(white.reshape(-1)), pa.array(np.tile(explained, count)), pa.array(np.full(count * kept, fit.identity_error)),
                    ],
                    names=[c.split()[0] for c in WHITENED_DDL.split(", ")],
                )

    return rows.mapInArrow(run, WHITENED_DDL)
