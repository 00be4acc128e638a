"""Whitening of embeddings: the leading principal components of the distinct quantised vectors, by matrix-free block Lanczos.

The covariance is never formed. A pass over the distinct vectors gives its product with a block of a few columns: every task
centres its vectors, multiplies them with the block and back, and the tasks' sums are added up by dimension. The driver holds
the Krylov basis and its images, both of a bounded number of columns as long as a vector. Every block is orthogonalised
against the whole basis, columns that break down start anew from seeded random ones, and passes end when the residuals of the
wanted pairs are small or the basis spans the space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.workspace import stage

#: Quantisation: an entry c becomes floor(SCALE * c).
SCALE = 256
#: Columns of a block beside the wanted components, and columns of the basis before it is folded to its best ones.
EXTRA, MAX_BASIS = 4, 256
#: Residual, as a share of the largest eigenvalue, at which a pair has converged; passes after which an error is raised.
TOLERANCE, MAX_PASSES = 1e-13, 500
SEED = 13


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identifier and quantised vector; rows without a vector, or with an entry that is null, not finite or beyond a long, go."""
    for batch in batches:
        lists = batch.column(1).cast(pa.list_(pa.float64()))
        batch = batch.filter(lists.is_valid())
        lists = lists.drop_null()
        flat, ends = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        value = np.floor(SCALE * flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
        bad = np.concatenate([[0], np.cumsum(~(np.abs(value) < 2.0**63))])
        fine = bad[ends[1:]] == bad[ends[:-1]]
        kept = np.repeat(fine, np.diff(ends))
        x = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.diff(ends)[fine])]), pa.int32()), pa.array(value[kept].astype(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fine)), x], ["id", "x"])


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _whole(x: np.ndarray) -> np.ndarray:
    """Column sums that no number of rows in a batch overflows, as Python's integers."""
    return (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0)


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


@dataclass(frozen=True)
class Fit:
    """What the distinct vectors come to: their number, dimensions and exact sums."""

    n: int
    d: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n * x - S) ** 2 for each row, exact."""
        most = int(np.abs(x).max(initial=0)) + 1
        if most * max(most, *map(abs, self.sums), 1) * self.d >= 1 << 62:
            x = x.astype(object)
        squares, products = (x * x).sum(axis=1), (x * np.array(self.sums, x.dtype)).sum(axis=1)
        n, own = self.n, sum(s * s for s in self.sums)
        return [n * n * int(a) - 2 * n * int(b) + own for a, b in zip(squares, products, strict=True)]


def _fit(distinct: DataFrame, d: int) -> Fit:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            n, total = n + len(batch), total + _whole(_matrix(batch.column(0), d))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)), _decimals(total)], ["j", "n", "s"])

    rows = distinct.mapInArrow(sums, "j int, n long, s decimal(38,0)").groupBy("j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    rows = sorted(rows)  # a row for each dimension
    return Fit(rows[0].n, d, [int(r.s) for r in rows])


def _product(distinct: DataFrame, fit: Fit) -> Callable[[np.ndarray], np.ndarray]:
    """The covariance times a block, in one pass over the distinct vectors."""
    n, d, mean = fit.n, fit.d, fit.mean

    def times(block: np.ndarray) -> np.ndarray:
        width = block.shape[1]

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((d, width))
            for batch in batches:
                centred = _matrix(batch.column(0), d) - mean
                total += centred.T @ (centred @ block)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), *map(pa.array, total.T.copy())], ["j", *(f"v{k}" for k in range(width))])

        sums = distinct.mapInArrow(part, "j int, " + ", ".join(f"v{k} double" for k in range(width)))
        rows = sums.groupBy("j").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(width)]).collect()
        return np.array([r[1:] for r in sorted(rows)]) / n

    return times


def _orthogonal(block: np.ndarray, basis: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal columns for the block, orthogonal to the basis; a column that breaks down is replaced by a random one while the space has room."""
    found = basis
    for column in block.T:
        for attempt in range(4):
            size = np.linalg.norm(column)
            for _ in range(2):  # twice is enough
                column = column - found @ (found.T @ column)
            left = np.linalg.norm(column)
            if left > 1e-10 * max(size, 1e-300) and left > 0:
                found = np.column_stack([found, column / left])
                break
            if found.shape[1] >= len(column) or attempt == 3:
                break
            column = rng.standard_normal(len(column))
    return found[:, basis.shape[1] :]


def leading_pairs(times: Callable[[np.ndarray], np.ndarray], d: int, k: int, tolerance: float = TOLERANCE, max_basis: int = MAX_BASIS) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` largest eigenvalues of a symmetric positive map, their unit vectors as columns, and the number of passes.

    ``times`` multiplies the map with a block. A vector's largest entry is positive. Blocks have more columns than are wanted,
    and random columns where the Krylov space is exhausted, so that equal eigenvalues are all found.
    """
    rng, width, k = np.random.default_rng(SEED), min(d, k + EXTRA), min(d, k)
    max_basis = max(max_basis, 3 * width)
    basis, images = np.zeros((d, 0)), np.zeros((d, 0))
    block = _orthogonal(rng.standard_normal((d, width)), basis, rng)
    for passes in range(1, MAX_PASSES + 1):
        image = times(block)
        basis, images = np.column_stack([basis, block]), np.column_stack([images, image])
        small = basis.T @ images
        values, inner = np.linalg.eigh((small + small.T) / 2)
        values, inner = values[::-1], inner[:, ::-1]
        residuals = np.linalg.norm(images @ inner[:, :k] - basis @ inner[:, :k] * values[:k], axis=0)
        if basis.shape[1] >= d or (residuals <= tolerance * max(values[0], 0)).all():
            vectors = basis @ inner[:, :k]
            vectors /= np.linalg.norm(vectors, axis=0)
            vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)] < 0, -1, 1)
            return np.maximum(values[:k], 0), vectors, passes
        following = image
        if basis.shape[1] + width > max_basis:  # fold to the best pairs and go on from what the last block lacks
            following = image - basis @ (basis.T @ image)
            basis, images = basis @ inner[:, :width], images @ inner[:, :width]
        block = _orthogonal(following, basis, rng)
    raise ArithmeticError(f"no convergence after {MAX_PASSES} passes: residuals {residuals}")


def _moments(distinct: DataFrame, fit: Fit, project: np.ndarray) -> tuple[int, np.ndarray]:
    """The sum of the distinct vectors' deviations, exact, and the largest entry of the whitened covariance minus the identity."""
    d, k, mean = fit.d, project.shape[1], fit.mean

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deviation, first, second = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            x = _matrix(batch.column(0), d)
            white = (x - mean) @ project
            deviation += sum(fit.deviations(x))
            first += white.sum(axis=0)
            second += white.T @ white
        yield pa.RecordBatch.from_arrays([_decimals([deviation]), pa.array([first.tolist()]), pa.array([second.ravel().tolist()])], ["deviation", "first", "second"])

    rows = distinct.mapInArrow(part, "deviation decimal(38,0), first array<double>, second array<double>")
    total = rows.agg(F.sum("deviation"), *[F.sum(F.get(name, F.lit(i))) for name, size in (("first", k), ("second", k * k)) for i in range(size)]).first()
    first, second = np.array(total[1 : 1 + k]) / fit.n, np.array(total[1 + k :]).reshape(k, k) / fit.n
    return int(total[0]), second - np.outer(first, first)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """A row for each vector and component: the identifier, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Entries become long numbers x = floor(256 * c). Rows whose vector is null, or holds an entry that is null, not finite or
    too large for a long, go; others stay, repeated and null identifiers too. Shorter vectors end in zeros. The fit list is each
    distinct x once: ``n`` vectors with sums S. ``deviation`` is the sum of (n * x - S) ** 2, exact, as decimal(38, 0); the
    trace of the covariance is the sum of the fit list's deviations over n ** 3, and ``explained`` a component's eigenvalue over it.
    ``whitened`` is x - S / n projected on the component, over the root of the eigenvalue. ``identity_error`` is one number: the largest entry of
    the whitened fit list's covariance minus the identity. Components without variance can't be whitened and are left out, so
    that an empty table, or one distinct vector, gives no rows. Other columns are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    out = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInArrow(_quantise, f"id {kind}, x array<bigint>")
    rows = stage(rows, "quantised")
    sizes = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if not sizes[1]:
        return rows.sparkSession.createDataFrame([], out).withColumnRenamed("id", id_col)
    d = sizes[1]
    if sizes[0] < d:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("x"))))
    distinct = stage(rows.select("x").distinct(), "distinct")

    fit = _fit(distinct, d)
    values, vectors, _ = leading_pairs(_product(distinct, fit), d, components)
    kept = values > 4 * d * np.finfo(float).eps * max(values[0], 1e-300)
    values, vectors = values[kept], vectors[:, kept]
    k, project, mean = len(values), vectors / np.sqrt(values), fit.mean
    if not k:
        return rows.sparkSession.createDataFrame([], out).withColumnRenamed("id", id_col)
    deviation, covariance = _moments(distinct, fit, project)
    trace = deviation / fit.n**3  # Python divides integers of any size right
    explained, error = values / trace, float(np.abs(covariance - np.eye(k)).max())

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = _matrix(batch.column(1), d), len(batch)
            each = np.repeat(np.arange(m), k)
            columns = [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, fit.n)), _decimals(fit.deviations(x)).take(pa.array(each))]
            columns += [pa.array(((x - mean) @ project).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(rows_of, out).withColumnRenamed("id", id_col)


def deviations(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The part that needs no eigenvectors: identifier, ``n`` and ``deviation`` of each row that ``whiten`` keeps, from its rows."""
    return whiten(df, id_col, vector_col, 1).select(id_col, "n", F.col("deviation").cast("long").alias("deviation"))


#: The rows of ``deviations`` in DuckDB.
DEVIATIONS_SQL = """
WITH kept AS (SELECT vec_id, [CAST(floor(256 * CAST(c AS DOUBLE)) AS HUGEINT) FOR c IN embedding] AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len([1 FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
d AS (SELECT DISTINCT x FROM kept),
e AS (SELECT unnest(x) AS v, generate_subscripts(x, 1) AS j FROM d), s AS (SELECT j, sum(v) AS s FROM e GROUP BY j),
l AS (SELECT list(s ORDER BY j) AS s FROM s), c AS (SELECT count(*) AS n FROM d)
SELECT vec_id, n, CAST(list_sum([(n * x[j] - l.s[j]) * (n * x[j] - l.s[j]) FOR j IN range(1, len(x) + 1)]) AS BIGINT) AS deviation
FROM kept, c, l
"""
