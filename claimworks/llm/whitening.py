"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import table

SCALE, OFFSET = 1024, 100_000  # a whole number per entry: floor(SCALE * c) + OFFSET
LARGEST = float(1 << 40)  # scaled entries saturate here, so that sums of 2**23 such rows still fit a long
COMPONENTS = 8
EXACT = float(1 << 53)


@dataclass(frozen=True)
class Whitening:
    """What is fitted: row count, exact sums per dimension, mean, components as columns, their eigenvalues, the trace."""

    n: int
    sums: list[int]
    mean: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components / np.sqrt(self.eigenvalues)


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty, and holds finite numbers only."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda c: F.coalesce(bad(c.cast("double")), F.lit(True)))


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): the usable vectors of the commonest length (of equally common ones the longest), as whole numbers.

    Null vectors and those with a null or non-finite entry are left out, and so
    are vectors of another length: they have no place in a covariance. Rows with
    equal or null ids count one by one. Extra columns are not carried.
    """
    good = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v")))
    length = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    scaled = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform("v", lambda c: F.floor(scaled(c)).cast("long") + OFFSET)
    return good.where(F.size("v") == (length.d if length else 0)).select("id", x.alias("x"))


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    """A batch's arrays as the rows of one matrix."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def totals(parts: DataFrame, column: str) -> list[int]:
    """Sums by place of arrays of whole numbers, one array per task, exact and in any order."""
    cells = parts.select(F.posexplode(column).alias("place", "value"))
    rows = cells.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    return [int(r.total) for r in sorted(rows)]


def count_and_sums(x: DataFrame) -> tuple[int, list[int]]:
    """Rows of ``x`` and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if len(batch):
                m = _matrix(batch)
                n, sums = n + len(m), m.sum(0) if sums is None else sums + m.sum(0)
        if n:
            yield pa.RecordBatch.from_pydict({"cells": pa.array([[n, *map(int, sums)]], pa.list_(pa.int64()))})

    found = totals(x.select("x").mapInArrow(run, "cells array<long>"), "cells")
    return (found[0], found[1:]) if found else (0, [])


def centred_scatter(x: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Sum over all rows of (x - mean)(x - mean)', correctly rounded.

    Rows are centred before anything is multiplied: at the whole number nearest to
    the mean. Their products are then whole numbers whose sums are exact in any
    order, and what is left of the mean (at most a half in each dimension) comes
    off as n times its own product. The driver gets one number per cell of the upper triangle.
    """
    centre = [(2 * s + n) // (2 * n) for s in sums]
    at, upper = np.array(centre, np.int64), np.triu_indices(len(sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(len(upper[0]), object)  # Python's whole numbers
        for batch in batches:
            y = (_matrix(batch) - at).astype(np.float64)
            size = np.abs(y).max(initial=1)
            if size * size <= EXACT:
                rows = int(EXACT / (size * size))  # so many rows keep every partial sum exact
                for i in range(0, len(y), rows):
                    part = y[i:i + rows]
                    cells += (part.T @ part)[upper].astype(np.int64).astype(object)
            else:
                wide = y.astype(np.int64).astype(object)
                cells += (wide.T @ wide)[upper]
        yield pa.RecordBatch.from_pydict({"cells": pa.array([list(map(Decimal, map(int, cells)))], pa.list_(pa.decimal128(38, 0)))})

    found = totals(x.select("x").mapInArrow(run, "cells array<decimal(38,0)>"), "cells")
    scatter = np.zeros((len(sums), len(sums)))
    # n**2 times the scatter's cell, less the product of the remainders: whole numbers up to the last division.
    rest = [s - n * c for s, c in zip(sums, centre)]
    for i, j, cell in zip(*upper, found):
        scatter[i, j] = scatter[j, i] = (n * cell - rest[i] * rest[j]) / n
    return scatter


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with L L' = ``a`` (symmetric, no negative eigenvalue), one column per rank; rows in the order of ``a``.

    Each step takes the largest remaining diagonal entry as pivot and stops where
    nothing but rounding of the rows' own entries is left. With rows in pivot order
    L is lower triangular.
    """
    rest, columns = a.astype(np.float64).copy(), []
    rounding = len(a) * np.finfo(float).eps * np.diag(a)
    for _ in range(len(a)):
        left = np.where(np.diag(rest) > rounding, np.diag(rest), 0.0)
        p = int(np.argmax(left))
        if not left[p]:
            break
        column = rest[:, p] / np.sqrt(rest[p, p])
        columns.append(column)
        rest -= np.outer(column, column)
        rest[p], rest[:, p] = 0.0, 0.0
    return np.array(columns).T.reshape(len(a), len(columns))


def one_sided_jacobi(factor: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues of L L', falling; its unit eigenvectors as columns) for a factor L of full column rank.

    Plane rotations make the columns orthogonal; their squared norms then are the
    eigenvalues, and the columns over their norms the eigenvectors.
    """
    columns = factor.T.copy()  # a column is a row here, to be contiguous
    r = len(columns)
    for _ in range(rounds):
        turned = False
        for i in range(r - 1):
            for j in range(i + 1, r):
                p, q = columns[i], columns[j]
                a, b, c = p @ p, q @ q, p @ q
                if abs(c) <= 1e-15 * np.sqrt(a * b):
                    continue
                turned = True
                zeta = (b - a) / (2 * c)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                cos = 1 / np.hypot(1.0, t)
                columns[i], columns[j] = cos * p - cos * t * q, cos * t * p + cos * q
        if not turned:
            break
    norms = np.sqrt((columns**2).sum(1))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, (columns[order] / norms[order, None]).T


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows of ``x`` (arrays of whole numbers); None without rows.

    As many components as asked for, or as the covariance has rank: a direction in
    which the vectors do not differ cannot be scaled to variance one.
    """
    n, sums = count_and_sums(x)
    if not n:
        return None
    covariance = centred_scatter(x, n, sums) / n
    eigenvalues, vectors = one_sided_jacobi(pivoted_cholesky(covariance))
    mean = np.array([s // n + (s % n) / n for s in sums])
    return Whitening(n, sums, mean, vectors[:, :components], eigenvalues[:components], float(np.trace(covariance)))


def identity_error(x: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened rows, minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        total, outer = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = model.project(_matrix(batch).astype(np.float64))
            total, outer = total + z.sum(0), outer + z.T @ z
        yield pa.RecordBatch.from_pydict({"cells": pa.array([[*total, *outer.ravel()]], pa.list_(pa.float64()))})

    cells = x.select("x").mapInArrow(run, "cells array<double>").select(F.posexplode("cells").alias("place", "value"))
    found = np.array([r.total for r in sorted(cells.groupBy("place").agg(F.sum("value").alias("total")).collect())])
    k = len(model.eigenvalues)
    if not k:
        return 0.0
    centre = found[:k] / model.n  # rounding only: the rows are centred before they are multiplied
    return float(np.abs(found[k:].reshape(k, k) / model.n - np.outer(centre, centre) - np.eye(k)).max())


def whitened(x: DataFrame, model: Whitening) -> DataFrame:
    """``x`` with ``whitened``, the coordinates of each row on the components, to variance one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = model.project(_matrix(batch).astype(np.float64)) if len(batch) else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(map(list, z)), pa.list_(pa.float64()))], [*batch.schema.names, "whitened"])

    kind = next(f.dataType.simpleString() for f in x.schema if f.name == "id")
    return x.mapInArrow(run, f"id {kind}, x array<long>, whitened array<double>")


def deviation(x: Column, n: int, sums: list[int]) -> Column:
    """Sum over the dimensions of (n x - S)^2, exact; null where it does not fit a long."""
    wide = lambda c: c.cast("decimal(38,0)")
    apart = F.zip_with(x, F.array(*map(F.lit, sums)), lambda c, s: F.try_subtract(F.try_multiply(wide(c), F.lit(n)), wide(s)))
    add = lambda acc, y: F.try_add(acc, F.try_multiply(y, y)).try_cast("decimal(38,0)")
    return F.aggregate(apart, F.lit(Decimal(0)).cast("decimal(38,0)"), add).try_cast("long")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened coordinates of every usable row of ``embeddings``, a row each; no rows where there are none."""
    x = whole_numbers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    model = fit(x)
    if model is None:
        model, rows = Whitening(0, [], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 1.0), x.withColumn("whitened", F.expr("CAST(array() AS ARRAY<DOUBLE>)"))
    else:
        rows = whitened(x, model)
    apart = deviation(F.col("x"), model.n, model.sums) if model.n else F.lit(None).cast("long")
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues], F.lit(None).cast("double"))
    error = identity_error(x, model) if model.n else 0.0
    return (rows.select(F.col("id").alias("vec_id"), apart.alias("deviation"), F.posexplode("whitened").alias("place", "whitened"))
            .select("vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error")))
