"""Whitening of embeddings along the eigenvectors of their covariance, found by incremental eigendecomposition.

1. *Partitions.* Every task grows the spectrum of its vectors by one centred rank-one update a vector (:mod:`tidemark.llm.spectra`).
2. *Combination.* Spectra are merged sixteen at a time, in tasks, each axis of one being a rank-one update of the other, until one is left.
3. *Refinement.* One Rayleigh-Ritz step on the full basis: every task projects its vectors, centred by the exact mean, on the axes and sums the
   products; the axes are turned by the eigenvectors of that small matrix, which makes them right to the last digits.
4. *Whitening.* One pass over all rows. The covariance of the whitened fit list is measured in another.

Entries become whole numbers first, so counts and sums are exact, and moving all entries by the same offset changes nothing: it is added
nowhere. The fit list holds every distinct vector once. The driver sees one matrix of dimension x dimension, whatever the number of rows.

Defined cases: rows whose vector is null or holds a null, NaN or infinite entry are dropped. An empty vector is a vector of
dimension 0; a shorter vector counts as followed by zeros; the number of dimensions is that of the longest. Rows with equal, repeated or null
ids each have their result. A direction whose variance is below ``SMALLEST`` of the largest cannot be whitened and has no rows, so equal
vectors only, a single one, and an empty table give an empty result. A squared deviation beyond 64 bits is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors
from tidemark.llm.spectra import Spectrum
from tidemark.session import stage

SCALE = 64
COMPONENTS = 16
SMALLEST = 1e-12
FAN = 16

_SPECTRUM = "part long, n long, sums array<string>, mean array<double>, values array<double>, vectors array<double>"
_SPECTRUM_ARROW = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), *[(c, pa.list_(pa.float64())) for c in ("mean", "values", "vectors")]])
_PRODUCTS = "part long, sums array<double>, products array<double>"
_PRODUCTS_ARROW = pa.schema([("part", pa.int64()), ("sums", pa.list_(pa.float64())), ("products", pa.list_(pa.float64()))])
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double"
_WHITENED_ARROW = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                             ("whitened", pa.float64()), ("explained", pa.float64())])
_LONG = 1 << 62


@dataclass
class Axes:
    """What whitens a vector: exact count and sums, mean, unit axes (columns), their variances and the sum of all variances."""

    n: int
    sums: list[int]
    mean: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    total: float


def whole_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and whole-number vector ``y`` of the rows that take part."""
    return (rows.where(vectors.is_whole(F.col(vector)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), vectors.scaled(F.col(vector), scale).alias("y")))


def fit_list(rows: DataFrame) -> tuple[DataFrame, int]:
    """Every distinct vector once, staged, and the number of dimensions."""
    fit = stage(rows.select("y").distinct(), "fit")
    shortest, longest = fit.agg(F.min(F.size("y")), F.max(F.size("y"))).first()
    if shortest != longest:
        fit = stage(fit.select(vectors.padded(F.col("y"), longest).alias("y")).distinct(), "fit")
    return fit, longest or 0


def _exact_sums(y: np.ndarray) -> list[int]:
    if not y.size:
        return [0] * y.shape[1]
    if max(int(y.max()), -int(y.min())) < _LONG // len(y):
        return [int(s) for s in y.sum(0)]
    return [int(s) for s in y.astype(object).sum(0)]


def _row(schema: pa.Schema, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def spectra(fit: DataFrame, size: int) -> DataFrame:
    """One spectrum per task, staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = Spectrum(size), [0] * size
        for block in vectors.blocks(batches, size):
            y = vectors.matrix(block.column("y"), size)
            sums = [a + b for a, b in zip(sums, _exact_sums(y))]
            for row in y.astype(float):
                own.add(row)
        yield _row(_SPECTRUM_ARROW, TaskContext.get().partitionId(), own.n, [str(s) for s in sums], own.mean, own.values, own.vectors.ravel())
    return stage(fit.mapInArrow(run, _SPECTRUM), "spectra")


def _merged_spectra(size: int):
    def merge(table: pa.Table) -> pa.Table:
        own, sums = Spectrum(size), [0] * size
        for r in table.to_pylist():
            other = Spectrum(size)
            other.n, other.mean = r["n"], np.array(r["mean"])
            other.values, other.vectors = np.array(r["values"]), np.array(r["vectors"]).reshape(size, size)
            if own.n:
                own.merge(other)
            else:
                own = other
            sums = [a + int(b) for a, b in zip(sums, r["sums"])]
        part = table.column("part")[0].as_py() // FAN
        return pa.Table.from_batches([_row(_SPECTRUM_ARROW, part, own.n, [str(s) for s in sums], own.mean, own.values, own.vectors.ravel())])
    return merge


def _merged_products(table: pa.Table) -> pa.Table:
    total = [np.sum([np.array(x) for x in table.column(c).to_pylist()], axis=0) for c in ("sums", "products")]
    return pa.Table.from_batches([_row(_PRODUCTS_ARROW, table.column("part")[0].as_py() // FAN, *total)])


def products(fit: DataFrame, mean: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the centred vectors along the axes, and of the products of each two."""
    size, k = axes.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = np.zeros(k), np.zeros((k, k))
        for block in vectors.blocks(batches, size):
            along = (vectors.matrix(block.column("y"), size).astype(float) - mean) @ axes
            sums += along.sum(0)
            total += along.T @ along
        yield _row(_PRODUCTS_ARROW, TaskContext.get().partitionId(), sums, total.ravel())
    one = vectors.reduced(stage(fit.mapInArrow(run, _PRODUCTS), "products"), _merged_products, FAN).first()
    return np.array(one["sums"]), np.array(one["products"]).reshape(k, k)


def learn(fit: DataFrame, size: int, components: int = COMPONENTS) -> Axes | None:
    """Mean and leading axes of the fit list; None without any vector or dimension."""
    if not size:
        return None
    spectrum = vectors.reduced(spectra(fit, size), _merged_spectra(size), FAN).first()
    if spectrum is None or not spectrum["n"]:
        return None
    n, sums = spectrum["n"], [int(s) for s in spectrum["sums"]]
    mean = np.array([s / n for s in sums])
    basis = np.linalg.qr(np.array(spectrum["vectors"]).reshape(size, size)[:, ::-1])[0]
    _, scatter = products(fit, mean, basis)
    variances, turn = np.linalg.eigh(scatter / n)
    variances, axes = variances[::-1], (basis @ turn)[:, ::-1]
    k = int(((variances > SMALLEST * max(variances[0], 0)) & (variances > 0)).sum())
    k = min(k, components)
    return Axes(n, sums, mean, axes[:, :k], variances[:k], float(variances.sum()))


def identity_error(fit: DataFrame, axes: Axes) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    if not len(axes.variances):
        return None
    sums, total = products(fit, axes.mean, axes.axes / np.sqrt(axes.variances))
    covariance = total / axes.n - np.outer(sums, sums) / axes.n**2
    return float(np.abs(covariance - np.eye(len(sums))).max())


def _deviations(y: np.ndarray, axes: Axes) -> np.ndarray:
    """Sum over the dimensions of (n y - S)^2, exact; Python integers where 64 bits could overflow."""
    rough = np.abs(axes.n * y.astype(float) - np.array([float(s) for s in axes.sums])).max(initial=0)
    large = max([axes.n * float(np.abs(y.astype(float)).max(initial=0)), rough, *[abs(float(s)) for s in axes.sums]])
    if large < _LONG // 2 and y.shape[1] * rough * rough < _LONG // 2:
        off = axes.n * y - np.array(axes.sums, np.int64)
        return (off * off).sum(1)
    off = axes.n * y.astype(object) - np.array(axes.sums, object)
    return np.array([s if s < 1 << 63 else None for s in (off * off).sum(1)], object)


def whitened(rows: DataFrame, axes: Axes, size: int) -> DataFrame:
    """One row per row and component."""
    k, scaled = len(axes.variances), axes.axes / np.sqrt(axes.variances)
    explained = axes.variances / axes.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in vectors.blocks(batches, size + k):
            y, m = vectors.matrix(block.column("y"), size), block.num_rows
            place = pa.array(np.repeat(np.arange(m), k))
            deviation = pa.array(_deviations(y, axes), pa.int64())
            yield pa.RecordBatch.from_arrays([
                block.column("vec_id").take(place), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, axes.n, np.int64)),
                deviation.take(place), pa.array(((y.astype(float) - axes.mean) @ scaled).ravel()), pa.array(np.tile(explained, m))], schema=_WHITENED_ARROW)
    return rows.mapInArrow(run, WHITENED)


def whiten(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every row that takes part, with how well they are whitened."""
    own = whole_vectors(rows, vector, scale)
    fit, size = fit_list(own)
    axes = learn(fit, size, components)
    if axes is None or not len(axes.variances):
        return rows.sparkSession.createDataFrame([], f"{WHITENED}, identity_error double")
    return whitened(own, axes, size).withColumn("identity_error", F.lit(identity_error(fit, axes)))
