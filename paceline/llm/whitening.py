"""Embedding whitening by shifted CholeskyQR.

Components are floored on a lattice of width 1/scale, so that sums are exact integers. Each
different lattice vector is listed once. The centred list is orthogonalised in passes: tasks
send Gram sums, the driver factors them (the first Gram matrix with a shift, so that the
factorisation cannot break down), and the next pass sends its rows through triangular solves
with all factors so far. When the Gram matrix is the identity, the product of the factors is
the R of the centred list, and its singular values and right singular vectors are the standard
deviations and components. Squaring the condition number, as an eigenvalue problem of the
covariance would, is thus avoided.

An offset added to every lattice component changes neither n * x - S nor any covariance, so
none is stored.

Defined results: vectors that are null, hold null or non-finite components, or components
whose lattice value does not fit 62 bits, are dropped; a zero vector is a vector like others;
vectors of each length are whitened among themselves; an empty vector has no components. A
component without variance (below :data:`RANK` of the largest) is not returned, so one distinct
vector gives no rows. ``deviation`` is null where it does not fit a long. Repeated rows are
whitened alike and listed once; an empty table gives an empty result. A kept column named like
a result column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paceline.sources.scratch import written

COMPONENTS, SCALE = 16, 64.0
RANK = 1e-12  # least variance of a component, as a share of the largest
SETTLED = 1e-12  # of a Gram matrix's distance from the identity
PASSES = 5
LATTICE_LIMIT = float(1 << 62)
WIDTHS = (np.int8, np.int16, np.int32, np.int64)

RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def lattice_rows(column: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, lattice vectors) of the usable vectors of a list column, by length."""
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    start = np.concatenate([[0], np.cumsum(np.maximum(length, 0))])
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
        bad = np.concatenate([[0], np.cumsum(~(np.abs(flat) < LATTICE_LIMIT))])
    usable = (length >= 0) & (bad[start[1:]] == bad[start[:-1]])
    for dim in np.unique(length[usable]):
        at = np.flatnonzero(usable & (length == dim))
        yield at, flat[start[at][:, None] + np.arange(dim)].astype(np.int64)


def pack(x: np.ndarray) -> list[bytes]:
    """Each row's components in the least width that holds them: equal rows, equal bytes."""
    low, high = (x.min(axis=1), x.max(axis=1)) if x.shape[1] else (np.zeros(len(x)), np.zeros(len(x)))
    out: list[bytes] = [b""] * len(x)
    done = np.zeros(len(x), dtype=bool)
    for width in WIDTHS:
        fits = ~done & (low >= np.iinfo(width).min) & (high <= np.iinfo(width).max)
        done |= fits
        body, size = x[fits].astype(width).tobytes(), np.dtype(width).itemsize * x.shape[1]
        for k, row in enumerate(np.flatnonzero(fits)):
            out[row] = bytes([np.dtype(width).itemsize]) + body[k * size:(k + 1) * size]
    return out


def unpack(keys: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(keys), dim), dtype=np.int64)
    size = np.array([k[0] for k in keys], dtype=np.int64)
    for width in WIDTHS:
        at = np.flatnonzero(size == np.dtype(width).itemsize)
        if len(at):
            out[at] = np.frombuffer(b"".join(keys[i][1:] for i in at), dtype=width).reshape(len(at), dim)
    return out


def fit_list(table: DataFrame, vector: str, scale: float) -> DataFrame:
    """``dim, key``: each different lattice vector once; equal ones meet before the shuffle."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in lattice_rows(batch.column(0), scale):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], dtype=np.int32)),
                                                  pa.array(pack(x), pa.binary())], names=["dim", "key"])

    vectors = table.select(F.col(vector).cast("array<double>"))
    return vectors.mapInArrow(packed, "dim int, key binary").distinct()


def _sums(rows: DataFrame, dim: int, numbers) -> dict[int, float]:
    """Totals over all rows of the arrays ``numbers(lattice vectors)`` gives; driver gets one each."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = numbers(unpack(batch.column(0).to_pylist(), dim))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

    got = rows.select("key").mapInArrow(summed, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return {r["i"]: r["v"] for r in got}


def column_sums(rows: DataFrame, dim: int) -> list[int]:
    """Exact sums of every dimension, as two halves of at most 31 and 32 bits a component."""

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpack(batch.column(0).to_pylist(), dim)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array((x >> 32).sum(axis=0)),
                                              pa.array((x & 0xFFFFFFFF).sum(axis=0))], names=["i", "high", "low"])

    wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]
    got = rows.select("key").mapInArrow(halves, "i long, high long, low long").groupBy("i").agg(*wide).collect()
    out = [0] * dim
    for r in got:
        out[r["i"]] = (int(r["high"]) << 32) + int(r["low"])
    return out


@dataclass
class Centre:
    """The mean S / n as whole and rest, so that centred components lose no digits."""

    n: int
    whole: np.ndarray  # S // n
    rest: np.ndarray  # S mod n

    @classmethod
    def of(cls, sums: list[int], n: int) -> Centre:
        parts = [divmod(s, n) for s in sums]
        return cls(n, np.array([p[0] for p in parts], dtype=np.int64), np.array([p[1] for p in parts], dtype=np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) ** 2, exactly."""
        away = x - self.whole
        largest = int(np.abs(away).max(initial=0)) + 1
        if x.shape[1] * (self.n * largest) ** 2 < 1 << 63:
            return ((self.n * away - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * away.astype(object) - self.rest) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def through(x: np.ndarray, factors: list[np.ndarray], block: int = 64) -> np.ndarray:
    """x R1^-1 R2^-1 ... by forward substitution, a block of columns at a time."""
    for r in factors:
        y = np.empty_like(x)
        for a in range(0, x.shape[1], block):
            z = min(a + block, x.shape[1])
            y[:, a:z] = x[:, a:z] - y[:, :a] @ r[:a, a:z]
            for j in range(a, z):
                y[:, j] = (y[:, j] - y[:, a:j] @ r[a:j, j]) / r[j, j]
        x = y
    return x


def _gram(rows: DataFrame, dim: int, centre: Centre, factors: list[np.ndarray]) -> np.ndarray:
    upper = np.triu_indices(dim)

    def numbers(x: np.ndarray) -> np.ndarray:
        q = through(centre.centred(x), factors)
        return (q.T @ q)[upper]

    got = _sums(rows, dim, numbers)
    out = np.zeros((dim, dim))
    out[upper] = [got[i] for i in range(len(upper[0]))]
    return out + np.triu(out, 1).T


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor; the shift grows until rounding cannot break it down."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(100 * shift, len(gram) * np.finfo(float).eps * np.trace(gram))


@dataclass
class Whitening:
    """What a row needs: centre, directions over standard deviations, and figures of the fit."""

    centre: Centre
    axes: np.ndarray  # unit eigenvectors, a column each
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centre.centred(x) @ self.axes) / np.sqrt(self.variances)


def _whitening(rows: DataFrame, dim: int, components: int) -> Whitening | None:
    n = rows.count()
    centre = Centre.of(column_sums(rows, dim), n)
    factors: list[np.ndarray] = []
    total = None
    while True:
        gram = _gram(rows, dim, centre, factors)
        if total is None:
            total = float(np.trace(gram))
            if total == 0:
                return None
        if factors and np.abs(gram - np.eye(dim)).max() <= SETTLED or len(factors) == PASSES:
            break
        unit = np.finfo(float).eps / 2
        factors.append(_factor(gram, 0.0 if factors else 11 * (n * dim + dim * (dim + 1)) * unit * total))
    # What the last Gram matrix still differs from the identity (all of a missing rank) goes into the product.
    spread, turn = np.linalg.eigh(gram)
    r = (turn * np.sqrt(np.maximum(spread, 0))) @ turn.T
    for factor in reversed(factors):
        r = r @ factor
    _, sigma, axes = np.linalg.svd(r)
    kept = min(components, int((sigma ** 2 > RANK * sigma[0] ** 2).sum()))
    axes = axes[:kept].T
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(kept)])
    fitted = Whitening(centre, axes, sigma[:kept] ** 2 / n, sigma[:kept] ** 2 / total)
    fitted.identity_error = _identity_error(rows, dim, fitted)
    return fitted


def _identity_error(rows: DataFrame, dim: int, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened list's covariance minus the identity."""
    k, n = len(fitted.variances), fitted.centre.n

    def numbers(x: np.ndarray) -> np.ndarray:
        w = fitted.whitened(x)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    got = _sums(rows, dim, numbers)
    total = np.array([got[i] for i in range(k + k * k)])
    mean = total[:k] / n
    covariance = total[k:].reshape(k, k) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def fit(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: float = SCALE) -> dict[int, Whitening]:
    """A fit for each length of vectors that has any variance."""
    listed = written(fit_list(table, vector, scale), "fit-list")
    dims = [r["dim"] for r in listed.select("dim").distinct().orderBy("dim").collect()]
    fits = {dim: _whitening(listed.where(F.col("dim") == dim), dim, components) for dim in dims if dim > 0}
    return {dim: f for dim, f in fits.items() if f is not None}


def whiten(table: DataFrame, keep: list[str], vector: str = "embedding", components: int = COMPONENTS,
           scale: float = SCALE) -> DataFrame:
    """A row for each vector and component: ``keep`` columns and those of :data:`RESULT`."""
    fits = fit(table, vector, components, scale)
    new = [c.split()[0] for c in RESULT.split(", ")]
    kept = [c for c in keep if c not in new]
    rows = table.select(*kept, F.col(vector).cast("array<double>").alias("_vector"))

    def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in lattice_rows(batch.column(len(kept)), scale):
                fitted = fits.get(x.shape[1])
                if fitted is None:
                    continue
                k = len(fitted.variances)
                each = pa.array(np.repeat(at, k))
                yield pa.RecordBatch.from_arrays([
                    *[c.take(each) for c in batch.columns[:len(kept)]],
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, fitted.centre.n)),
                    pa.array(fitted.centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(fitted.whitened(x).ravel()),
                    pa.array(np.tile(fitted.explained, len(x))),
                    pa.array(np.full(len(x) * k, fitted.identity_error)),
                ], names=[*kept, *new])

    typed = rows.select(*kept, *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in RESULT.split(", ")])
    return rows.mapInArrow(transformed, typed.schema)
