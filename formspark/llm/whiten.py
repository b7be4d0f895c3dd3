"""Embedding whitening: principal components refined from single to double precision.

1. *Integers*: every entry c of a vector becomes x = floor(scale * c). Sums and second moments of
   integers are exact, in whatever order tasks finish.
2. *Fit list*: each distinct x vector once (packed in as few bytes as it needs and grouped, so
   a vector that a third of all rows share is one row of each task).
3. *Covariance*: sums S, then second moments of x centred at the nearest integers to the mean; each
   task sends the upper half of its matrix, which is summed by entry. Only the d × d result comes to the driver.
4. *Eigenvectors*: single-precision ones, corrected by Ogita and Aishima's iterations (matrix
   products only) in extended precision. Eigenvalues closer together than the error of the
   present vectors form a cluster; its basis is rotated by the eigenvectors of the small matrix
   that the covariance, shifted by the cluster's mean, has on it.
5. *Whitening*: each row is projected on the leading components and divided by the root of their
   eigenvalues. The covariance of the whitened fit list is measured in a pass of its own.

Defined cases: vectors that are null, empty, or hold a null or non-finite entry take no part; nor do vectors of another
length than the commonest one (the longer of two equally common). Rows of one
vector or id are each returned. Components whose eigenvalue is zero to rounding cannot be
whitened and are left out. Without rows, or with one distinct vector, the result is empty. An
entry whose integer does not fit 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import written

SCALE = 256
#: Eigenvalues below this share of the largest one are zero to rounding.
NULL_SHARE = 1e-13
_EXTENDED = np.longdouble
_INTS = ("<i1", "<i2", "<i4", "<i8")


# --- coding ---------------------------------------------------------------------------

def _valid(vec: Column) -> Column:
    v = vec.cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce((F.size(v) > 0) & fine, F.lit(False))


def _code(x: np.ndarray) -> list[bytes]:
    """Each row's integers in the fewest bytes that hold them all; equal rows give equal bytes."""
    top = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1)) if len(x) else np.zeros(0, np.int64)
    kind = np.searchsorted([1 << 7, 1 << 15, 1 << 31], top, side="right")
    out: list[bytes] = [b""] * len(x)
    for k in np.unique(kind):
        rows = np.flatnonzero(kind == k)
        data = x[rows].astype(_INTS[k])
        for r, v in zip(rows, data, strict=True):
            out[r] = bytes([k]) + v.tobytes()
    return out


def _decode(col: pa.Array, d: int) -> np.ndarray:
    out = np.empty((len(col), d), np.int64)
    for i, b in enumerate(col.to_pylist()):
        out[i] = np.frombuffer(b, _INTS[b[0]], offset=1)
    return out


def _coded(vectors: DataFrame, vec_col: str, d: int, scale: int, *keep: Column) -> DataFrame:
    """``keep`` and ``x`` (binary) of the rows that take part."""
    rows = vectors.where(_valid(F.col(vec_col)) & (F.size(vec_col) == d)).select(*keep, F.col(vec_col).cast("array<double>").alias("x"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("x")
            c = np.floor(scale * batch.column(at).flatten().to_numpy().reshape(-1, d)) + 0.0
            if len(c) and not (np.abs(c) < float(1 << 63)).all():
                raise OverflowError("an entry of a vector does not fit 64 bits")
            yield batch.set_column(at, "x", pa.array(_code(c.astype(np.int64)), pa.binary()))

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["x binary"])
    return rows.mapInArrow(code, fields)


# --- exact sums ------------------------------------------------------------------------

def _products(z: np.ndarray) -> np.ndarray:
    """z.T @ z in exact integers: as doubles where no sum can pass 2 ** 53, else as Python integers."""
    top = int(np.abs(z).max()) if z.size else 0
    if top * top * max(len(z), 1) < 1 << 53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if top < 1 << 26:
        most = max(1, (1 << 53) // (top * top))
        return sum((_products(z[i:i + most]) for i in range(0, len(z), most)), np.zeros((z.shape[1],) * 2, object))
    o = z.astype(object)
    return o.T @ o


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, sum of each dimension) of the fit list."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = _decode(batch.column("x"), d)
            n += len(x)
            wide = x.size and int(np.abs(x).max()) * len(x) >= 1 << 63
            total = total + (x.astype(object) if wide else x).sum(axis=0)
        values = [Decimal(int(v)) for v in total] + [Decimal(n)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(values, pa.decimal128(38, 0))], names=["i", "v"])

    got = {r["i"]: int(r["v"]) for r in fit.mapInArrow(add, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()}
    return got.get(d, 0), [got.get(i, 0) for i in range(d)]


def _moments(fit: DataFrame, centre: list[int]) -> np.ndarray:
    """Sums of (x - centre)(x - centre)' over the fit list, exact."""
    d = len(centre)
    iu, ju = np.triu_indices(d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            total = total + _products(_decode(batch.column("x"), d) - np.array(centre, np.int64))
        values = [Decimal(int(v)) for v in total[iu, ju]]
        yield pa.RecordBatch.from_arrays([pa.array(iu, pa.int32()), pa.array(ju, pa.int32()),
                                          pa.array(values, pa.decimal128(38, 0))], names=["i", "j", "v"])

    out = np.zeros((d, d), object)
    sums = fit.mapInArrow(add, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").cast("decimal(38,0)").alias("v"))
    for i, j, v in sums.collect():
        out[i, j] = out[j, i] = int(v)
    return out


def _ratio(a: int, b: int) -> np.longdouble:
    """a / b for integers of any size, in extended precision."""
    whole, rest = divmod(a, b)
    hi = float(whole)
    return _EXTENDED(hi) + _EXTENDED(whole - int(hi)) + _EXTENDED((rest << 80) // b) / _EXTENDED(1 << 80)


# --- eigenvectors -----------------------------------------------------------------------

def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of two or more eigenvalues, in order, with neighbours at most ``gap`` apart."""
    order = np.argsort(values)
    cut = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cut) if len(c) > 1]


def refine(a: np.ndarray, x: np.ndarray, *, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of the symmetric ``a`` from approximate eigenvectors ``x``.

    Each round forms R = I - X'X and S = X'AX and adds X E, where E solves the first-order
    equations of both; its error squares from round to round. Pairs whose eigenvalues differ
    less than delta, the error that R and S leave, cannot be told apart by a division: they get
    R / 2 (which only makes them orthonormal), and their span is solved as a small problem of its own.
    """
    a, x = a.astype(_EXTENDED), x.astype(_EXTENDED)
    d, eps = len(a), np.finfo(_EXTENDED).eps
    norm = np.sqrt((a * a).sum())
    eye = np.eye(d, dtype=_EXTENDED)
    for _ in range(rounds):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # else E would undo the orthonormality of close pairs
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        delta = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        if delta <= 8 * d * eps * norm:
            break
        diff = values[None, :] - values[:, None]
        apart = np.abs(diff) > delta
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, diff, 1), r / 2)
        x = x + x @ e
        for c in _clusters(values, float(delta)):
            if np.abs(off[np.ix_(c, c)]).max() > 8 * eps * norm:  # else its basis is as good as the digits allow
                x[:, c] = _solved(a, x[:, c], values[c].mean())
    x = x / np.sqrt((x * x).sum(axis=0))
    values = ((x.T @ a) * x.T).sum(axis=1)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _solved(a: np.ndarray, basis: np.ndarray, mean: np.longdouble) -> np.ndarray:
    """``basis`` rotated to the eigenvectors of ``a`` on its span, from the matrix shifted by the cluster's mean."""
    small = basis.T @ (a @ basis - mean * basis)
    small = (small + small.T) / 2
    top = np.abs(small).max()
    if top == 0:
        return basis
    _, turn = np.linalg.eigh((small / top).astype(np.float64))
    return basis @ turn.astype(_EXTENDED)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix, from single precision upwards."""
    top = np.abs(a).max()
    if not len(a) or top == 0:
        return np.zeros(len(a), _EXTENDED), np.eye(len(a), dtype=_EXTENDED)
    scaled = a.astype(_EXTENDED) / top
    _, x = np.linalg.eigh(scaled.astype(np.float32))
    values, vectors = refine(scaled, x)
    return values * top, vectors


# --- the model ----------------------------------------------------------------------------

@dataclass
class Whitener:
    n: int
    sums: list[int]
    values: np.ndarray      # eigenvalues of the components, falling
    vectors: np.ndarray     # a column for each of them
    trace: float
    error: float            # largest absolute entry of the whitened covariance minus the identity

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows: x - S / n taken apart as (x - rounded mean) - rest, so that no digits cancel."""
        centre = [round(s / self.n) if abs(s) < 1 << 52 else s // self.n for s in self.sums]
        rest = np.array([float(_ratio(s - c * self.n, self.n)) for s, c in zip(self.sums, centre, strict=True)])
        z = (x - np.array(centre, np.int64)).astype(np.float64) - rest
        return z @ (self.vectors / np.sqrt(self.values)).astype(np.float64)


def _dimension(vectors: DataFrame, vec_col: str) -> int:
    sizes = vectors.where(_valid(F.col(vec_col))).groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return sizes["d"] if sizes else 0


def fit(vectors: DataFrame, vec_col: str = "embedding", *, components: int | None = None, scale: int = SCALE) -> Whitener | None:
    """The whitening of the distinct vectors; None when there is nothing to whiten."""
    d = _dimension(vectors, vec_col)
    if not d:
        return None
    table = written(_coded(vectors, vec_col, d, scale).distinct(), "fit")
    n, sums = _sums(table, d)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    m = _moments(table, centre)
    left = [s - n * c for s, c in zip(sums, centre, strict=True)]
    cov = np.array([[_ratio(n * m[i, j] - left[i] * left[j], n * n) for j in range(d)] for i in range(d)], dtype=_EXTENDED)
    values, vectors_ = eigen(cov)
    kept = int((values > NULL_SHARE * max(values[0], 0)).sum()) if values[0] > 0 else 0
    kept = min(kept, components or d)
    if not kept:
        return None
    out = Whitener(n, sums, values[:kept], vectors_[:, :kept], float(np.trace(cov)), 0.0)
    out.error = _identity_error(table, out, d)
    return out


def _identity_error(table: DataFrame, w: Whitener, d: int) -> float:
    """Largest absolute entry of (covariance of the whitened fit list) minus the identity, measured."""
    k = len(w.values)
    iu, ju = np.triu_indices(k)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = w.project(_decode(batch.column("x"), d))
            first += y.sum(axis=0)
            second += y.T @ y
        i = np.concatenate([iu, np.full(k, -1)])
        j = np.concatenate([ju, np.arange(k)])
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          pa.array(np.concatenate([second[iu, ju], first]))], names=["i", "j", "v"])

    got = {(r["i"], r["j"]): r["v"] / w.n for r in
           table.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    return max(abs(got[i, j] - got[-1, i] * got[-1, j] - (i == j)) for i, j in zip(iu.tolist(), ju.tolist(), strict=True))


def whiten(vectors: DataFrame, w: Whitener | None, id_col: str = "vec_id", vec_col: str = "embedding", *, scale: int = SCALE) -> DataFrame:
    """(id, whitened array<double>, deviation decimal(38,0)) of every row that takes part.

    ``deviation``: the sum over dimensions of (n x - S) ** 2, exact.
    """
    name = vectors.schema[id_col]
    fields = f"`{name.name}` {name.dataType.simpleString()}, whitened array<double>, deviation decimal(38,0)"
    d = len(w.sums) if w else 0

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _decode(batch.column("x"), d)
            y = w.project(x)
            if len(x) and w.n * int(np.abs(x).max()) + max(abs(s) for s in w.sums) < 1 << 62:
                v = w.n * x - np.array(w.sums, np.int64)
                if int(np.abs(v).max()) ** 2 * d >= 1 << 63:
                    v = v.astype(object)
            else:
                v = w.n * x.astype(object) - np.array(w.sums, object)
            dev = [Decimal(int(s)) for s in (v * v).sum(axis=1)]
            ends = pa.array(np.arange(len(x) + 1) * y.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(y.ravel())), pa.array(dev, pa.decimal128(38, 0))],
                names=[name.name, "whitened", "deviation"])

    if w is None:
        return vectors.sparkSession.createDataFrame([], fields)
    return _coded(vectors, vec_col, d, scale, F.col(id_col)).mapInArrow(project, fields)
