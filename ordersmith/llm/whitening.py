"""Embedding whitening with covariances by polarisation.

Entries become integers, so that every sum is exact. Only squares are added up:
those of each centred dimension and those of each sum of two centred dimensions.
As var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of these variances
are all cross-covariances; the assembled matrix goes to ``eigh``.

Scale: each task adds up its own rows in slices and sends one number for every
pair of dimensions (in parts of 32 bits, so that no sum of them overflows);
equal pairs meet in a shuffle of that size. The driver holds one matrix of the
dimensions. Rows never move, so repeated vectors weigh on no task.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries are multiplied by SCALE, rounded down and moved by SHIFT (fixed values of the contract).
SCALE, SHIFT = 64, 1_000_000
#: An entry beyond this many units counts as this many.
MOST = 1 << 52
#: Rows that are added up at a time.
SLICE_ROWS = 4096
_LIMB, _LIMBS = 32, 6


@dataclass
class Whitening:
    n: int
    sums: list[int]             # of every dimension
    lo: list[int]
    hi: list[int]
    values: np.ndarray          # eigenvalues that are kept, falling
    components: np.ndarray      # (kept, dimensions), unit rows
    explained: np.ndarray       # eigenvalue over the trace


def usable(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds only finite numbers."""
    finite = F.forall(vec_col, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return df.filter(F.col(vec_col).isNotNull() & F.coalesce(finite, F.lit(False)))


def _dimensions(vectors: DataFrame) -> int:
    sizes = vectors.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return top["d"] if top else 0


def _integers(batch: pa.RecordBatch, dim: int):
    """Slices of the vectors of ``dim`` entries as whole numbers, with their first and last rows."""
    for a in range(0, batch.num_rows, SLICE_ROWS):
        part = batch.column("v").slice(a, SLICE_ROWS)
        c = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), dim)
        with np.errstate(over="ignore"):
            x = np.clip(np.floor(c * SCALE), -MOST, MOST)
        yield a, x.astype(np.int64) + SHIFT


def _exact_sums(parts: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(position, limb, value) of the first and the non-zero 32-bit limbs; the last limb carries the sign."""
    pos, limb, value = [], [], []
    for p, v in enumerate(parts):
        v = int(v)
        for k in range(_LIMBS):
            low = v if k == _LIMBS - 1 else v & ((1 << _LIMB) - 1)
            if low or not k:
                pos.append(p)
                limb.append(k)
                value.append(low)
            v >>= _LIMB
    return pos, limb, value


def _whole(sums: DataFrame, n: int) -> list[int]:
    """The exact totals of ``n`` positions from the tasks' limbs."""
    got = sums.groupBy("pos", "limb").agg(F.sum("value").alias("value")).toArrow()
    out = [0] * n
    for p, k, v in zip(got["pos"].to_pylist(), got["limb"].to_pylist(), got["value"].to_pylist()):
        out[p] += v << (_LIMB * k)
    return out


def _first_moments(dim: int):
    def run(batches):
        n, sums = 0, np.zeros(dim, object)
        lo, hi = np.full(dim, MOST * 2), np.full(dim, -MOST * 2)
        for b in batches:
            for _, x in _integers(b, dim):
                n += len(x)
                low = x >> 26                        # two halves, so that no slice overflows
                sums += low.sum(0).astype(object) * (1 << 26) + (x - (low << 26)).sum(0).astype(object)
                lo, hi = np.minimum(lo, x.min(0)), np.maximum(hi, x.max(0))
        if n:
            pos, limb, value = _exact_sums([*sums, n])
            at = np.minimum(pos, dim - 1)
            yield pa.record_batch([pa.array(pos, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64()),
                                   pa.array(lo[at]), pa.array(hi[at])], names=["pos", "limb", "value", "lo", "hi"])
    return run


def _squares(z: np.ndarray) -> np.ndarray:
    """Sums of squares of every row of ``z`` and of every sum of two rows (i < j), in the order of ``triu``."""
    big = int(np.abs(z).max(initial=0))
    if big >= 1 << 24:                               # beyond 64 bits: the same in Python's integers
        z = z.astype(object)
    out = []
    for i in range(len(z)):
        s = z[i + 1:] + z[i]
        out += [(z[i] * z[i]).sum(keepdims=True), (s * s).sum(1) if z.dtype == object else np.einsum("ij,ij->i", s, s)]
    return np.concatenate(out).astype(object)


def _pair_squares(dim: int, centre: np.ndarray):
    def run(batches):
        total = np.zeros(dim * (dim + 1) // 2, object)
        for b in batches:
            for _, x in _integers(b, dim):
                total += _squares(np.ascontiguousarray((x - centre).T))
        pos, limb, value = _exact_sums(total)
        yield pa.record_batch([pa.array(pos, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())],
                              names=["pos", "limb", "value"])
    return run


def covariance(n: int, sums: list[int], squares: list[int], centre: list[int]) -> np.ndarray:
    """Covariances (divisor ``n``) from the exact squares of dimensions and pair sums, each entry rounded once.

    The squares are centred at whole numbers; what these lack to the means,
    r / n, is taken away exactly: n² var = n Σ z² - (Σ z)², with Σ z = r.
    """
    d = len(sums)
    r = [s - n * c for s, c in zip(sums, centre)]
    var, it = [[0] * d for _ in range(d)], iter(squares)
    for i in range(d):
        for j in range(i, d):
            mean = r[i] if i == j else r[i] + r[j]
            var[i][j] = n * next(it) - mean * mean               # n² times the variance of a dimension or a pair sum
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = var[i][i] / (n * n)
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = (var[i][j] - var[i][i] - var[j][j]) / (2 * n * n)
    return out


def _vectors(df: DataFrame, vec_col: str) -> DataFrame:
    return usable(df, vec_col).select(F.col(vec_col).cast("array<double>").alias("v"))


def fit(df: DataFrame, vec_col: str = "embedding", components: int = 32) -> Whitening:
    """The whitening of all usable vectors of ``df``.

    A vector that is null or holds a null or a number that isn't finite is left
    out, and so are vectors of another length than the most frequent one (of
    ties the longer); equal rows count each. Components are numbered by falling
    eigenvalue, the largest entry of each is positive. Directions without
    variance (up to rounding) can't be whitened and are no components, so a
    table of few or equal rows has fewer of them, and an empty one none.
    """
    vectors = _vectors(df, vec_col)
    dim = _dimensions(vectors)
    if not dim:
        return Whitening(0, [], [], [], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    vectors = vectors.filter(F.size("v") == dim)
    first = vectors.mapInArrow(_first_moments(dim), "pos int, limb int, value long, lo long, hi long")
    got = first.groupBy("pos", "limb").agg(F.sum("value").alias("value"), F.min("lo").alias("lo"),
                                           F.max("hi").alias("hi")).collect()      # a few rows a dimension
    sums, lo, hi = [0] * (dim + 1), [0] * dim, [0] * dim
    for r in got:
        sums[r["pos"]] += r["value"] << (_LIMB * r["limb"])
        if r["pos"] < dim and r["limb"] == 0:            # every task sends the first limb, and its range with it
            lo[r["pos"]], hi[r["pos"]] = r["lo"], r["hi"]
    n = sums.pop()
    centre = [(2 * s + n) // (2 * n) for s in sums]
    squares = _whole(vectors.mapInArrow(_pair_squares(dim, np.array(centre, np.int64)), "pos int, limb int, value long"),
                     dim * (dim + 1) // 2)
    v = covariance(n, sums, squares, centre)
    values, vectors_ = np.linalg.eigh(v)
    values, rows = values[::-1], vectors_[:, ::-1].T
    keep = values > dim * np.finfo(float).eps * 8 * max(float(values[0]), 0.0)
    values, rows = values[keep][:components], rows[keep][:components]
    if len(rows):
        largest = np.abs(rows).argmax(1)
        rows = rows * np.sign(rows[np.arange(len(rows)), largest])[:, None]
    trace = float(np.trace(v))
    return Whitening(n, sums, lo, hi, values, rows, values / trace if trace else values)


def _project(model: Whitening):
    n, dim = model.n, len(model.sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in model.sums], np.int64)
    rest = np.array([s - n * int(c) for s, c in zip(model.sums, centre)], object)
    mean_rest = np.array([int(r) / n for r in rest])
    whiten = (model.components / np.sqrt(model.values)[:, None]).T
    most = sum(max(abs(n * a - s), abs(n * b - s)) ** 2 for a, b, s in zip(model.lo, model.hi, model.sums))

    def run(batches):
        for b in batches:
            for a, x in _integers(b, dim):
                z = x - centre
                w = (z - mean_rest) @ whiten
                if most < 1 << 62:
                    d = n * z - rest.astype(np.int64)
                    deviation = pa.array(np.einsum("ij,ij->i", d, d)).cast(pa.decimal128(38, 0))
                else:
                    d = z.astype(object) * n - rest
                    deviation = pa.array([Decimal(v) if v < 10 ** 38 else None for v in (d * d).sum(1).tolist()],
                                         pa.decimal128(38, 0))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(model.values)), pa.array(w.ravel()))
                yield pa.record_batch([b.column("vec_id").slice(a, len(x)), deviation, lists],
                                      names=["vec_id", "deviation", "whitened"])
    return run


def transform(df: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row a usable vector: vec_id, deviation (sum of (n x - S)² over dimensions, exact; null beyond 38
    digits), whitened (one number a component).

    Vectors that ``fit`` leaves out have no row. Ids may be null or repeated,
    other columns are ignored, and no vectors give no rows.
    """
    ids = df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {ids}, deviation decimal(38,0), whitened array<double>"
    rows = usable(df, vec_col).select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.filter(F.size("v") == (len(model.sums) or -1)).mapInArrow(_project(model) if model.n else _nothing, schema)


def _nothing(batches):
    for _ in batches:
        yield from ()


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """The largest entry of |covariance of the whitened vectors - identity| (0 without components)."""
    k = len(model.values)
    if not k:
        return 0.0

    def moments(batches):
        total = np.zeros((k + 1, k))
        for b in batches:
            w = b.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, k)
            total[:k] += w.T @ w
            total[k] += w.sum(0)
        yield pa.record_batch([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
                              names=["pos", "value"])
    got = whitened.select("whitened").mapInArrow(moments, "pos int, value double").groupBy("pos").agg(
        F.sum("value").alias("value")).toArrow()                                   # (components + 1) x components
    total = np.zeros((k + 1) * k)
    total[got["pos"].to_numpy()] = got["value"].to_numpy()
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
