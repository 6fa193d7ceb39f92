"""Whitening of embeddings: blockwise QR, Householder bidiagonals, dqds singular values and twisted factorisations."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import kept, query, table

COMPONENTS = 8
SCALE, OFFSET = 1024.0, 100_000
BLOCK_BYTES = 1 << 23  # rows of one QR step
MERGE_BYTES = 1 << 26  # factors merged in one task
LARGEST = 1 << 43
CLUSTER = 1e-3  # relative gap below which eigenvectors are made orthogonal to each other
_EPS = float(np.finfo(np.float64).eps)
_TINY = 1e-280


class Fit(NamedTuple):
    """What the vectors of one length gave: their number, sums, eigenvalues and unit eigenvectors (columns), and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float


# ---- singular values and vectors of one triangular factor ----


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, beta and alpha with (I - beta v v') x = alpha e1."""
    norm = float(np.linalg.norm(x))
    v = x.copy()
    if norm == 0 or len(x) == 1:
        return v, 0.0, float(x[0])
    alpha = -math.copysign(norm, x[0])
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, upper off-diagonal b and orthogonal V of r = U B V', by Householder reflections from both sides."""
    m = r.astype(np.float64, copy=True)
    n = m.shape[1]
    right = np.eye(n)
    for k in range(n):
        v, beta, alpha = _reflector(m[k:, k])
        if beta:
            m[k:, k:] -= beta * np.outer(v, v @ m[k:, k:])
        m[k, k] = alpha
        if k + 2 <= n - 1:
            v, beta, alpha = _reflector(m[k, k + 1 :])
            if beta:
                m[k:, k + 1 :] -= beta * np.outer(m[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= beta * np.outer(right[:, k + 1 :] @ v, v)
            m[k, k + 1] = alpha
    return np.diag(m).copy(), np.diag(m, 1).copy(), right


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transform with a shift; None where the shift passes the least eigenvalue."""
    d, nq, ne, least = q[0] - shift, [], [], q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return None
        nq.append(max(d + e[k], _TINY))
        t = q[k + 1] / nq[k]
        ne.append(e[k] * t)
        d = d * t - shift
        least = min(least, d)
    if d < 0 or math.isnan(d):
        return None
    nq.append(max(d, _TINY))
    return nq, ne, least


def _tail_shift(q: list[float], e: list[float]) -> float:
    """The lesser eigenvalue of the last two rows, never below the least one of all."""
    a = q[-2] + (e[-2] if len(e) > 1 else 0.0)
    b, off = q[-1] + e[-1], q[-2] * e[-1]
    half = (a - b) / 2
    root = math.hypot(half, math.sqrt(off))
    return max(0.0, b - off / (abs(half) + root) if half >= 0 and abs(half) + root else (a + b) / 2 - root)


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values of the upper bidiagonal matrix, falling, by the differential quotient-difference algorithm with shifts.

    Squares of the entries are transformed without subtraction, so tiny values keep their relative accuracy; a shift is
    tried near the least eigenvalue and taken back where a quotient would turn negative.
    """
    top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if top == 0:
        return np.zeros(len(a))
    found: list[float] = []
    work = [([max((float(x) / top) ** 2, _TINY) for x in a], [(float(x) / top) ** 2 for x in b], 0.0)]
    while work:
        q, e, moved = work.pop()
        for _ in range(100 + 50 * len(q)):
            # split where an off-diagonal no longer matters
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= _EPS * _EPS * (moved + q[k]) or e[k] <= _EPS * _EPS * (moved + q[k + 1]) and k == len(e) - 1), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            if 1.5 * q[0] < q[-1]:  # the least value belongs at the end
                q, e = q[::-1], e[::-1]
            shift = _tail_shift(q, e)
            step = None
            for s in (shift * (1 - 1e-3 * min(1.0, e[-1] / max(q[-1], _TINY))) if e[-1] < 0.1 * q[-1] else 0.5 * shift, 0.25 * shift, 0.0):
                step = _qd_step(q, e, s)
                if step is not None:
                    moved += s
                    break
            q, e, _ = step
        else:
            raise ArithmeticError("the qd iteration did not converge")
    return top * np.sqrt(np.sort(np.array(found))[::-1])


class _Twisted:
    """B'B - shift = N D N', factored from both ends and joined where the middle pivot is least."""

    def __init__(self, a: np.ndarray, b: np.ndarray, shift: float):
        n = len(a)
        d, off, square = (a * a).tolist(), (a[:-1] * b).tolist(), (b * b).tolist()
        floor = _EPS * max(shift, _TINY)
        down, up = [0.0] * n, [0.0] * n
        s, p = [-shift] * n, [d[-1] - shift] * n
        self.low, self.high = [0.0] * max(0, n - 1), [0.0] * max(0, n - 1)
        for k in range(n - 1):
            down[k] = s[k] + d[k] if abs(s[k] + d[k]) > floor * _EPS else floor * _EPS
            self.low[k] = off[k] / down[k]
            s[k + 1] = square[k] * (s[k] / down[k]) - shift
        for k in range(n - 2, -1, -1):
            pivot = square[k] + p[k + 1]
            up[k + 1] = pivot if abs(pivot) > floor * _EPS else floor * _EPS
            self.high[k] = off[k] / up[k + 1]
            p[k] = d[k] * (p[k + 1] / up[k + 1]) - shift
        middle = [s[k] + p[k] + shift for k in range(n)]
        self.at = min(range(n), key=lambda k: abs(middle[k]))
        self.middle = middle[self.at]
        pivots = [*down[: self.at], self.middle if abs(self.middle) > floor * _EPS else floor * _EPS, *up[self.at + 1 :]]
        self.pivots = np.array(pivots)

    def vector(self) -> np.ndarray:
        """Solves for the unit vector at the twist: an eigenvector where the shift is an eigenvalue."""
        z = np.zeros(len(self.pivots))
        z[self.at] = 1.0
        for k in range(self.at - 1, -1, -1):
            z[k] = -self.low[k] * z[k + 1]
        for k in range(self.at, len(z) - 1):
            z[k + 1] = -self.high[k] * z[k]
        return z

    def solve(self, y: np.ndarray) -> np.ndarray:
        y, r, n = y.copy(), self.at, len(y)
        for k in range(r):
            y[k + 1] -= self.low[k] * y[k]
        for k in range(n - 2, r - 1, -1):
            y[k] -= self.high[k] * y[k + 1]
        y /= self.pivots
        for k in range(r - 1, -1, -1):
            y[k] -= self.low[k] * y[k + 1]
        for k in range(r, n - 1):
            y[k + 1] -= self.high[k] * y[k]
        return y


def _orthogonal(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            z = z - (o @ z) * o
    return z


def right_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of B'B for the given largest singular values, falling.

    Each comes from a twisted factorisation at its eigenvalue, improved by the middle pivot. Those of near eigenvalues are made
    orthogonal; where that leaves little, inverse iteration with the same factors starts from another vector.
    """
    n, out = len(a), []
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0), _TINY)
    a, b = a / scale, b / scale
    limits = [0, *[k + 1 for k in range(n - 1) if abs(b[k]) <= _EPS * _EPS], n]
    blocks = [(lo, hi, dqds(a[lo:hi], b[lo : hi - 1])) for lo, hi in zip(limits[:-1], limits[1:], strict=True)]
    taken = [0] * len(blocks)
    eigen = [float((v / scale) ** 2) for v in values]
    for number, value in enumerate(eigen):
        # the block whose next value is nearest
        k = min((k for k in range(len(blocks)) if taken[k] < len(blocks[k][2])), key=lambda k: abs(blocks[k][2][taken[k]] ** 2 - value))
        lo, hi, own = blocks[k]
        shift = float(own[taken[k]] ** 2)
        taken[k] += 1
        for _ in range(3):
            f = _Twisted(a[lo:hi], b[lo : hi - 1], shift)
            z = f.vector()
            step = f.middle / float(z @ z)
            if abs(step) <= 2 * _EPS * shift or abs(step) > 1e-3 * shift:
                break
            shift += step
        near = [out[i][lo:hi] for i in range(number) if abs(eigen[i] - value) <= CLUSTER * eigen[i]]
        z = z / np.linalg.norm(z)
        free = _orthogonal(z, near)
        rng = np.random.default_rng(number)
        for _ in range(10):
            if np.linalg.norm(free) > 0.5:
                break
            start = free / max(np.linalg.norm(free), _TINY) if np.linalg.norm(free) > 1e-8 else _orthogonal(rng.normal(size=hi - lo), near)
            z = f.solve(start)
            free = _orthogonal(z / np.linalg.norm(z), near)
        whole = np.zeros(n)
        whole[lo:hi] = free / np.linalg.norm(free)
        out.append(whole)
    return np.stack(out, axis=1) if out else np.zeros((n, 0))


def principal(r: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Largest eigenvalues and unit eigenvectors of r'r / n, and its trace; values that are zero to rounding are left out."""
    a, b, right = bidiagonal(r)
    singular = dqds(a, b)
    real = singular[singular > 8 * len(a) * _EPS * singular.max(initial=0.0)][:components]
    directions = right @ right_vectors(a, b, real)
    directions /= np.linalg.norm(directions, axis=0) if len(real) else 1.0
    return real**2 / n, directions, float((singular**2).sum()) / n


# ---- Spark ----


def valid(vec: Column) -> Column:
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def _integers(vec: Column, scale: float, offset: int) -> Column:
    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for v in s:
                x = np.floor(np.asarray(v, dtype=np.float64) * scale)
                if np.abs(x).max(initial=0.0) >= LARGEST:
                    raise ValueError("a component is too large for exact sums")
                out.append((x.astype(np.int64) + offset).astype("<i8").tobytes())
            yield pd.Series(out, dtype=object)

    return of(vec)


def _matrix(blobs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<i8").reshape(len(blobs), dim)


def scaled_centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit where it fits, Python's integers otherwise."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 61:
        return n * x - np.array(sums, dtype=np.int64)[None, :]
    return n * x.astype(object) - np.array(sums, dtype=object)[None, :]


def deviations(d: np.ndarray) -> list[int]:
    """Sum of squares of each row, exact."""
    if d.dtype != object and d.size and int(np.abs(d).max()) ** 2 * d.shape[1] < 1 << 62:
        return (d * d).sum(axis=1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in d.tolist()]


def _merged(parts: DataFrame, merge: Callable[[list[bytes], int], bytes], name: str, width: Callable[[int], int]) -> dict[int, bytes]:
    """``dim, part, blob`` rows to one blob a dimension, merged in rounds of bounded tasks; the last ones come to the driver."""
    schema = "dim int, part int, blob binary"
    while True:
        parts = kept(parts, name)
        most = parts.agg(F.max("part")).first()[0]
        if not most:
            return {r["dim"]: bytes(r["blob"]) for r in parts.collect()}
        widest = parts.agg(F.max("dim")).first()[0]
        fan = max(2, min(64, MERGE_BYTES // max(1, width(widest))))
        grouped = parts.withColumn("part", F.floor(F.col("part") / fan).cast("int"))

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            dim = int(pdf["dim"].iloc[0])
            return pd.DataFrame([{"dim": dim, "part": int(pdf["part"].iloc[0]), "blob": merge([bytes(b) for b in pdf["blob"]], dim)}])

        parts = grouped.groupBy("dim", "part").applyInPandas(one, schema)


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r") if len(rows) else rows


def _sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Count and exact sums per dimension, for each length of vector."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for pdf in batches:
            for dim, own in pdf.groupby("dim", sort=False):
                at = held.setdefault(int(dim), [0, [0] * int(dim)])
                at[0] += len(own)
                x = _matrix(own["x"].tolist(), int(dim))
                at[1] = [p + q for p, q in zip(at[1], x.sum(axis=0).tolist(), strict=True)]
        for dim, (n, sums) in held.items():
            yield pd.DataFrame({"dim": dim, "pos": range(-1, dim), "total": [Decimal(v) for v in (n, *sums)]})

    totals = rows.select("dim", "x").mapInPandas(partial, "dim int, pos int, total decimal(38,0)").groupBy("dim", "pos").agg(F.sum("total").alias("total"))
    found: dict[int, dict[int, int]] = {}
    for r in totals.collect():  # one number for each dimension of each length of vector
        found.setdefault(r["dim"], {})[r["pos"]] = int(r["total"])
    return {dim: (t[-1], [t[k] for k in range(dim)]) for dim, t in found.items()}


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """A ``Fit`` for each length of vector, of ``dim, x`` rows (x: 64-bit integers as bytes)."""
    sums = _sums(rows)
    sent = rows.sparkSession.sparkContext.broadcast(sums)  # one number for each dimension

    def factors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        part = None
        for pdf in batches:
            part = int(pdf["part"].iloc[0])
            for dim, own in pdf.groupby("dim", sort=False):
                dim = int(dim)
                n, s = sent.value[dim]
                step = max(dim, BLOCK_BYTES // (8 * max(1, dim)))
                for lo in range(0, len(own), step):
                    x = _matrix(own["x"].iloc[lo : lo + step].tolist(), dim)
                    centred = (scaled_centred(x, n, s) / n).astype(np.float64)
                    held[dim] = _triangle(np.concatenate((held[dim], centred)) if dim in held else centred)
        for dim, r in held.items():
            yield pd.DataFrame([{"dim": dim, "part": part, "blob": r.astype("<f8").tobytes()}])

    def merge(blobs: list[bytes], dim: int) -> bytes:
        r = np.zeros((0, dim))
        for b in blobs:
            r = _triangle(np.concatenate((r, np.frombuffer(b, dtype="<f8").reshape(-1, dim))))
        return r.astype("<f8").tobytes()

    parts = rows.where("dim > 0").select("dim", "x", F.spark_partition_id().alias("part")).mapInPandas(factors, "dim int, part int, blob binary")
    fits = {}
    for dim, blob in _merged(parts, merge, "factors", lambda dim: 8 * dim * dim).items():
        r = np.zeros((dim, dim))
        got = np.frombuffer(blob, dtype="<f8").reshape(-1, dim)
        r[: len(got)] = got
        fits[dim] = Fit(*sums[dim], *principal(r, sums[dim][0], components))
    return fits


def _identity_errors(white: DataFrame) -> dict[int, float]:
    """Largest absolute entry of the whitened rows' covariance minus the identity, centred before multiplying."""

    def join(a: tuple, b: tuple) -> tuple:
        n, gap = a[0] + b[0], b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def pack(m: tuple) -> bytes:
        return np.concatenate(([float(m[0])], m[1], m[2].ravel())).astype("<f8").tobytes()

    def unpack(blob: bytes) -> tuple:
        v = np.frombuffer(blob, dtype="<f8")
        k = int(round((math.sqrt(4 * len(v) - 3) - 1) / 2))
        return int(v[0]), v[1 : 1 + k], v[1 + k :].reshape(k, k)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}
        part = None
        for pdf in batches:
            part = int(pdf["part"].iloc[0])
            for dim, own in pdf.groupby("dim", sort=False):
                w = np.stack(own["whitened"].tolist())
                mean = w.mean(axis=0)
                new = len(w), mean, (w - mean).T @ (w - mean)
                held[int(dim)] = join(held[int(dim)], new) if int(dim) in held else new
        for dim, m in held.items():
            yield pd.DataFrame([{"dim": dim, "part": part, "blob": pack(m)}])

    def merge(blobs: list[bytes], dim: int) -> bytes:
        total = unpack(blobs[0])
        for b in blobs[1:]:
            total = join(total, unpack(b))
        return pack(total)

    parts = white.where(F.size("whitened") > 0).select("dim", "whitened", F.spark_partition_id().alias("part")).mapInPandas(moments, "dim int, part int, blob binary")
    out = {}
    for dim, blob in _merged(parts, merge, "moments", lambda dim: 1024).items():
        n, _, m = unpack(blob)
        out[dim] = float(np.abs(m / n - np.eye(len(m))).max())
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = SCALE,
           offset: int = OFFSET) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, eigenvalue, identity_error``: a row for each vector and component.

    Vectors that are null or hold null or non-finite numbers are dropped; x is floor(scale * number) + offset. ``deviation``
    (decimal, exact) is the sum over dimensions of (n x - S)^2, ``whitened`` the centred x along a principal direction over
    its standard deviation. Components are numbered from the largest variance; those without variance are left out, so equal
    or single vectors and vectors of length 0 give no rows. Each length of vector is a fit of its own. Ids may be null or
    repeat: every row is fitted and returned by itself. An empty table gives no rows; other columns play no part. Numbers beyond
    2^43 after scaling raise an error.

    Rows meet QR in blocks; the triangles (vector length squared) are merged in rounds, and the last comes to the driver, which
    bidiagonalises it, finds its singular values by dqds and their directions by twisted factorisations.
    """
    chosen = vectors.where(valid(F.col(vec_col))).select(
        F.col(id_col).alias("vec_id"), F.size(vec_col).alias("dim"), _integers(F.col(vec_col), scale, offset).alias("x"))
    rows = kept(chosen, "integers")
    fits = fit(rows, components)
    sent = rows.sparkSession.sparkContext.broadcast(fits)  # a few directions for each length of vector

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, own in pdf.groupby("dim", sort=False):
                f = sent.value[int(dim)]
                d = scaled_centred(_matrix(own["x"].tolist(), int(dim)), f.n, f.sums)
                w = (d / f.n).astype(np.float64) @ f.directions / np.sqrt(f.values)
                yield pd.DataFrame({"vec_id": own["vec_id"], "dim": dim, "deviation": [Decimal(v) for v in deviations(d)], "whitened": list(w)})

    ids = rows.schema["vec_id"].dataType.simpleString()
    white = kept(rows.where("dim > 0").mapInPandas(apply, f"vec_id {ids}, dim int, deviation decimal(38,0), whitened array<double>"), "whitened")
    errors = _identity_errors(white)
    facts = [(dim, k + 1, f.n, float(f.values[k] / f.trace), float(f.values[k]), errors[dim]) for dim, f in fits.items() for k in range(len(f.values))]
    known = rows.sparkSession.createDataFrame(facts, "_dim int, _k int, n bigint, explained double, eigenvalue double, identity_error double")
    each = white.select("vec_id", "dim", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    return each.join(known, (F.col("dim") == F.col("_dim")) & (F.col("pos") + 1 == F.col("_k"))).select(
        "vec_id", F.col("_k").alias("component"), "n", "deviation", "whitened", "explained", "eigenvalue", "identity_error")


@query("op12_qd_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(table(spark, sf_dir, "embeddings"))
    # a deviation beyond a long, which takes millions of vectors, is null in this column
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))
