"""Whitening of embeddings by a bidiagonal qd solver.

Components are quantised to integers, floor(256 c). The fit list is every distinct vector once.

1. Counts and sums per dimension are exact (integers per task, then one sum).
2. Blockwise QR: every task folds its centred rows, block by block, into one triangle R;
   triangles are folded ``FAN`` at a time until one is left. Centring is exact (n x - S in
   integers) and comes before any product; the covariance matrix is never formed.
3. Householder reflections turn R into a bidiagonal B, keeping the right-hand ones.
4. dqds (differential quotient-difference with shifts) finds the singular values of B to high
   relative accuracy; their squares over n are the eigenvalues of the covariance.
5. A twisted factorisation of B'B - s^2 I, twisted where its middle pivot is least, gives each
   direction; directions of close values are solved for again and kept orthogonal. The reflections
   take them back to the space of the vectors.
6. Every row is projected; the covariance of the whitened fit list is measured.

Only directions and sums (a few numbers per dimension) reach the driver. Vectors of different lengths are fitted
apart, each length by itself.

Defined results: vectors that are null or hold null or non-finite entries take no part, empty ones have no
components; repeated rows each get their results; a null vec_id stays null; integers beyond a long are cut to its
range, and so is a deviation; a component without variance (a singular value of at most ``FLAT``
of the largest) has explained as measured and whitened null; where nothing varies explained is null;
the sign of a direction makes its largest entry positive; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import saved

SCALE, COMPONENTS = 256.0, 4
#: Numbers in a block of rows, triangles folded at a time, and the share of the largest singular value that counts as none.
CELLS, FAN, FLAT = 1 << 21, 16, 1e-11
_EPS = np.finfo(float).eps
_LONG = 2 ** 63 - 1


# -- the solver -------------------------------------------------------------------------

def fold(triangle: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """The triangle of all rows so far (Householder QR of the triangle above the new rows)."""
    return np.linalg.qr(rows if triangle is None else np.vstack([triangle, rows]), mode="r")


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V': Householder reflections from both sides."""
    a = np.array(r, dtype=float)
    d = a.shape[1]
    if a.shape[0] < d:
        a = np.vstack([a, np.zeros((d - a.shape[0], d))])
    v = np.eye(d)

    def reflector(x):
        size = np.abs(x).max(initial=0.0)
        if not size or not np.abs(x[1:]).max(initial=0.0):
            return None
        u = x / size
        u[0] += math.copysign(np.linalg.norm(u), u[0])
        return u / np.linalg.norm(u)

    for k in range(d):
        u = reflector(a[k:, k])
        if u is not None:
            a[k:, k:] -= 2.0 * np.outer(u, u @ a[k:, k:])
        if k + 2 < d:
            u = reflector(a[k, k + 1:])
            if u is not None:
                a[k:, k + 1:] -= 2.0 * np.outer(a[k:, k + 1:] @ u, u)
                v[:, k + 1:] -= 2.0 * np.outer(v[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds_pass(q: list, e: list, lo: int, hi: int, shift: float):
    """One differential qd transform of a segment: (q, e, least d), or None if the shift is too large."""
    new_q, new_e = [], []
    d = q[lo] - shift
    least = d
    for i in range(lo, hi):
        if d < 0:
            return None
        total = d + e[i]
        if total == 0.0:
            return None
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, least


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix by dqds, largest first."""
    size = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if not size:
        return np.zeros(len(diagonal))
    q, e = ((diagonal / size) ** 2).tolist(), ((above / size) ** 2).tolist()
    tiny, out, tasks = (16 * _EPS) ** 2, [], [(0, len(q) - 1, 0.0)]
    while tasks:
        lo, hi, moved = tasks.pop()
        guess, left = 0.0, 200 * (hi - lo + 1)
        while lo < hi:
            cut = next((i for i in range(hi - 1, lo - 1, -1) if e[i] <= tiny * (moved + min(q[i], q[i + 1]))
                        or e[i] <= 1e-280), None)
            if cut is not None:
                e[cut] = 0.0
                if cut == hi - 1:  # the last value stands alone
                    out.append(q[hi] + moved)
                    hi -= 1
                    guess = 0.0
                    continue
                tasks.append((lo, cut, moved))
                lo, guess = cut + 1, 0.0
                continue
            left -= 1
            if left < 0:
                raise ArithmeticError("dqds did not converge")
            # the lesser value of the last two rows is above the least of all: aim a little below
            p, s, t = q[hi - 1], e[hi - 1], q[hi]
            mean, det = 0.5 * (p + s + t), p * t
            pair = det / (mean + math.sqrt(max(0.0, mean * mean - det))) if mean else 0.0
            shift = min(pair, guess) if guess > 0 else 0.0
            made = None
            for part in (1.0 - 4 * _EPS, 0.75, 0.25, 0.0):
                made = _dqds_pass(q, e, lo, hi, shift * part)
                if made is not None:
                    shift *= part
                    break
                if not shift:
                    break
            if made is None:  # a zero pivot: one step of exact zeros splits the segment
                weak = min(range(lo, hi), key=lambda i: e[i])
                e[weak] = 0.0
                continue
            q[lo:hi + 1], e[lo:hi], guess = made
            moved += shift
        out.append(q[lo] + moved)
    return size * np.sqrt(np.sort(np.array(out))[::-1])


class Twisted:
    """Twisted factorisation of B'B - s^2 I, twisted where the middle pivot is least."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n, lam = len(diagonal), value * value
        a2, b2, ab = diagonal ** 2, above ** 2, diagonal[:-1] * above
        guard = max(_EPS * _EPS * max(a2.max(initial=0.0), b2.max(initial=0.0)), 1e-290)
        safe = lambda x: x if abs(x) > guard else math.copysign(guard, x)
        top, down, s = np.zeros(n), np.zeros(n), np.zeros(n)
        bottom, up, p = np.zeros(n), np.zeros(n), np.zeros(n)
        s[0] = -lam
        for i in range(n - 1):
            top[i] = safe(s[i] + a2[i])
            down[i] = ab[i] / top[i]
            s[i + 1] = b2[i] / top[i] * s[i] - lam
        p[n - 1] = a2[n - 1] - lam
        for i in range(n - 2, -1, -1):
            bottom[i + 1] = safe(b2[i] + p[i + 1])
            up[i] = ab[i] / bottom[i + 1]
            p[i] = a2[i] / bottom[i + 1] * p[i + 1] - lam
        middle = s + p + lam
        self.middle = middle
        self.at = int(np.abs(middle).argmin())
        self.pivot = safe(middle[self.at])
        self.top, self.bottom, self.down, self.up = top, bottom, down, up

    def solve(self, right: np.ndarray) -> np.ndarray:
        """x with (B'B - s^2 I) x = right, up to its size."""
        n, r, y = len(right), self.at, right.astype(float).copy()
        for i in range(r):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(n - 1, r, -1):
            y[i - 1] -= self.up[i - 1] * y[i]
        x = np.empty(n)
        x[r] = y[r] / self.pivot
        for i in range(r - 1, -1, -1):
            x[i] = y[i] / self.top[i] - self.down[i] * x[i + 1]
        for i in range(r + 1, n):
            x[i] = y[i] / self.bottom[i] - self.up[i - 1] * x[i - 1]
        return x

    def vector(self) -> np.ndarray:
        """The direction whose equation fails at the twist only."""
        z = np.zeros(len(self.top))
        z[self.at] = self.pivot
        return self.solve(z)


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Right singular vectors (columns) of the ``count`` largest ``values`` of a bidiagonal matrix."""
    n, size = len(diagonal), values[0] if len(values) else 0.0
    out = np.zeros((n, count))
    rng = np.random.default_rng(20)
    for j in range(count):
        near = [i for i in range(j) if values[i] - values[j] <= 1e-3 * values[i] or values[i] <= FLAT * size]
        split = Twisted(diagonal, above, values[j])
        x = split.vector()
        if not np.isfinite(x).all() or not np.abs(x).max():
            x = rng.standard_normal(n)
        x /= np.linalg.norm(x)
        for _ in range(4 if near or not size else 1):
            for _ in range(2):
                x -= out[:, near] @ (out[:, near].T @ x)
            length = np.linalg.norm(x)
            if length < 1e-8:  # along the others: start anew
                x = rng.standard_normal(n)
                x -= out[:, near] @ (out[:, near].T @ x)
                length = np.linalg.norm(x)
            y = split.solve(x / length)
            big = np.abs(y).max()
            if not np.isfinite(big) or not big:
                x /= length
                break
            x = y / big
            x /= np.linalg.norm(x)
        for _ in range(2):
            x -= out[:, near] @ (out[:, near].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def solved(triangle: np.ndarray, n: int, count: int = COMPONENTS) -> list[tuple[int, float, float | None, list[float], bool]]:
    """(component, eigenvalue, explained, direction, flat) of the covariance triangle' triangle / n."""
    diagonal, above, v = bidiagonal(triangle)
    values = singular_values(diagonal, above)
    count = min(count, len(values))
    trace = float((triangle ** 2).sum()) / n
    found = v @ directions(diagonal, above, values, count)
    out = []
    for k in range(count):
        one = found[:, k] / np.linalg.norm(found[:, k])
        one = one * math.copysign(1.0, one[int(np.abs(one).argmax())])
        e = float(values[k]) ** 2 / n
        out.append((k + 1, e, e / trace if trace > 0 else None, one.tolist(), bool(values[k] <= FLAT * values[0])))
    return out


# -- the jobs ---------------------------------------------------------------------------

def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, x) of the rows whose vector is whole and finite."""
    c = F.col("embedding").cast("array<double>")
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    x = F.transform(c, lambda v: F.floor(v * SCALE).cast("long"))
    return vectors.where(F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True))) \
        .select("vec_id", F.size("embedding").cast("long").alias("dim"), x.alias("x")).where("dim > 0")


def blocks(batches, column: int):
    """(dim, rows of the batch, matrix of integers) of blocks of at most ``CELLS`` numbers."""
    import pyarrow as pa

    for batch in batches:
        dims = np.asarray(batch.column(column))
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            for a in range(0, len(at), max(1, CELLS // dim)):
                rows = at[a:a + max(1, CELLS // dim)]
                held = batch.take(pa.array(rows))
                yield dim, held, np.asarray(held.column(column + 1).flatten()).reshape(-1, dim)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S: integers of 64 bits where they fit, else Python integers."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * largest + max(map(abs, sums), default=0) < 2 ** 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squares(z: np.ndarray) -> np.ndarray:
    """Sum of squares of each row, exact, cut to the range of a long."""
    if z.dtype != object and z.shape[1] * float(np.abs(z).max(initial=0)) ** 2 < 2.0 ** 62:
        return (z * z).sum(axis=1)
    return np.array([min(_LONG, sum(int(v) ** 2 for v in row)) for row in z], dtype=np.int64)


def moments(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """dim -> (n, sums per dimension), exact; one number per dimension comes to the driver."""
    import pyarrow as pa

    def summed(batches):
        held: dict[int, tuple[int, np.ndarray]] = {}
        for dim, _, x in blocks(batches, 0):
            n, s = held.get(dim, (0, np.zeros(dim, dtype=object)))
            held[dim] = (n + len(x), s + np.array([int(v) for v in _exact_sums(x)], dtype=object))
        from decimal import Decimal
        for dim, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int64()), pa.array(range(dim), pa.int64()), pa.array([n] * dim, pa.int64()),
                 pa.array([Decimal(v) for v in s], pa.decimal128(38, 0))], names=["dim", "pos", "n", "s"])

    parts = fit.mapInArrow(summed, "dim long, pos long, n long, s decimal(38,0)")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim", "pos").collect():
        out.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))
    return out


def _exact_sums(x: np.ndarray) -> np.ndarray:
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    return x.sum(axis=0) if largest * len(x) < 2 ** 62 else x.astype(object).sum(axis=0)


_ROWS = "dim long, part long, row array<double>"


def triangles(fit: DataFrame, known) -> DataFrame:
    """(dim, part, row): the rows of one triangle per task; ``known`` is the broadcast of ``moments``."""
    import pyarrow as pa
    from pyspark import TaskContext

    def folded(batches):
        held: dict[int, np.ndarray] = {}
        for dim, _, x in blocks(batches, 0):
            n, sums = known.value[dim]
            held[dim] = fold(held.get(dim), centred(x, n, sums).astype(float) / n)
        part = TaskContext.get().partitionId()
        for dim, r in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * len(r), pa.int64()), pa.array([part] * len(r), pa.int64()),
                                              pa.array(list(r), pa.list_(pa.float64()))], names=["dim", "part", "row"])

    return fit.mapInArrow(folded, _ROWS)


def _folded(key, rows: pd.DataFrame) -> pd.DataFrame:
    dim, part = key
    r = None
    matrix = np.array([np.asarray(v, dtype=float) for v in rows["row"]]).reshape(-1, dim)
    for a in range(0, len(matrix), max(1, CELLS // dim)):
        r = fold(r, matrix[a:a + max(1, CELLS // dim)])
    return pd.DataFrame({"dim": dim, "part": part, "row": list(r)})


def fit(vectors: DataFrame, count: int = COMPONENTS) -> tuple[DataFrame, dict]:
    """The distinct vectors (dim, x) as a saved table, and per length (n, sums, components), the
    components as of ``solved``."""
    spark = vectors.sparkSession
    distinct = saved(quantised(vectors).select("dim", "x").distinct(), "whitening-fit")
    known = moments(distinct)
    sums = spark.sparkContext.broadcast(known)
    rows = saved(triangles(distinct, sums), "whitening-rows")
    parts = rows.agg(F.max("part")).first()[0] or 0
    while parts >= FAN:
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("dim", "part").applyInPandas(_folded, _ROWS)
        parts //= FAN

    def answered(key, group: pd.DataFrame) -> pd.DataFrame:
        dim = key[0]
        r = np.array([np.asarray(v, dtype=float) for v in _folded((dim, 0), group)["row"]]).reshape(-1, dim)
        made = solved(r, sums.value[dim][0], count)
        return pd.DataFrame({"dim": dim, "component": [m[0] for m in made], "eigenvalue": [m[1] for m in made], "explained": [m[2] for m in made],
                             "direction": [m[3] for m in made], "flat": [m[4] for m in made]})

    kind = "dim long, component int, eigenvalue double, explained double, direction array<double>, flat boolean"
    model = {dim: (n, s, []) for dim, (n, s) in known.items()}
    for r in rows.groupBy("dim").applyInPandas(answered, kind).orderBy("dim", "component").collect():
        model[r["dim"]][2].append(tuple(r)[1:])
    return distinct, model


def _projected(x: np.ndarray, model) -> tuple[np.ndarray, np.ndarray]:
    """Whitened coordinates (rows by components, NaN where flat) and n x - S."""
    n, sums, parts = model
    z = centred(x, n, sums)
    axes = np.array([np.asarray(p[3]) for p in parts]).reshape(len(parts), x.shape[1])
    scale = np.array([math.sqrt(p[1]) if not p[4] and p[1] > 0 else math.nan for p in parts])
    return (z.astype(float) / n) @ axes.T / scale, z


def identity_errors(distinct: DataFrame, shipped) -> dict[int, float]:
    """dim -> largest entry of the whitened fit list's covariance less the identity. Rows are
    centred on the mean of the fit list, and again on each block's own."""
    import pyarrow as pa

    def spread(batches):
        for dim, _, x in blocks(batches, 0):
            w, _ = _projected(x, shipped.value[dim])
            own = w.mean(axis=0)
            inner = (w - own).T @ (w - own)
            a, b = np.indices(inner.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(a), pa.int64()), pa.array(a), pa.array(b), pa.array([len(x)] * len(a), pa.int64()), pa.array(own[a] * len(x)),
                 pa.array(own[b] * len(x)), pa.array((inner + len(x) * np.outer(own, own)).ravel())],
                names=["dim", "a", "b", "n", "sa", "sb", "m"])

    parts = distinct.mapInArrow(spread, "dim long, a long, b long, n long, sa double, sb double, m double")
    total = parts.groupBy("dim", "a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "m")])
    entry = F.col("m") / F.col("n") - F.col("sa") / F.col("n") * F.col("sb") / F.col("n") - F.when(F.col("a") == F.col("b"), 1.0).otherwise(0.0)
    worst = total.where(~F.isnan("m")).groupBy("dim").agg(F.max(F.abs(entry)).alias("worst"))
    return {r["dim"]: r["worst"] for r in worst.collect()}


def whiten(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row of
    ``vectors`` (vec_id, embedding) and each of its first ``count`` components."""
    import pyarrow as pa

    sc = vectors.sparkSession.sparkContext
    distinct, model = fit(vectors, count)
    shipped = sc.broadcast(model)
    errors = identity_errors(distinct, shipped)

    def told(batches):
        for dim, held, x in blocks(batches, 1):
            model = shipped.value[dim]
            w, z = _projected(x, model)
            k, rows = len(model[2]), len(x)
            each = np.repeat(np.arange(rows), k)
            flat = w.ravel()
            yield pa.RecordBatch.from_arrays(
                [held.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array([model[0]] * (rows * k), pa.int64()),
                 pa.array(squares(z)[each]), pa.array(flat, mask=np.isnan(flat)), pa.array([p[2] for p in model[2]] * rows, pa.float64()),
                 pa.array([errors.get(dim)] * (rows * k), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = quantised(vectors)
    kind = dict(rows.dtypes)["vec_id"]
    return rows.mapInArrow(told, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
