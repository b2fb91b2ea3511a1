"""Whitened leading components of vectors, by Chebyshev-filtered subspace iteration.

Method: the leading eigenvectors of the covariance V of the distinct quantised vectors are found without forming V. A block of
``b`` columns Q is multiplied as ``V Q``, in one pass over the distributed rows: each task centres its rows and sends
``X^T (X Q)``, a sum of d rows. A polynomial of V, by the three-term recurrence of the Chebyshev polynomials on the unwanted
part of the spectrum, from 0 to the block's smallest Ritz value, damps that part and lifts the rest; then QR, one
more pass, and Rayleigh-Ritz. This repeats until the residuals of the wanted pairs are at the rounding of double
precision. Degrees are set by what is still missing: the distance between the wanted values and the block's
smallest gives the growth of a step.

Sums of the vectors, their number and the deviations are whole numbers and exact. What a task sends is d times b numbers, whatever its
rows; they are added by Spark in groups of one dimension. The driver holds d times b numbers a few times over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, mapped

SCALE = 256
COMPONENTS = 4
#: Columns of the block beyond the wanted ones: the more, the faster the polynomial grows on the wanted part.
GUARD = 28
#: Most passes of one filter; at this growth rounding would flood the smaller columns.
MOST_DEGREE, MOST_GROWTH = 40, 1e9
MOST_FILTERS = 200
#: Residuals, as a part of the largest eigenvalue, that count as rounding.
CERTIFIED = 2e-15
#: An eigenvalue below this part of the largest is rounding: the vectors have no further component.
RANK = 1e-12
LONG = (1 << 63) - 1


def _quantised(dim: int):
    """Whole-number vectors in bytes, ended by zeros to ``dim`` entries; rows that hold a null or non-finite entry go."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("v")
        size = np.asarray(lists.value_lengths())
        flat = np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)  # a null is NaN
        owner = np.repeat(np.arange(len(size)), size)
        fine = np.ones(len(size), bool)
        fine[owner[~np.isfinite(flat)]] = False
        x = np.zeros((len(size), dim), np.int64)
        entry = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        with np.errstate(over="ignore"):
            whole = np.floor(flat * SCALE)
        keep = fine[owner]
        x[owner[keep], entry[keep]] = _long(whole[keep])
        packed = pa.array([r.tobytes() for r in x[fine]], pa.binary())
        return pa.record_batch({"vec_id": batch.column("vec_id").filter(pa.array(fine)), "x": packed})

    return one


def _long(x: np.ndarray) -> np.ndarray:
    """As whole numbers; those beyond a long stop at its ends."""
    most = float(1 << 63)
    inside = np.clip(x, -most, np.nextafter(most, 0)).astype(np.int64)
    return np.where(x >= most, LONG, inside)


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


@dataclass(frozen=True)
class Centre:
    """Number of fitted vectors and the exact sums of their dimensions."""

    n: int
    sums: list[int]

    def of(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean: the whole part is taken off exactly first."""
        whole = [s // self.n for s in self.sums]
        part = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])
        span = max(abs(w) for w in whole) if whole else 0
        if span + int(np.abs(x).max(initial=0).astype(np.float64)) < 1 << 52:
            return (x - np.array(whole, np.int64)).astype(np.float64) - part
        return (x.astype(object) - np.array(whole, object)).astype(np.float64) - part

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n * x - S)^2, exact; beyond a long they stop at its end."""
        largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        span = self.n * largest + max((abs(s) for s in self.sums), default=0)
        kind = np.int64 if span * span * max(len(self.sums), 1) <= LONG else object
        away = x.astype(kind) * self.n - np.array(self.sums, kind)
        return [min(int(s), LONG) for s in (away * away).sum(axis=1)] if x.shape[1] else [0] * len(x)


def _summed(rows: DataFrame, dim: int, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``part`` (rows -> dim or fewer rows of ``width`` numbers); one row a
    dimension and task is shuffled."""

    def tasks(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in stream:
            if batch.num_rows:
                found = part(_rows(batch.column("x"), dim))
                total = found if total is None else total + found
        if total is not None:
            columns = {f"c{j}": np.ascontiguousarray(total[:, j]) for j in range(width)}
            yield pa.record_batch({"dim": np.arange(len(total), dtype=np.int32)} | columns)

    names = [f"c{j}" for j in range(width)]
    sums = rows.select("x").mapInArrow(tasks, "dim int, " + ", ".join(f"{c} double" for c in names))
    out = sums.groupBy("dim").agg(*[F.sum(c).alias(c) for c in names]).orderBy("dim").toArrow()
    return np.array([out.column(c).to_numpy() for c in names]).T


def _centre(fit: DataFrame, dim: int) -> Centre:
    """Exact count and sums: each task's sums go as whole numbers of up to 38 digits."""

    def tasks(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in stream:
            x = _rows(batch.column("x"), dim) if batch.num_rows else np.zeros((0, dim), np.int64)
            # Halves of 32 bits, whose sums over a batch fit a long.
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(m) for t, h, m in zip(total, high, low, strict=True)]
            n += len(x)
        if n:
            yield pa.record_batch(
                {
                    "dim": pa.array(range(-1, dim), pa.int32()),
                    "s": pa.array([str(n), *map(str, total)], pa.string()),
                }
            )

    sums = fit.select("x").mapInArrow(tasks, "dim int, s string")
    found = sums.groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    of = {r.dim: int(r.s) for r in found}
    return Centre(of.get(-1, 0), [of.get(d, 0) for d in range(dim)])


def _degree(growth: float, missing: float) -> int:
    """Passes after which the wanted part has grown by ``missing`` against the rest, within bounds.

    ``growth`` is where the smallest wanted value lies when the unwanted spectrum is mapped to -1 to 1."""
    rate = float(np.arccosh(max(growth, 1 + 1e-6)))
    return int(np.clip(np.ceil(np.log(2 * missing) / rate), 2, MOST_DEGREE))


def eigenpairs(
    times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, guard: int = GUARD, seed: int = 11
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors (columns) of the symmetric, non-negative
    matrix of ``dim`` rows that ``times`` multiplies by a block of columns.

    Raises if the residuals do not come down to rounding."""
    block = min(dim, wanted + guard)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, block)))
    best = np.inf
    for _ in range(MOST_FILTERS):
        w = times(q)
        h = q.T @ w
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        top = max(float(values[0]), 0.0)
        residual = float(np.linalg.norm(w[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max())
        if block == dim or top == 0.0 or residual <= CERTIFIED * top * np.sqrt(dim):
            return values[:wanted], q[:, :wanted]
        # Within rounding of that, more passes no longer help.
        if residual <= 100 * CERTIFIED * top * np.sqrt(dim) and residual > best / 2:
            return values[:wanted], q[:, :wanted]
        best = min(best, residual)
        low = float(values[-1])
        if low <= RANK * top:  # the block holds all there is; one multiplication clears the rest
            q, _ = np.linalg.qr(w)
            continue
        half = low / 2
        growth = (float(values[wanted - 1]) - half) / half
        missing = min(residual / (CERTIFIED * top), MOST_GROWTH)
        degree = _degree(growth, missing)
        # Scaled so that the largest value keeps its size.
        sigma = first = half / (top - half)
        before, now = q, (w - half * q) * (sigma / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first - sigma)
            before, now = now, (times(now) - half * now) * (2 * after / half) - before * (sigma * after)
            sigma = after
        q, _ = np.linalg.qr(now)
    raise RuntimeError(f"eigenvectors are not certified: residual {best}")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row for each valid row of ``vectors`` (vec_id,
    embedding) and each of the ``components`` leading principal components.

    An entry c counts as the whole number floor(256 * c). The distinct vectors, ``n`` of them with sums S, are fitted, each once.
    ``deviation`` is the exact sum over dimensions of (n * x - S)^2; ``whitened`` the centred vector projected on the
    component and divided by the root of its eigenvalue; ``explained`` the eigenvalue's share of the trace;
    ``identity_error`` the largest absolute entry of the fitted rows' whitened covariance less the identity.

    Rows whose vector is null or holds null or non-finite entries are left out; a null vec_id stays. Repeated rows are
    answered each, and fitted once. Shorter vectors count as ended by zeros. Whole numbers and deviations
    beyond a long stop at its ends. Components beyond the rank of the fitted vectors cannot be whitened and give no
    rows: none at all for a single distinct vector or an empty table. Of equal eigenvalues any basis may be returned, the same for
    all rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    given = given.where("v is not null")
    dim = given.agg(F.max(F.size("v"))).first()[0] or 0
    if not dim:
        return spark.createDataFrame([], schema)
    rows = kept(mapped(given, _quantised(dim), "vec_id long, x binary"), "whole-vectors")
    fit = kept(rows.select("x").distinct(), "fitted-vectors")
    centre = _centre(fit, dim)
    if not centre.n:
        return spark.createDataFrame([], schema)

    def squares(x: np.ndarray) -> np.ndarray:
        return (centre.of(x) ** 2).sum(axis=0)[:, None]

    trace = float(_summed(fit, dim, 1, squares).sum()) / centre.n

    def times(q: np.ndarray) -> np.ndarray:
        side = spark.sparkContext.broadcast(q)

        def product(x: np.ndarray) -> np.ndarray:
            y = centre.of(x)
            return y.T @ (y @ side.value)

        out = _summed(fit, dim, q.shape[1], product) / centre.n
        side.destroy()
        return out

    values, axes = eigenpairs(times, dim, min(components, dim)) if trace > 0 else (np.zeros(0), np.zeros((dim, 0)))
    there = values > RANK * max(values.max(initial=0), 0)
    values, axes = values[there], axes[:, there]
    if not len(values):
        return spark.createDataFrame([], schema)
    to_white = axes / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        y = centre.of(x) @ to_white
        return np.concatenate([y.T @ y, y.sum(axis=0)[:, None]], axis=1)

    found = _summed(fit, dim, len(values) + 1, moments) / centre.n
    mean = found[:, -1]
    error = float(np.abs(found[:, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, k = _rows(batch.column("x"), dim), len(values)
        return pa.record_batch(
            {
                "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                "n": np.full(len(x) * k, centre.n),
                "deviation": np.repeat(np.array(centre.deviations(x), np.int64), k),
                "whitened": (centre.of(x) @ to_white).ravel(),
                "explained": np.tile(values / trace, len(x)),
                "identity_error": np.full(len(x) * k, error),
            }
        )

    return mapped(rows, one, schema)
