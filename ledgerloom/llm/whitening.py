"""Whitened principal components of integer-scaled vectors by contour integration.

Each entry c becomes ``floor(64 * c) + 1000000``. The fit list is each distinct
integer vector once; equal vectors meet before the shuffle as short byte strings, so
a vector that fills a third of the table is one row. Counts and sums are exact, and the covariance is summed
from centred vectors, a partial matrix per task.

Components are the eigenvectors of the covariance with the largest eigenvalues. Inertia
counts (signs of the pivots of the shifted tridiagonal form) locate the wanted part of the
spectrum and cut it into intervals in gaps between eigenvalues. One Spark task per
interval integrates the resolvent along a circle around it: a quadrature of solves with
complex shifted covariances projects a block of vectors onto the interval's eigenspace,
Rayleigh-Ritz extracts the components, and both are repeated until the residuals are
at rounding error. An interval must give as many components as the inertia counts on its
ends say, or the subspace is enlarged.

Vectors that are null, empty, or hold null or non-finite entries are dropped. If lengths
differ, those of the most frequent length (the longer one of two) are used and others
dropped. Entries beyond 2^46 count as that. There are fewer components than asked for if the
covariance has a smaller rank (at most one less than there are distinct vectors); one
distinct vector or an empty table gives no rows. Rows that repeat an id or have none are
each returned. ``deviation`` is null where it exceeds a bigint. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
#: Largest magnitude of an entry's integer before the shift.
LARGEST = 1 << 52
#: Vectors turned into matrices at once.
ROWS = 4096
#: The covariance is solved as a whole matrix; vectors may not be longer.
MAX_DIMS = 4096
#: Quadrature nodes on the half circle, rounds of integration, components of an interval.
NODES, ROUNDS, INTERVAL = 8, 30, 8
#: Eigenvalues below this share of the trace count as zero.
NOTHING = 1e-12
SEED = 42

_WIDTHS = ("<i1", "<i2", "<i4", "<i8")


def packed(values: np.ndarray) -> list[bytes]:
    """Integer vectors as byte strings, the shortest that hold them, so that equal vectors have equal strings."""
    reach = np.where(values < 0, ~values, values).max(axis=1)
    width = np.searchsorted([1 << 7, 1 << 15, 1 << 31], reach, side="right")
    out: list[bytes] = [b""] * len(values)
    for kind in np.unique(width):
        rows = np.flatnonzero(width == kind)
        raw = values[rows].astype(_WIDTHS[kind])
        for i, row in zip(rows.tolist(), raw, strict=True):
            out[i] = bytes([kind]) + row.tobytes()
    return out


def unpacked(strings: list[bytes], dims: int) -> np.ndarray:
    out = np.empty((len(strings), dims), np.int64)
    kinds = np.array([x[0] for x in strings])
    for kind in np.unique(kinds):
        rows = np.flatnonzero(kinds == kind)
        raw = b"".join(strings[i][1:] for i in rows)
        out[rows] = np.frombuffer(raw, _WIDTHS[kind]).reshape(-1, dims)
    return out


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, vector`` to ``id, dims, x`` of usable vectors; x without the shift."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            lists = part.column(1)
            entries = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
            sizes = np.diff(lists.offsets.to_numpy())
            sizes[lists.is_null().to_numpy(zero_copy_only=False)] = 0
            begins = np.cumsum(sizes) - sizes
            for dims in np.unique(sizes[sizes > 0]).tolist():
                rows = np.flatnonzero(sizes == dims)
                values = entries[begins[rows][:, None] + np.arange(dims)]
                good = np.isfinite(values).all(axis=1)
                whole = np.clip(np.floor(np.clip(values[good], -1e300, 1e300) * SCALE), -LARGEST, LARGEST).astype(np.int64)
                if len(whole):
                    yield pa.record_batch(
                        [part.column(0).take(pa.array(rows[good])), pa.array([dims] * len(whole), pa.int32()),
                         pa.array(packed(whole), pa.binary())],
                        ["id", "dims", "x"],
                    )


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part, unpacked(part.column("x").to_pylist(), dims)


def _sums(dims: int) -> Callable:
    """Exact sums of a partition by dimension; dimension -1 counts the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for _, values in _matrices(batches, dims):
            n += len(values)
            high, low = (values >> 26).sum(axis=0), (values & ((1 << 26) - 1)).sum(axis=0)
            total = [t + (a << 26) + b for t, a, b in zip(total, high.tolist(), low.tolist(), strict=True)]
        yield pa.record_batch(
            [pa.array(range(-1, dims), pa.int32()), pa.array(map(Decimal, [n, *total]), pa.decimal128(38, 0))],
            ["dim", "total"],
        )

    return run


@dataclass(frozen=True)
class Fit:
    """Distinct vectors, their exact sums (without the shift) and, once known, the components."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None

    def centred(self, values: np.ndarray) -> np.ndarray:
        return values - np.array([s / self.n for s in self.sums])

    def whitened(self, values: np.ndarray) -> np.ndarray:
        return self.centred(values) @ self.vectors / np.sqrt(self.values)

    def deviations(self, values: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of (n * x - S) squared."""
        reach = max(self.n * (int(np.abs(values).max()) + 1), max(map(abs, self.sums)))
        if len(self.sums) * (2 * reach) ** 2 < 1 << 63:
            return ((self.n * values - np.array(self.sums)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * x - s) ** 2 for x, s in zip(row, self.sums, strict=True)) for row in values.tolist()]
        return [x if x < 1 << 63 else None for x in exact]


def _products(fit: Fit, of: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """Rows of the partial matrix ``y' y`` of a partition, y made from its vectors; row -1 is the sum of y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, values in _matrices(batches, len(fit.sums)):
            y = of(values)
            part = np.vstack((y.sum(axis=0), y.T @ y))
            total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch(
                [pa.array(range(-1, len(total) - 1), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                ["row", "part"],
            )

    return run


def _covariance(vectors: DataFrame, fit: Fit, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Of what ``of`` makes from the fit list; a row of the matrix is added up in one task from one row per task."""
    parts = vectors.mapInArrow(_products(fit, of), "row int, part array<double>")
    added = F.reduce(
        F.collect_list("part"), F.lit(None).cast("array<double>"),
        lambda total, x: F.when(total.isNull(), x).otherwise(F.zip_with(total, x, lambda a, b: a + b)),
    )
    rows = {r["row"]: r["total"] for r in parts.groupBy("row").agg(added.alias("total")).collect()}
    mean = np.array(rows.pop(-1)) / fit.n
    matrix = np.array([rows[i] for i in range(len(rows))]) / fit.n - np.outer(mean, mean)
    return (matrix + matrix.T) / 2


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a similar tridiagonal matrix, by reflections."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if np.linalg.norm(x[1:]) == 0:
            continue
        x[0] += length if x[0] >= 0 else -length
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        p -= (x @ p) * x
        rest -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1, k] = a[k, k + 1] = -length if a[k + 1, k] >= 0 else length
        a[k + 2 :, k] = a[k, k + 2 :] = 0
    return np.diag(a).copy(), np.diag(a, 1) ** 2


def above(form: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues exceed each shift: positive pivots of the shifted tridiagonal form."""
    diagonal, off = form
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = np.ones(len(shifts))
    count = np.zeros(len(shifts), np.int64)
    for d, e in zip(diagonal, np.concatenate(([0.0], off)), strict=True):
        with np.errstate(over="ignore"):  # an infinite pivot has the right sign
            pivot = d - shifts - e / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Low end, high end and number of eigenvalues of intervals that hold the ``wanted`` largest, ends in gaps."""
    form = tridiagonal(matrix)
    off = np.sqrt(form[1])
    reach = np.concatenate(([0.0], off)) + np.concatenate((off, [0.0]))
    top = float((form[0] + reach).max()) * (1 + 1e-8) + 1e-300
    bottom = float((form[0] - reach).min())
    bottom -= abs(bottom) * 1e-8 + top * 1e-8
    low, high = np.full(len(matrix), bottom), np.full(len(matrix), top)
    rank = np.arange(1, len(matrix) + 1)  # bisection for every eigenvalue at once
    for _ in range(80):
        middle = (low + high) / 2
        more = above(form, middle) >= rank
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    values = (low + high) / 2
    gaps = np.append(values[:-1] - values[1:], values[-1] - bottom)
    clear = gaps > top * 1e-9
    clear[-1] = True
    out, begin, end_high = [], 0, top
    for i in range(len(values)):
        last = i + 1 >= wanted
        if clear[i] and (last or i + 1 - begin >= INTERVAL // 2 and (gaps[i] >= gaps[begin : i + 1].max() or i + 1 - begin >= INTERVAL)):
            end_low = float(values[i] - gaps[i] / 2)
            out.append((end_low, end_high, i + 1 - begin))
            if last:
                break
            begin, end_high = i + 1, end_low
    return out


def contour_components(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high`` and their unit eigenvectors."""
    dims, scale = len(matrix), np.abs(matrix).max()
    node, weight = np.polynomial.legendre.leggauss(NODES)
    angle = np.exp(0.5j * np.pi * (1 - node))
    centre, radius = (low + high) / 2, (high - low) / 2
    shifted = [(centre + radius * a) * np.eye(dims) - matrix for a in angle]
    size = min(dims, count + max(4, count // 2))
    while True:
        block = np.random.default_rng([SEED, size]).standard_normal((dims, size))
        best = None
        for _ in range(ROUNDS):
            projected = sum(
                w / 2 * (radius * a * np.linalg.solve(s, block)).real for w, a, s in zip(weight, angle, shifted, strict=True)
            )
            basis, _ = np.linalg.qr(projected)
            values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ turn
            inside = np.flatnonzero((values > low) & (values <= high))
            if len(inside) != count:
                continue
            own = block[:, inside]
            wrong = np.abs(matrix @ own - own * values[inside]).max() / scale
            if best is None or wrong < best[0] / 2:
                best = wrong, values[inside], own
            else:  # no longer getting better
                break
        if best is not None and best[0] < 1e-11:
            return best[1], best[2]
        if size == dims:
            raise ArithmeticError(f"{count} eigenvalues between {low} and {high} were not found")
        size = min(dims, 2 * size)


def components(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, with unit eigenvectors as columns; an interval is a task."""
    cut = intervals(matrix, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                values, vectors = contour_components(matrix, *cut[i])
                yield pa.record_batch([pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], ["value", "vector"])

    found = spark.range(0, len(cut), 1, len(cut)).mapInArrow(run, "value double, vector array<double>").collect()
    found.sort(key=lambda r: -r["value"])
    values = np.array([r["value"] for r in found[:wanted]])
    vectors = np.array([r["vector"] for r in found[:wanted]]).T
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * sign


def _results(fit: Fit, explained: np.ndarray, error: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.values)
        for part, values in _matrices(batches, len(fit.sums)):
            n = len(values)
            rows = pa.array(np.repeat(np.arange(n), k))
            yield pa.record_batch(
                [
                    part.column("id").take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, fit.n)), pa.array(fit.deviations(values), pa.int64()).take(rows),
                    pa.array(fit.whitened(values).ravel()), pa.array(np.tile(explained, n)), pa.array(np.full(n * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


_RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whitened(
    vectors: DataFrame, wanted: int = 16, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each row and component."""
    spark = vectors.sparkSession
    element = vectors.schema[vector_col].dataType.elementType.typeName()
    vector = F.col(vector_col) if element in ("float", "double") else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector"))
    rows = stored(rows.filter("vector is not null").mapInArrow(_encoded, "id bigint, dims int, x binary"), "whitening-rows")
    usual = rows.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if usual is None:
        return spark.createDataFrame([], _RESULT)
    dims = usual["dims"]
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries, at most {MAX_DIMS} can be whitened")
    rows = rows.filter(F.col("dims") == dims).select("id", "x")
    distinct = stored(rows.select("x").distinct(), "whitening-fit")
    totals = distinct.mapInArrow(_sums(dims), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    sums = {r["dim"]: int(r["total"]) for r in totals.collect()}  # one row per dimension
    fit = Fit(sums.pop(-1), tuple(sums[i] for i in range(dims)))
    matrix = _covariance(distinct, fit, fit.centred)
    trace = float(np.trace(matrix))
    if fit.n < 2 or not trace > 0:
        return spark.createDataFrame([], _RESULT)
    values, found = components(spark, matrix, min(wanted, dims, fit.n - 1))
    real = values > NOTHING * trace
    fit = Fit(fit.n, fit.sums, values[real], found[:, real])
    error = float(np.abs(_covariance(distinct, fit, fit.whitened) - np.eye(real.sum())).max())
    return rows.mapInArrow(_results(fit, fit.values / trace, error), _RESULT)
