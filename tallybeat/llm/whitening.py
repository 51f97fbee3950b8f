"""Whitening of vectors over their distinct grid points.

Vectors are put on a grid of whole numbers (``x``). Equal grid points are grouped; a group
weighs one, or as many as it has rows, in the fit. Sums are exact whole numbers, the
covariance is a weighted matrix product of centred blocks, and every distinct point is
whitened once, whatever the number of its rows, which meet their point again by a join.

What reaches the driver is a matrix per vector length, never rows: tasks hand on partial
sums, which Spark adds up entry by entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeat.sources.tables import staged

#: Cells per unit, and what is added to a cell's number.
GRID, OFFSET = 64.0, 1_000_000
#: Grid numbers stop here, so that differences of two stay below 2**63.
FAR = 2.0**61
#: Components with less of the total variance than this are rounding, and have no whitened value.
LEAST_SHARE = 1e-12


@dataclass(frozen=True)
class Fit:
    """Centre and components of the points of one length; ``sums`` are exact."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, by column
    total: float  # trace of the covariance

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n: the whole part is taken off in whole numbers, so nothing cancels."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole) - rest

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - sums)**2, exact."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = [s % self.n for s in self.sums]
        y, width = x - whole, max(1, x.shape[1])
        most = max(int(y.max(initial=0)), -int(y.min(initial=0)), 1)
        if width * most * max(most, self.n) >= 1 << 62:  # else no sum below leaves 64 bits
            y, rest = y.astype(object), np.array(rest, dtype=object)
        squares, cross = (y * y).sum(axis=1), (y * np.array(rest, dtype=y.dtype)).sum(axis=1)
        own = sum(int(r) ** 2 for r in rest)
        return [self.n**2 * int(a) - 2 * self.n * int(b) + own for a, b in zip(squares, cross)]

    def whitened(self, x: np.ndarray, components: int) -> np.ndarray:
        values = self.values[:components]
        scale = np.where(values > LEAST_SHARE * self.total, values, np.nan)
        return self.centred(x) @ (self.vectors[:, :components] / np.sqrt(scale))


def grid_points(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """All rows with a whole, finite vector, with ``x``, its grid point."""
    numbers = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(numbers, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    cell = F.transform(
        numbers, lambda c: F.floor(F.greatest(F.least(c * GRID, F.lit(FAR)), F.lit(-FAR))) + F.lit(OFFSET)
    )
    return rows.filter(F.col(vector).isNotNull() & ~bad).withColumn("x", cell)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per batch and length: the places of the rows, their points and weights."""
    for batch in batches:
        points = batch.column("x")
        weights = batch.column("weight").to_numpy()
        lengths = points.value_lengths().to_numpy()
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            x = points.take(pa.array(at)).flatten().to_numpy().reshape(len(at), int(length))
            yield at, x, weights[at]


def _entries(parts: dict[int, list[list]], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Partial results as rows (dims, at, values), one per line of each length's matrix."""
    for dims, lines in parts.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([dims] * len(lines), pa.int32()),
                pa.array(range(len(lines)), pa.int32()),
                pa.array(lines, pa.list_(kind)),
            ],
            ["dims", "at", "values"],
        )


def _added(rows: DataFrame, task, kind: str) -> dict[int, list[list]]:
    """The matrices of all tasks added up, by length; sums are made entry by entry."""
    parts = rows.mapInArrow(task, f"dims int, at int, values array<{kind}>")
    lines = (
        parts.select("dims", "at", F.posexplode("values").alias("place", "value"))
        .groupBy("dims", "at", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("dims", "at")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("line"))
    )
    found: dict[int, list[list]] = {}
    for row in sorted(lines.collect()):
        found.setdefault(row.dims, []).append([cell.value for cell in row.line])
    return found


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights and exact sums of a task: halves of 32 bits, so that sums of int64 hold them."""
    parts: dict[int, list[int]] = {}
    for _, x, weight in _blocks(batches):
        own = parts.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
        own[0] += int(weight.sum())
        for step in range(0, len(x), 1 << 16):
            block, by = x[step : step + (1 << 16)], weight[step : step + (1 << 16), None]
            if int(by.max()) >> 15:  # rare: weights so large that their products leave 64 bits
                block, by = block.astype(object), by.astype(object)
            high, low = ((block >> 32) * by).sum(axis=0), ((block & 0xFFFFFFFF) * by).sum(axis=0)
            for i, (a, b) in enumerate(zip(high, low), 1):
                own[i] += (int(a) << 32) + int(b)
    yield from _entries({d: [[Decimal(v) for v in own]] for d, own in parts.items()}, pa.decimal128(38, 0))


def fit(points: DataFrame) -> dict[int, Fit]:
    """The fit of each vector length over ``x`` and ``weight``; none for an empty table."""
    sums = _added(points, _sums, "decimal(38,0)")
    centres = {d: (int(lines[0][0]), [int(v) for v in lines[0][1:]]) for d, lines in sums.items()}
    rough = {d: Fit(n, tuple(s), np.empty(0), np.empty((d, 0)), 0.0) for d, (n, s) in centres.items()}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for _, x, weight in _blocks(batches):
            d = x.shape[1]
            y = rough[d].centred(x)
            parts[d] = parts.get(d, np.zeros((d, d))) + (y * weight[:, None]).T @ y
        yield from _entries({d: m.tolist() for d, m in parts.items() if d}, pa.float64())

    fits = {d: one for d, one in rough.items() if not d}
    for d, lines in _added(points, products, "double").items():
        n, own = centres[d]
        matrix = np.array(lines) / n
        values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
        values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
        lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(d)]
        fits[d] = Fit(n, tuple(own), values, vectors * np.where(lead < 0, -1.0, 1.0), float(np.trace(matrix)))
    return fits


def identity_errors(whitened: DataFrame, fits: dict[int, Fit], components: int) -> dict[int, float | None]:
    """Largest entry by which the covariance of the whitened points misses the identity.

    Each task centres on its own mean; moving its product to the common mean (zero, by
    the fit) adds its rows times the product of its mean with itself.
    """
    live = {d: int((f.values[:components] > LEAST_SHARE * f.total).sum()) for d, f in fits.items()}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = batch.column("x").value_lengths().to_numpy()
            for d in np.unique(lengths):
                k = live[int(d)]
                if not k:
                    continue
                at = np.flatnonzero(lengths == d)
                rows = batch.column("whitened").take(pa.array(at))
                w = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)[:, :k]
                weight = batch.column("weight").to_numpy()[at].astype(float)
                mean = weight @ w / weight.sum()
                own = ((w - mean) * weight[:, None]).T @ (w - mean)
                block = np.vstack([own + weight.sum() * np.outer(mean, mean), weight @ w])
                parts[int(d)] = parts.get(int(d), 0) + block
        yield from _entries({d: m.tolist() for d, m in parts.items()}, pa.float64())

    errors: dict[int, float | None] = {d: None for d in fits}
    for d, lines in _added(whitened, products, "double").items():
        block = np.array(lines) / fits[d].n
        covariance = block[:-1] - np.outer(block[-1], block[-1])
        errors[d] = float(np.abs(covariance - np.eye(live[d])).max())
    return errors


def whiten(rows: DataFrame, components: int = 16, by_count: bool = False, vector: str = "embedding") -> DataFrame:
    """vec_id, n, deviation, whitened, explained, identity_error: one row per whole vector.

    Needs vec_id and the vector (an array of numbers); other columns are not read. Rows
    whose vector is null or holds a null or non-finite entry are left out; ids may be null
    or repeat, and rows with equal points get equal results; an empty table gives an empty
    result. Vectors of each length are fitted among themselves. ``whitened`` and
    ``explained`` are arrays by component, as many as ``components`` or the length, if that
    is less. A component without variance has no whitened value (null) and no part in
    ``identity_error``, which is null if none has variance. ``by_count`` weighs a point by
    its rows; else each distinct point weighs one. ``deviation`` is exact, and null
    beyond 38 digits.
    """
    points = grid_points(rows.select("vec_id", F.col(vector).alias("_vector")), "_vector").select("vec_id", "x")
    weight = F.count(F.lit(1)) if by_count else F.lit(1).cast("bigint")
    distinct = staged(points.groupBy("x").agg(weight.alias("weight")), "whitening-points")
    fits = fit(distinct)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whitened: list = [None] * batch.num_rows
            deviation: list = [None] * batch.num_rows
            for at, x, _ in _blocks(iter([batch])):
                own = fits[x.shape[1]]
                values = own.whitened(x, components)
                for i, w, v in zip(at, values, own.deviation(x)):
                    whitened[i] = [None if np.isnan(c) else c for c in w.tolist()]
                    deviation[i] = Decimal(v) if v < 10**38 else None
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("x"),
                    batch.column("weight"),
                    pa.array(deviation, pa.decimal128(38, 0)),
                    pa.array(whitened, pa.list_(pa.float64())),
                ],
                ["x", "weight", "deviation", "whitened"],
            )

    white = staged(
        distinct.mapInArrow(each, "x array<bigint>, weight bigint, deviation decimal(38,0), whitened array<double>"),
        "whitening-whitened",
    )
    errors = identity_errors(white, fits, components)
    known = rows.sparkSession.createDataFrame(
        [
            (d, f.n, [float(v / f.total) if f.total else 0.0 for v in f.values[:components]], errors[d])
            for d, f in fits.items()
        ],
        "dims int, n bigint, explained array<double>, identity_error double",
    )
    # One row per vector length, so its size does not grow with the rows.
    described = white.withColumn("dims", F.size("x")).join(F.broadcast(known), "dims")
    return points.join(described, "x").select("vec_id", "n", "deviation", "whitened", "explained", "identity_error")


def by_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1; deviation as a long, null beyond it."""
    pairs = F.arrays_zip("whitened", "explained")
    long = whitened.select(
        "vec_id",
        "n",
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "identity_error",
        F.posexplode(pairs).alias("at", "pair"),
    )
    return long.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("pair.whitened").alias("whitened"),
        F.col("pair.explained").alias("explained"),
        "identity_error",
    )
