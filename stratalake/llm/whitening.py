"""Whitening of integer vectors: exact covariance, eigenvectors by mixed-precision refinement.

Spark adds up the distinct vectors' sums and then their products about an integer
centre, both as whole numbers, so the covariance carries no rounding. Its eigenvectors are
first computed in float32 and then corrected by Ogita-Aishima iterations, which consist of
matrix products in extended precision and double the right digits each time. Eigenvalues
closer together than the present error are handled as a cluster: its vectors are only made
orthogonal by the correction, and a small eigenproblem of the covariance shifted by the
cluster's centre and restricted to it turns them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.tables import written

#: Steps of quantisation per unit.
STEPS = 256
#: Entries below this size fit a long with room for differences.
LARGEST = 2.0 ** 53
#: Products of vectors are added up in so many rows at a time, split into limbs of so many bits: float64 holds the sums exactly.
ROWS, LIMB = 4096, 20
#: After so many of these sums a task hands on what it has, before a long could overflow.
HANDED_ON = 512
#: Eigenvalues below this share of the largest one count as zero.
SMALLEST = 1e-14

_LOW = np.int64((1 << 32) - 1)
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# -- eigenvectors -------------------------------------------------------------

def _clusters(values: np.ndarray, delta: float) -> list[np.ndarray]:
    """Groups of two and more values of which each is within ``delta`` of the next."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > delta) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def refined_eigenvectors(a: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of a symmetric matrix in extended precision."""
    wide = np.longdouble
    size = len(a)
    scale = np.abs(a).max() if size else wide(0)
    if not scale > 0:
        return np.zeros(size, wide), np.eye(size, dtype=wide)
    a = a.astype(wide) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(wide)
    one, norm = np.eye(size, dtype=wide), np.sqrt((a * a).sum())
    worst = np.inf
    for step in range(steps):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        delta = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        clusters = _clusters(values, delta)
        apart = values[None, :] - values[:, None]
        label = np.arange(size)
        for members in clusters:
            label[members] = members.min()
        together = label[:, None] == label[None, :]
        e = np.where(together, r / 2, (s + values[None, :] * r) / np.where(together, 1, apart))
        x = x + x @ e
        for members in clusters:
            own = x[:, members]
            t = own.T @ (a @ own - values[members].mean() * own)
            t = (t + t.T) / 2
            top = np.abs(t).max()
            if top > 0:  # turned within their span, to the digits that float64 has of the cluster's width
                turned, _ = np.linalg.qr(np.linalg.eigh((t / top).astype(np.float64))[1])
                x[:, members] = own @ turned.astype(wide)
        size_of_step = np.abs(e).max()
        if size_of_step < 16 * np.finfo(wide).eps or (step > 4 and size_of_step > worst / 2):
            break
        worst = size_of_step
    for _ in range(2):  # turns between nearly equal eigenvalues leave an error of second order
        x = x + x @ (one - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    largest = x[np.abs(x).argmax(axis=0), np.arange(size)]
    return values[order] * scale, x * np.where(largest < 0, -1, 1)


# -- exact sums ---------------------------------------------------------------

def _by_width(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and matrix of the vectors of each length, at most ``ROWS`` at a time."""
    for at in range(0, len(column), ROWS):
        part = column.slice(at, ROWS)
        lengths = np.diff(part.offsets.to_numpy())
        values = part.flatten().to_numpy(zero_copy_only=False)
        for width in np.unique(lengths[lengths > 0]).tolist():
            has = lengths == width
            yield width, at + np.flatnonzero(has), values[np.repeat(has, lengths)].reshape(-1, width)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed limbs of ``LIMB`` bits, lowest first, as float64."""
    out = []
    while True:
        low = ((y + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))
        out.append(low.astype(np.float64))
        y = (y - low) >> LIMB
        if not y.any():
            return out


_SUMS = "width int, power int, line int, high array<long>, low array<long>"


def _lines(width: int, power: int, matrix: np.ndarray) -> pa.RecordBatch:
    lists = lambda m: pa.ListArray.from_arrays(
        pa.array(np.arange(0, m.size + 1, width, dtype=np.int32)), pa.array(m.ravel()))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(matrix), width, np.int32)), pa.array(np.full(len(matrix), power, np.int32)),
         pa.array(np.arange(len(matrix), dtype=np.int32)), lists(matrix >> 32), lists(matrix & _LOW)],
        names=["width", "power", "line", "high", "low"])


def _added_up(partial: DataFrame) -> dict[int, np.ndarray]:
    """Per length the whole numbers that the tasks' lines add up to.

    A group has one line of each task. Only the sums, a matrix per length, reach the driver.
    """
    def add(lines: pd.DataFrame) -> pd.DataFrame:
        high, low = np.sum(np.stack(lines["high"]), axis=0), np.sum(np.stack(lines["low"]), axis=0)
        return pd.DataFrame({**{c: [int(lines[c].iloc[0])] for c in ("width", "power", "line")},
                             "high": [high + (low >> 32)], "low": [low & _LOW]})

    totals: dict[int, np.ndarray] = {}
    for r in partial.groupBy("width", "power", "line").applyInPandas(add, _SUMS).toLocalIterator():
        width = r["width"]
        matrix = totals.setdefault(width, np.zeros((width, width), object))
        matrix[r["line"]] += np.array([((h << 32) + low) << r["power"] for h, low in zip(r["high"], r["low"], strict=True)], object)
    return totals


def _sums(fit: DataFrame) -> dict[int, np.ndarray]:
    """Per length the exact sum of its vectors."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for width, _, x in _by_width(batch.column("x")):
                own = held.setdefault(width, [np.zeros(width, np.int64), np.zeros(width, np.int64)])
                own[0] += (x >> 32).sum(axis=0)
                own[1] += (x & _LOW).sum(axis=0)
        for width, (high, low) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([width], pa.int32()), pa.array([0], pa.int32()), pa.array([0], pa.int32()),
                 pa.array([high + (low >> 32)], pa.list_(pa.int64())), pa.array([low & _LOW], pa.list_(pa.int64()))],
                names=["width", "power", "line", "high", "low"])

    return {width: m[0] for width, m in _added_up(fit.mapInArrow(partial, _SUMS)).items()}


def _products(fit: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per length the exact sum of the products of its vectors' entries, less the centre."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[int, np.ndarray]] = {}
        added: dict[int, int] = {}
        for batch in batches:
            for width, _, x in _by_width(batch.column("x")):
                limbs, own = _limbs(x - centres[width]), held.setdefault(width, {})
                for i, one in enumerate(limbs):
                    for j, other in enumerate(limbs):
                        power = LIMB * (i + j)
                        own[power] = own.get(power, 0) + (one.T @ other).astype(np.int64)
                added[width] = added.get(width, 0) + 1
                if added[width] >= HANDED_ON:
                    yield from (_lines(width, p, m) for p, m in held.pop(width).items())
                    added[width] = 0
        for width, own in held.items():
            yield from (_lines(width, p, m) for p, m in own.items())

    return _added_up(fit.mapInArrow(partial, _SUMS))


# -- whitening ----------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """Of the vectors of one length: number, integer centre, n * (mean - centre), components (by column), eigenvalues, shares."""

    n: int
    centre: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        from_mean = (x - self.centre).astype(np.float64) - self.rest / self.n
        return from_mean @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - S)², None where a long is too short."""
        y = x - self.centre
        if len(y) and float(np.abs(y).max()) * self.n + self.n < np.sqrt(2.0 ** 62 / y.shape[1]):
            z = self.n * y - self.rest
            return (z * z).sum(axis=1).tolist()
        sums = ((self.n * y.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1).tolist()
        return [s if s < 1 << 63 else None for s in sums]


def fitted(n: int, total: np.ndarray, centre: np.ndarray, products: np.ndarray, most: int) -> Whitening:
    """The first ``most`` components from exact sums."""
    rest = total - n * centre.astype(object)
    exact = n * products - rest[:, None] * rest[None, :]
    wide = np.longdouble
    covariance = np.array([[wide(v) for v in row] for row in exact.tolist()], wide) / (wide(n) * wide(n))
    values, vectors = refined_eigenvectors(covariance)
    count = int((values[:most] > SMALLEST * values[0]).sum()) if values[0] > 0 else 0
    trace = np.trace(covariance)
    return Whitening(n, centre, rest.astype(np.int64), vectors[:, :count].astype(np.float64), values[:count].astype(np.float64),
                     (values[:count] / trace).astype(np.float64) if count else np.zeros(0))


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: rows without NULL or non-finite entries, each entry c as floor(256 * c)."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    usable = F.forall("embedding", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))  # NaN is larger than any number
    return rows.where(F.col("embedding").isNotNull() & usable).select(
        "vec_id", F.transform("embedding", lambda c: F.floor(c * STEPS)).alias("x"))


def whiten(vectors: DataFrame, most: int = 4) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row of ``vectors (vec_id, embedding)`` and component.

    Rows whose vector is NULL or holds NULL or non-finite entries, or such of 2^53 and more,
    are left out. Entries become whole numbers x of 1/256. Mean, covariance (divisor n) and
    its eigenvectors, numbered by falling eigenvalue, are those of the n distinct vectors; S is
    their sum. ``deviation`` is the exact sum of (n * x - S)², NULL if it does not fit a long;
    ``whitened`` the projection of x - S / n on a unit eigenvector over the root of its
    eigenvalue; ``explained`` the eigenvalue's share; ``identity_error`` the largest entry of
    the whitened distinct vectors' covariance less the identity.

    There are up to ``most`` components, fewer if the vectors are shorter or vary in fewer
    directions (none for a single distinct vector or empty ones, which hence give no rows). Repeated vectors and
    repeated or NULL vec_ids each get their rows. Vectors of another length are a table of their own.
    No rows give no rows. Other columns are not looked at. One square matrix
    per length is collected.
    """
    rows = integer_vectors(vectors)
    fit = written(rows.where(F.size("x") > 0).select("x").distinct(), "distinct_vectors")
    counts = {r["width"]: r["n"] for r in fit.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).collect()}
    totals = _sums(fit)
    centres = {w: np.array([(2 * s + counts[w]) // (2 * counts[w]) for s in total], np.int64) for w, total in totals.items()}
    products = _products(fit, centres)
    models = {w: fitted(counts[w], totals[w], centres[w], products[w], most) for w in counts}
    models = {w: m for w, m in models.items() if len(m.values)}

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in _by_width(batch.column("x")):
                if width in models:
                    z = models[width].whitened(x)
                    z = np.column_stack([np.ones(len(z)), z])
                    held[width] = held.get(width, 0) + z.T @ z
        for width, m in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m.size, width, np.int32)), pa.array(np.arange(m.size, dtype=np.int32)), pa.array(m.ravel())],
                names=["width", "place", "value"])

    sums: dict[int, dict[int, float]] = {}
    for r in fit.mapInArrow(moments, "width int, place int, value double").groupBy("width", "place").agg(
            F.sum("value").alias("value")).collect():
        sums.setdefault(r["width"], {})[r["place"]] = r["value"]
    errors = {}
    for width, own in sums.items():
        size = len(models[width].values) + 1
        m = np.array([own[i] for i in range(size * size)]).reshape(size, size) / models[width].n
        errors[width] = float(np.abs(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(size - 1)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, at, x in _by_width(batch.column("x")):
                if width not in models:
                    continue
                m = models[width]
                k = len(m.values)
                deviations = pa.array(m.deviations(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(k * len(x), m.n, np.int64)), deviations.take(pa.array(np.repeat(np.arange(len(x)), k))),
                     pa.array(m.whitened(x).ravel()), pa.array(np.tile(m.explained, len(x))), pa.array(np.full(k * len(x), errors[width]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, OUT)
