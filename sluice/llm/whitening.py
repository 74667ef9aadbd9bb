"""Whitening of embeddings: principal components by FEAST contour integration.

``fit_whitening`` learns the components, ``apply_whitening`` projects rows on them.

1. **Integer vectors.** A valid vector's entries become ``floor(256 * c)``. Each distinct vector is
   one row of the fit list: packed to two bytes an entry (eight if one does not fit), equal rows are combined
   before they are shuffled, so a very common vector is one row a task.
2. **Covariance.** One pass over the fit list gives its size and sums, the next the products
   of entries less the rounded means: small integers, so their sums are exact in doubles up to
   2^53 and do not depend on partitions. Only dim^2 numbers leave a task.
3. **Where.** The number of eigenvalues over a shift is the number of positive pivots of
   the shifted covariance (Sylvester's law of inertia). Bisection by that count finds intervals that
   hold the wanted eigenvalues.
4. **Contour.** A circle around each interval is cut into Gauss-Legendre nodes. Each Spark
   task solves one node's complex shifted system; their weighted sum projects a random
   block onto the interval's eigenvectors. Rayleigh-Ritz extracts pairs; the result is the next
   block until residuals are at rounding error.
5. **Check.** An interval must give as many pairs as inertia counts in it, else its block
   grows. Last, the covariance of the whitened fit list is measured in a pass of its own.

Defined results: vectors that are null or empty, or hold null or non-finite entries, are left out; so
are vectors of another length than the most common one (of equally common ones, the longest).
Repeated ids and rows are kept; a null id stays null. A fit list with fewer directions
of variance than asked (one vector, for instance, has none) gives fewer components; without
any there are no rows, as for an empty table. Components of equal eigenvalues are any
orthonormal ones of their space. ``deviation`` is exact, or null where it passes 2^63. Entries beyond 2^53 /
256 keep a double's precision only. Further columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import drop_saved, save

SCALE = 256
#: Quadrature nodes on the upper half of a circle (the lower half is its mirror image).
NODES = 8
#: Eigenvalues of one interval, unless they lie closer together than intervals are cut.
PER_INTERVAL = 16
MAX_ROUNDS = 60
#: A component's eigenvalue is over this share of the covariance's trace, else it is rounding.
LEAST_SHARE = 1e-12
_LIMIT = 1 << 62


# ------------------------------------------------------------------ rows
def _vectors(column: pa.Array, dim: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, integer vectors) of the valid rows of a list column, one pair per length."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    for d in np.unique(lengths[lengths > 0]) if dim is None else [dim]:
        rows = np.flatnonzero(lengths == d)
        if not len(rows):
            continue
        values = column.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), d)
        valid = np.isfinite(values).all(axis=1)  # a null entry is NaN here
        scaled = np.floor(SCALE * values[valid].clip(-1e300, 1e300))
        yield rows[valid], scaled.clip(-_LIMIT, _LIMIT).astype(np.int64)


def fit_list(vectors: DataFrame, embedding: str) -> DataFrame:
    """Each distinct integer vector: ``dim``, ``x`` (packed) and ``copies``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _vectors(batch.column(0)):
                narrow = (np.abs(x) < 1 << 15).all(axis=1)
                packed = [r.tobytes() for r in x[narrow].astype("<i2")] + [r.tobytes() for r in x[~narrow].astype("<i8")]
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]] * len(x), pa.int32()), pa.array(packed, pa.binary())], ["dim", "x"])

    return vectors.select(embedding).mapInArrow(run, "dim int, x binary").groupBy("dim", "x").agg(F.count(F.lit(1)).alias("copies"))


def _unpacked(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        values = batch.column(0).to_pylist()
        for width, kind in ((2 * dim, "<i2"), (8 * dim, "<i8")):
            some = [v for v in values if len(v) == width]
            for low in range(0, len(some), 4096):
                yield np.frombuffer(b"".join(some[low: low + 4096]), kind).reshape(-1, dim).astype(np.int64)


def sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the exact sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for x in _unpacked(batches, dim):
            n += len(x)
            part = x.sum(axis=0) if np.abs(x).max() < 1 << 50 else x.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, part)]
        yield pa.RecordBatch.from_arrays([pa.array([*range(dim), dim], pa.int32()), pa.array([Decimal(v) for v in [*total, n]], pa.decimal128(38, 0))], ["i", "s"])

    found = dict(fit.select("x").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s")).collect())
    return int(found.get(dim, 0)), [int(found.get(i, 0)) for i in range(dim)]


def _products(fit: DataFrame, dim: int, width: int, project) -> np.ndarray:
    """The sum over the fit list of ``y y'`` and of ``y`` (last row), ``y = project(x)`` of ``width`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for x in _unpacked(batches, dim):
            y = project(x)
            total[:width] += y.T @ y
            total[width] += y.sum(axis=0)
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array((at // width).astype(np.int32)), pa.array((at % width).astype(np.int32)), pa.array(total.ravel())], ["i", "j", "s"])

    out = np.zeros((width + 1, width))
    for i, j, s in fit.select("x").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
        out[i, j] = s
    return out


def covariance(fit: DataFrame, dim: int, n: int, total: list[int]) -> np.ndarray:
    """Covariance of the fit list, divisor ``n``, from entries less their rounded means."""
    middle = np.array([(2 * s + n) // (2 * n) for s in total], dtype=np.int64)
    off = np.array([(s - n * int(c)) / n for s, c in zip(total, middle)])
    products = _products(fit, dim, dim, lambda x: (x - middle).astype(np.float64))
    v = products[:dim] / n - np.outer(off, off)
    return (v + v.T) / 2


# ------------------------------------------------------------------ eigenpairs
def count_above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of symmetric ``a`` over ``shift``: positive pivots of ``a - shift`` (Bunch-Kaufman)."""
    m = a - shift * np.eye(len(a))
    found, alpha = 0, (1 + 17 ** 0.5) / 8
    while len(m) > 1:
        below = np.abs(m[1:, 0])
        r = int(below.argmax()) + 1
        most = below[r - 1]
        size = 1
        if abs(m[0, 0]) < alpha * most:
            other = np.abs(m[r])
            other[r] = 0
            if abs(m[0, 0]) * other.max() < alpha * most * most:
                size = 1 if abs(m[r, r]) >= alpha * other.max() else 2
                swap = np.arange(len(m))
                swap[[size - 1, r]] = r, size - 1
                m = m[np.ix_(swap, swap)]
        if size == 2:  # an indefinite pair: one positive, one negative
            found += 1
            m = m[2:, 2:] - m[2:, :2] @ np.linalg.solve(m[:2, :2], m[:2, 2:])
        else:
            found += m[0, 0] > 0
            m = m[1:, 1:] - (np.outer(m[1:, 0], m[0, 1:]) / m[0, 0] if m[0, 0] else 0)
    return int(found + (len(m) == 1 and m[0, 0] > 0))


def intervals(a: np.ndarray, wanted: int, per_interval: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of intervals that together hold at least the ``wanted`` largest eigenvalues."""
    bound = float(np.abs(a).sum(axis=1).max())  # Gershgorin
    step = 1e-7 * bound

    counted = {-bound - step: len(a), bound + step: 0}  # every count narrows the later searches

    def place(n: int) -> float:
        """Where the ``n``-th largest eigenvalue lies, from above, by bisection."""
        low = max(s for s, c in counted.items() if c >= n)
        high = min(s for s, c in counted.items() if c < n)
        while high - low > step:
            middle = (low + high) / 2
            counted[middle] = count_above(a, middle)
            low, high = (middle, high) if counted[middle] >= n else (low, middle)
        return high

    # The lowest edge goes into the widest gap close below the wanted ones: near an eigenvalue a contour separates badly.
    near = [place(n) for n in range(wanted, min(len(a), wanted + 8) + 1)]
    near.append(near[-1] - bound if wanted + 8 >= len(a) else near[-1])
    gaps = [x - y for x, y in zip(near, near[1:])]
    widest = gaps.index(max(gaps))
    low = near[widest] - max(gaps[widest] / 2, 2 * step)
    top = place(1) + 0.05 * (near[0] - low) + 2 * step
    todo, done = [(low, top, count_above(a, low), 0)], []
    while todo:
        low, high, over_low, over_high = todo.pop()
        if over_low - over_high <= per_interval or high - low <= 4 * step:
            if over_low > over_high:
                done.append((low, high, over_low - over_high))
            continue
        middle = (low + high) / 2
        n = count_above(a, middle)
        todo += [(low, middle, over_low, n), (middle, high, n, over_high)]
    return done


def _filtered(spark: SparkSession, a: np.ndarray, circles: list[tuple[float, float]], blocks: list[np.ndarray]) -> list[np.ndarray]:
    """Each block projected onto the eigenvectors in its circle; one task solves one node."""
    dim = len(a)
    x, w = np.polynomial.legendre.leggauss(NODES)
    shared = spark.sparkContext.broadcast((a, circles, blocks))

    def run(batches):
        a, circles, blocks = shared.value
        for batch in batches:
            for task in batch.column(0).to_pylist():
                c, (centre, radius) = task // NODES, circles[task // NODES]
                turn = radius * np.exp(-0.5j * np.pi * (x[task % NODES] - 1))
                solved = np.linalg.solve((centre + turn) * np.eye(dim) - a, blocks[c].astype(complex))
                part = 0.5 * w[task % NODES] * (turn * solved).real
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["c", "part"])

    out = [np.zeros_like(b) for b in blocks]
    tasks = len(circles) * NODES
    parts = spark.range(0, tasks, 1, min(tasks, 64)).mapInArrow(run, "c int, part binary")
    for c, part in sorted((r.c, bytes(r.part)) for r in parts.collect()):  # NODES blocks of dim x (a few) a circle
        out[c] += np.frombuffer(part).reshape(out[c].shape)
    return out


def leading_pairs(spark: SparkSession, a: np.ndarray, wanted: int, per_interval: int = PER_INTERVAL) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of symmetric ``a``, falling, and their unit eigenvectors (columns)."""
    dim, found, rng = len(a), [], np.random.default_rng(0)
    scale = float(np.abs(a).sum(axis=1).max())
    todo = intervals(a, wanted, per_interval)
    blocks = [rng.standard_normal((dim, min(dim, n + max(4, n // 2)))) for _, _, n in todo]
    for rounds in range(1, MAX_ROUNDS + 1):
        blocks = _filtered(spark, a, [((low + high) / 2, (high - low) / 2) for low, high, _ in todo], blocks)
        left = []
        for (low, high, n), block in zip(todo, blocks):
            basis, size, _ = np.linalg.svd(block, full_matrices=False)
            basis = basis[:, size > 1e-14 * size[0]]
            values, turn = np.linalg.eigh(basis.T @ a @ basis)
            vectors = basis @ turn
            off = np.linalg.norm(a @ vectors - vectors * values, axis=0)
            inside = (values > low) & (values <= high) & (off <= 1e-12 * scale)
            if inside.sum() == n:
                found.append(vectors[:, inside])
            else:
                # Every fifth round, or where the block can't hold what inertia counts, it grows by half.
                grown = min(dim, max(n + 4, vectors.shape[1] * 3 // 2)) if rounds % 5 == 0 or vectors.shape[1] <= n else vectors.shape[1]
                left.append(((low, high, n), np.hstack([vectors, rng.standard_normal((dim, max(0, grown - vectors.shape[1])))])))
        todo, blocks = [x for x, _ in left], [y for _, y in left]
        if not todo:
            break
    else:
        raise RuntimeError(f"intervals without their inertia count of eigenpairs: {todo}")
    basis, _ = np.linalg.qr(np.hstack(found))  # one more Rayleigh-Ritz across all intervals
    values, turn = np.linalg.eigh(basis.T @ a @ basis)
    order = np.argsort(-values)[:wanted]
    return values[order], (basis @ turn)[:, order]


# ------------------------------------------------------------------ operator
@dataclass(frozen=True)
class Whitening:
    """What ``fit_whitening`` learnt: ``dim``, the fit list's rows ``n`` and exact ``sums``, ``values`` and unit
    ``vectors`` (columns) of the components, the covariance's ``trace``, and the largest entry of the whitened
    fit list's covariance minus the identity."""

    dim: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def fit_whitening(vectors: DataFrame, embedding: str = "embedding", components: int = 4) -> Whitening | None:
    """Fit on every valid row of ``vectors``; None where there is no component."""
    spark = vectors.sparkSession
    saved = save(fit_list(vectors, embedding), "whitening-fit")
    lengths = saved.groupBy("dim").agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("dim")).first()
    model = None
    if lengths is not None:
        dim = lengths.dim
        fit = saved.filter(F.col("dim") == dim)
        n, total = sums(fit, dim)
        v = covariance(fit, dim, n, total)
        trace = float(np.trace(v))
        wanted = min(components, count_above(v, LEAST_SHARE * trace)) if trace > 0 else 0
        if wanted:
            values, basis = leading_pairs(spark, v, wanted)
            mean, turn = np.array([s / n for s in total]), basis / np.sqrt(values)
            z = _products(fit, dim, wanted, lambda x: (x - mean) @ turn) / n
            error = float(np.abs(z[:wanted] - np.outer(z[wanted], z[wanted]) - np.eye(wanted)).max())
            model = Whitening(dim, n, tuple(total), values, basis, trace, error)
    drop_saved(saved)
    return model


def _deviations(x: np.ndarray, n: int, total: tuple[int, ...]) -> list[int | None]:
    """The sum of ``(n x - S)^2`` of each row, in 64 bits where that is safe, else in whole numbers of any size."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, total))
    if most * most * len(total) < 1 << 63:
        y = n * x - np.array(total, np.int64)
        return (y * y).sum(axis=1).tolist()
    exact = (sum((n * int(a) - s) ** 2 for a, s in zip(row, total)) for row in x)
    return [v if v < 1 << 63 else None for v in exact]


def apply_whitening(vectors: DataFrame, model: Whitening, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per valid vector and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error``. Map-only."""
    source = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).alias("x"))
    k, mean = len(model.values), np.array([s / model.n for s in model.sums])
    turn, shares = model.vectors / np.sqrt(model.values), model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _vectors(batch.column(1), model.dim):
                r = len(rows)
                ids = batch.column(0).take(pa.array(np.repeat(rows, k)))
                deviation = pa.array(_deviations(x, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(r), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)), pa.array(np.full(r * k, model.n)), deviation,
                     pa.array(((x - mean) @ turn).ravel()), pa.array(np.tile(shares, r)), pa.array(np.full(r * k, model.identity_error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double").withColumnRenamed("id", vec_id)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 4) -> DataFrame:
    """Fit on ``vectors`` and project them."""
    model = fit_whitening(vectors, embedding, components)
    if model is None:
        kind = vectors.schema[vec_id].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return apply_whitening(vectors, model, vec_id, embedding)
