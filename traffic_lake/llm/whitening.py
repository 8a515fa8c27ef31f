"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers, so that sums and centres are exact. The covariance V is
never formed: a pass over the rows gives V Q for a block Q of some columns more
than are wanted, as ``C'(C Q)`` of the centred rows C, summed per task and then
over the tasks. Rounds of such passes follow:

1. Rayleigh-Ritz: the small problem ``Q' V Q`` gives eigenvalues and vectors of
   the block, and V Q their residuals.
2. Filter: a Chebyshev polynomial of V, by its three-term recurrence, stays small
   between 0 and the block's smallest eigenvalue, where all unwanted ones lie,
   and grows fast above; then QR.

until the residuals of the wanted components are at the level of rounding, or
stop falling below a certified bound. Only blocks of dimension x columns
reach the driver, added up in two steps where there are many tasks.

Rows whose vector is NULL, empty, or holds a NULL, NaN or infinite entry or one
beyond ``LARGEST`` are left out, as are those whose length isn't the most common
one (of equally common the greatest). Ids may be NULL or repeat; repeated rows
count each time. Components whose eigenvalue is under ``LEAST`` of the greatest
aren't told from zero and don't appear, so equal vectors only, or an empty table, give an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, stored

#: Entries of a greater size don't become exact integers.
LARGEST = 2.0**40
#: Columns of the block besides those wanted.
GUARD = 16
#: Eigenvalues under this share of the greatest count as zero.
LEAST = 1e-9
#: The filter's degree at most, and by how much it may raise the greatest direction above the least of the block.
DEGREE, RAISED = 12, 1e12
#: Residuals, as shares of the greatest eigenvalue: a bound that must be met, and rounding.
CERTIFIED, ROUNDING = 1e-11, 1e-15
ROUNDS = 200
#: Partial sums of so many tasks go to the driver; of more, they're added up in tasks first.
TASKS = 64
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Rows:
    """Stored rows ``vec_id`` and ``x`` (64-bit integers, one after another), their dimension (0 without rows), and how many tasks read them."""

    table: DataFrame
    d: int
    tasks: int


@dataclass
class Fit:
    """What the rows gave: their number, sums per dimension, components (columns) by falling eigenvalue, and how it went."""

    n: int
    sums: list[int]
    widest: int
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray
    residuals: np.ndarray
    passes: int


def _integers(column: pa.Array, d: int) -> np.ndarray:
    """A stored binary column of ``d`` 64-bit integers a row, as a matrix."""
    if not len(column):
        return np.empty((0, d), np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.int64).reshape(-1, d)


def prepared(vectors: DataFrame, vector: str = "embedding", id_col: str = "vec_id") -> Rows:
    """The usable rows, with entries as integers."""
    entry = F.col("v")
    fine = F.coalesce(F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST)), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(fine & (F.size("v") > 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = sizes[0]["d"] if sizes else 0

    def pack(batches):
        for b in batches:
            x = np.floor(64 * b.column("v").flatten().to_numpy(zero_copy_only=False)).astype(np.int64) + 1_000_000
            at = np.arange(b.num_rows + 1, dtype=np.int32) * (8 * d)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.BinaryArray.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(at), pa.py_buffer(x)])], ["vec_id", "x"]
            )

    packed = rows.filter(F.size("v") == d).mapInArrow(pack, "vec_id long, x binary")
    table = stored(packed, f"{scratch(vectors.sparkSession, 'whitening')}/rows")
    return Rows(table, d, table.rdd.getNumPartitions())


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as integers and what is left of it, so that centred entries are rounded once."""
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole)])


def _summed(rows: Rows, shape: tuple[int, ...], add: Callable[[np.ndarray], np.ndarray], centre) -> np.ndarray:
    """The sum over all rows of ``add`` of a block of centred rows."""
    d, (whole, part) = rows.d, centre

    def block(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(shape)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                total += add((_integers(b.column("x").slice(at, 4096), d) - whole).astype(np.float64) - part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    def merge(batches):
        total = np.zeros(shape)
        for b in batches:
            for one in b.column("total"):
                total += np.frombuffer(one.as_buffer(), np.float64).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    totals = rows.table.select("x").mapInArrow(block, "total binary")
    if rows.tasks > TASKS:
        totals = totals.repartition(int(rows.tasks**0.5)).mapInArrow(merge, "total binary")
    out = np.zeros(shape)
    for row in totals.toArrow()["total"].to_pylist():
        out += np.frombuffer(row, np.float64).reshape(shape)
    return out


def _sums(rows: Rows) -> tuple[int, list[int], int]:
    """Number of rows, exact sums per dimension, and the widest range of a dimension."""
    d = rows.d

    def partial(batches):
        total, n = [0] * d, 0
        least, most = np.full(d, np.iinfo(np.int64).max), np.full(d, np.iinfo(np.int64).min)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                x = _integers(b.column("x").slice(at, 4096), d)
                total = [t + s for t, s in zip(total, x.sum(axis=0).tolist())]
                least, most, n = np.minimum(least, x.min(axis=0)), np.maximum(most, x.max(axis=0)), n + len(x)
        if n:
            columns = [range(d), [n] * d, [t >> 32 for t in total], [t & 0xFFFFFFFF for t in total], least, most]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["i", "n", "high", "low", "least", "most"])

    found = rows.table.select("x").mapInArrow(partial, "i long, n long, high long, low long, least long, most long").groupBy("i")
    found = found.agg(F.sum("n"), F.sum("high"), F.sum("low"), F.min("least"), F.max("most")).collect()
    found = sorted(tuple(r) for r in found)
    return found[0][1], [(r[2] << 32) + r[3] for r in found], max(r[5] - r[4] for r in found)


def _growth(value: float, upper: float, degree: int) -> float:
    """How the filter of a degree raises an eigenvalue at or above ``upper``."""
    return float(np.cosh(degree * np.arccosh(max(1.0, 2 * value / upper - 1))))


def fit(rows: Rows, wanted: int = 32) -> Fit | None:
    """The first ``wanted`` components of the covariance of the prepared rows; None without rows or without variance."""
    if not rows.d:
        return None
    d, (n, sums, widest) = rows.d, _sums(rows)
    centre, passes = _centre(n, sums), 0

    def product(Q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return _summed(rows, Q.shape, lambda C: C.T @ (C @ Q), centre) / n

    trace = float(_summed(rows, (d,), lambda C: (C * C).sum(axis=0), centre).sum() / n)
    if trace == 0:
        return None
    m = min(d, wanted + GUARD)
    Q = np.linalg.qr(np.random.default_rng(12).standard_normal((d, m)))[0]
    before = np.inf
    for _ in range(ROUNDS):
        Z = product(Q)
        small = Q.T @ Z
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        values, turn = values[order], turn[:, order]
        Q, Z = Q @ turn, Z @ turn
        residuals = np.linalg.norm(Z - Q * values, axis=0) / values[0]
        keep = min(wanted, int((values > LEAST * values[0]).sum()))
        worst = residuals[:keep].max()
        if worst <= ROUNDING * d**0.5 or (worst <= CERTIFIED and worst > before / 4):
            break
        before = worst
        upper = max(values[-1], LEAST * values[0] / 1000)
        degree = max((k for k in range(2, DEGREE + 1) if _growth(values[0], upper, k) <= RAISED * _growth(values[keep - 1], upper, k)), default=2)
        half, last, now = upper / 2, Q, Z / (upper / 2) - Q
        for _ in range(degree - 1):
            last, now = now, 2 * (product(now) / half - now) - last
        Q = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
    else:
        raise ArithmeticError(f"components aren't certified after {passes} passes; residual {worst:.1e}")
    Q = Q[:, :keep] * np.sign(Q[np.abs(Q[:, :keep]).argmax(axis=0), np.arange(keep)])
    return Fit(n, sums, widest, trace, values[:keep], Q, residuals[:keep], passes)


def whiten(rows: Rows, model: Fit) -> DataFrame:
    """A row for each prepared row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is NULL where it passes 64 bits.
    """
    d, k = model.components.shape
    n, whole, part = model.n, *_centre(model.n, model.sums)
    project = model.components / np.sqrt(model.eigenvalues)

    def moments(C):
        W = C @ project
        return np.vstack([W.T @ W, W.sum(axis=0)])

    found = _summed(rows, (k + 1, k), moments, (whole, part)) / n
    identity_error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    rest = [s - int(w) * n for s, w in zip(model.sums, whole)]
    narrow = d * (n * (model.widest + 1)) ** 2 < 1 << 63
    explained = model.eigenvalues / model.trace
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def rows_of(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                ids, x = b.column("vec_id").slice(at, 1024), _integers(b.column("x").slice(at, 1024), d) - whole
                W = (x.astype(np.float64) - part) @ project
                off = x if narrow else x.astype(object)
                off = ((off * n - np.array(rest, off.dtype)) ** 2).sum(axis=1).tolist()
                off = pa.array([v if v < 1 << 63 else None for v in off], pa.int64())
                each = pa.array(np.repeat(np.arange(len(ids)), k))
                size = len(ids) * k
                constant = lambda v, t: pa.array(np.full(size, v), t)
                columns = [ids.take(each), np.tile(np.arange(1, k + 1), len(ids)), constant(n, pa.int64()), off.take(each), W.ravel()]
                columns += [np.tile(explained, len(ids)), constant(identity_error, pa.float64())]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names)

    return rows.table.mapInArrow(rows_of, SCHEMA)


def whitened(vectors: DataFrame, wanted: int = 32, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """Fit and whiten; see ``whiten`` for the columns."""
    rows = prepared(vectors, vector, id_col)
    model = fit(rows, wanted)
    if model is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    return whiten(rows, model)
