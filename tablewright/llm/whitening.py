"""Whitening of embeddings: principal components of unit variance.

Three passes over the vectors, each with narrow results that merge in levels: exact sums, the
covariance of the centred vectors, and the covariance of the whitened ones. The d x d covariance (d
is the vectors' length) goes to the driver, where it is brought to tridiagonal form by Householder
reflections; its leading eigenvalues are bisected by Sturm counts, and their vectors found by inverse
iteration, orthogonalised again within clusters. The projection (d x ``most`` numbers) is broadcast.

Defined cases: vectors that are null or hold a null, NaN or infinite entry are dropped, as are those
whose length is not the table's (that of most vectors, the longer if several), and empty ones. Rows
that repeat count as often as they occur, null vec_ids included. Components whose eigenvalue vanishes
(up to rounding) can't be whitened and are left out, so a table of equal vectors gives no row, as
does an empty one. A deviation that a long can't hold is null. Entries beyond 2^41 or so, of which
``grid`` has no exact double, raise an error. Columns of the caller's other than vec_id and the
vector are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.runtime import ship_package

ROWS = 2048  # vectors that a task holds as doubles at a time
EXACT = 1 << 52


def grid(values: np.ndarray) -> np.ndarray:
    """Entries as whole numbers: floor(1024 * c) + 100000."""
    scaled = np.floor(values.astype(np.float64) * 1024)
    if scaled.size and np.abs(scaled).max() > EXACT:
        raise OverflowError("an entry is too large for exact whole numbers")
    return scaled.astype(np.int64) + 100_000


def vectors(record: pa.RecordBatch, column: str, width: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a batch hold a whole finite vector of ``width`` entries, and those vectors."""
    lists = record.column(column)
    if len(lists) == 0:
        return np.zeros(0, np.int64), np.zeros((0, width or 0))
    flat = lists.flatten()  # the entries of lists that are not null
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    entries = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    sound = (sizes > 0) & (bad[ends] == bad[ends - sizes]) & (True if width is None else sizes == width)
    at = np.flatnonzero(sound)
    if width is None:
        return at, sizes[at]
    return at, entries[(ends[at] - width)[:, None] + np.arange(width)] if len(at) else np.zeros((0, width))


def pieces(records, column: str, width: int):
    """(batch, row numbers, vectors) of at most ROWS rows."""
    for record in records:
        for start in range(0, record.num_rows, ROWS):
            part = record.slice(start, ROWS)
            yield part, *vectors(part, column, width)


PARTIAL = "piece int, task long, total binary"


def merged(partials: DataFrame, kind: type, fan_in: int = 128) -> dict[int, np.ndarray]:
    """The sums of all tasks' arrays by piece, in as many levels as leave at most ``fan_in`` arrays
    to a group; in the order of tasks, so that one layout gives one sum."""

    def added(pdf):
        pdf = pdf.sort_values("task")
        total = sum(np.frombuffer(t, kind) for t in pdf["total"])
        return pdf.iloc[:1].assign(task=pdf["task"].iloc[0] // fan_in, total=[total.tobytes()])

    left = partials.rdd.getNumPartitions()
    while left:
        left = left // fan_in if left > 1 else 0
        partials = partials.groupBy("piece", F.expr(f"task div {fan_in}").alias("part")).applyInPandas(added, PARTIAL)
    return {r.piece: np.frombuffer(bytes(r.total), kind) for r in partials.collect()}  # one row a piece


def partial(pieces: list[np.ndarray]) -> pa.RecordBatch:
    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array([task] * len(pieces), pa.int64()), pa.array([p.tobytes() for p in pieces], pa.binary())], names=["piece", "task", "total"])


def width_of(rows: DataFrame, column: str) -> int | None:
    """The length of most sound vectors."""

    def sizes(records):
        for record in records:
            _, found = vectors(record, column, None)
            width, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(width, pa.int32()), pa.array(n, pa.int64())], names=["width", "n"])

    best = rows.select(column).mapInArrow(sizes, "width int, n long").groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    return best[0].width if best else None


def sums(rows: DataFrame, column: str, width: int) -> tuple[int, np.ndarray]:
    """How many vectors there are, and the sum of each dimension; exact."""

    def task(records):
        n, total = 0, np.zeros(width, np.int64)
        for _, at, found in pieces(records, column, width):
            n += len(at)
            total += grid(found).sum(axis=0)
        yield partial([np.array([n, *total])])

    out = merged(rows.select(column).mapInArrow(task, PARTIAL), np.int64)[0]
    return int(out[0]), out[1:]


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - S / n; the whole parts go first, so no digit is lost however far S / n is from 0."""
    whole, rest = np.divmod(total, n)
    return (x - whole).astype(np.float64) - rest / n


def covariance(rows: DataFrame, column: str, n: int, total: np.ndarray, onto: np.ndarray | None = None) -> np.ndarray:
    """The covariance, divisor n, of the centred vectors, or of their projection by ``onto``."""
    width = len(total)
    size = width if onto is None else onto.shape[1]
    height = max(1, 65_536 // size)  # rows of the matrix that travel together

    def task(records):
        scatter = np.zeros((size, size))
        for _, _, found in pieces(records, column, width):
            d = centred(grid(found), n, total)
            d = d if onto is None else d @ onto
            scatter += d.T @ d
        yield partial([scatter[i : i + height] for i in range(0, size, height)])

    found = merged(rows.select(column).mapInArrow(task, PARTIAL), np.float64)
    v = np.concatenate([found[i] for i in sorted(found)]).reshape(size, size) / n
    return (v + v.T) / 2


# eigenvectors of a symmetric matrix
def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflections (unit vectors, or empty) of Householder's reduction."""
    a, reflections = v.copy(), []
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(x)
        if length == 0 or not np.abs(a[k + 2 :, k]).any():
            reflections.append(np.zeros(0))
            continue
        u = x / length
        reflections.append(u)
        # H A H on the rest, by a symmetric change of rank two; the column becomes (alpha, 0, ...)
        a[k + 1 :, k] -= 2 * u * (u @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        rest = a[k + 1 :, k + 1 :]
        p = rest @ u
        q = p - u * (u @ p)
        rest -= 2 * (np.outer(u, q) + np.outer(q, u))
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def below(d: np.ndarray, e: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """How many eigenvalues lie below each point: negative pivots of T - point (Sturm's count)."""
    count, q = np.zeros(len(at), np.int64), np.ones(len(at))
    for i in range(len(d)):
        q = d[i] - at - (e[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading(d: np.ndarray, e: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, by bisection."""
    radius = np.abs(np.concatenate([[0], e])) + np.abs(np.concatenate([e, [0]]))
    scale = max(np.abs(d).max() + radius.max(), np.finfo(float).tiny)
    tiny = scale * np.finfo(float).eps ** 2
    wanted = len(d) - 1 - np.arange(most)  # how many are smaller
    low, high = np.full(most, (d - radius).min() - scale * 1e-15), np.full(most, (d + radius).max() + scale * 1e-15)
    for _ in range(128):
        middle = (low + high) / 2
        up = below(d, e, middle, tiny) <= wanted
        low, high = np.where(up, middle, low), np.where(up, high, middle)
        if np.all(high - low <= 2 * np.spacing(np.maximum(np.abs(low), np.abs(high)))):
            break
    return (low + high) / 2


def solver(d: np.ndarray, e: np.ndarray, at: float, tiny: float):
    """Solves (T - at) y = b, by elimination with row exchanges done once."""
    n = len(d)
    main, upper, second = d - at, np.append(e, 0.0), np.zeros(n)
    steps = []
    for i in range(n - 1):
        if abs(main[i]) >= abs(e[i]):
            main[i] = main[i] if abs(main[i]) > tiny else tiny
            factor = e[i] / main[i]
            steps.append((False, factor))
            main[i + 1] -= factor * upper[i]
        else:  # row i + 1 becomes the pivot row
            factor = main[i] / e[i]
            steps.append((True, factor))
            main[i], upper[i], second[i], main[i + 1], upper[i + 1] = e[i], main[i + 1], upper[i + 1], upper[i] - factor * main[i + 1], -factor * upper[i + 1]
    main[-1] = main[-1] if abs(main[-1]) > tiny else tiny

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.copy()
        for i, (swap, factor) in enumerate(steps):
            if swap:
                y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
            else:
                y[i + 1] -= factor * y[i]
        for i in range(n - 1, -1, -1):
            rest = y[i] - (upper[i] * y[i + 1] if i + 1 < n else 0) - (second[i] * y[i + 2] if i + 2 < n else 0)
            y[i] = rest / main[i]
            if abs(y[i]) > 1e200:
                y *= 1e-200
        return y

    return solve


def inverse_iteration(d: np.ndarray, e: np.ndarray, values: np.ndarray, rounds: int = 4, cluster: float = 1e-3) -> np.ndarray:
    """Unit eigenvectors, a column for each of the falling ``values``. Those closer together than
    ``cluster`` times the norm are made orthogonal to each other in each round."""
    n, random = len(d), np.random.default_rng(5)
    norm = max(np.abs(d).max() + 2 * np.abs(e).max(initial=0), np.finfo(float).tiny)
    eps = np.finfo(float).eps
    out, start, last = np.zeros((n, len(values))), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > cluster * norm:
            start = k
        # equal values are moved apart, as one shift would give one vector again
        last = value if k == start else min(value, last - 10 * eps * norm)
        solve, y = solver(d, e, last, eps * norm), random.normal(size=n)
        for _ in range(rounds):
            for _ in range(2):
                y -= out[:, start:k] @ (out[:, start:k].T @ y)
            y = solve(y / np.linalg.norm(y))
            y /= np.abs(y).max()
        for _ in range(2):
            y -= out[:, start:k] @ (out[:, start:k].T @ y)
        out[:, k] = y / np.linalg.norm(y)
    return out


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues of a covariance, falling, and unit eigenvectors as columns; those that
    vanish up to rounding are left out."""
    scale = np.abs(v).max(initial=0)
    if scale == 0:
        return np.zeros(0), np.zeros((len(v), 0))
    d, e, reflections = tridiagonal(v / scale)
    values = leading(d, e, min(most, len(d)))
    values = values[values > len(d) * np.finfo(float).eps * max(values.max(initial=0), 0)]
    out = inverse_iteration(d, e, values)
    for k in range(len(reflections) - 1, -1, -1):
        u = reflections[k]
        if len(u):
            out[k + 1 :] -= 2 * np.outer(u, u @ out[k + 1 :])
    return values * scale, out


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2, exact; None where a long can't hold it."""
    whole, rest = np.divmod(total, n)
    shifted = x - whole
    most = int(np.abs(shifted).max(initial=0)) * n + n  # bounds |n * x - S|
    if most * most * len(total) < 1 << 63:
        return ((n * shifted - rest) ** 2).sum(axis=1).tolist()
    exact = ((n * shifted.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
    return [int(s) if s < 1 << 63 else None for s in exact]


def whiten(rows: DataFrame, column: str = "embedding", most: int = 8) -> DataFrame:
    """vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained and
    identity_error for each sound vector and each of at most ``most`` components."""
    spark = rows.sparkSession
    ship_package(spark)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias(column))
    width = width_of(rows, column)
    if width is None:
        return spark.createDataFrame([], OUT)
    n, total = sums(rows, column, width)
    v = covariance(rows, column, n, total)
    values, vectors_ = components(v, most)
    if not len(values):
        return spark.createDataFrame([], OUT)
    onto = vectors_ / np.sqrt(values)
    error = float(np.abs(covariance(rows, column, n, total, onto) - np.eye(len(values))).max())
    explained, k = values / np.trace(v), len(values)
    sent = spark.sparkContext.broadcast((onto, explained))

    def projected(records):
        onto, explained = sent.value
        for part, at, found in pieces(records, column, width):
            x = grid(found)
            if not len(at):
                continue
            ids = part.column("vec_id").take(pa.array(np.repeat(at, k)))
            m = len(at)
            arrays = [ids, pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n)), pa.array([s for s in deviations(x, n, total) for _ in range(k)], pa.int64()), pa.array((centred(x, n, total) @ onto).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in OUT.split(", ")])

    return rows.mapInArrow(projected, OUT)
