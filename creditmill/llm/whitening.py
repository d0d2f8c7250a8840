"""Whitening of embeddings by QDWH spectral divide-and-conquer.

Entries become whole numbers, so counts, sums and products are exact sums of integers that Spark adds in any order. One
pass finds the mean, a second the covariance of what is left once the mean's whole part is taken off. Only the d x d
covariance reaches the driver. There it is shifted into the middle of its spectrum, and the polar factor of the shifted
matrix, found by dynamically weighted Halley steps on QR factorisations, gives the projector on the space of the larger
eigenvalues. Each of the two spaces is split again, until every space is a component. The projections of a few components,
scaled by the root of their eigenvalue, travel with the tasks that whiten the rows.
"""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
LARGEST = 1 << 40  # whole numbers up to which an entry counts as finite
EPS = np.finfo(float).eps
ROWS = 1024  # rows worked on together


# --- symmetric eigenvalues by polar decompositions ------------------------------------------------------------------

def polar_factor(a: np.ndarray, most_steps: int = 60) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QR-based dynamically weighted Halley steps.

    A singular matrix has none; the steps then end without one, which `split` sees from the trace.
    """
    n = len(a)
    size = np.linalg.norm(a)  # at least the largest singular value
    if not size:
        return np.zeros_like(a)
    x, low = a / size, EPS
    for _ in range(most_steps):
        low2 = low * low
        d = np.cbrt(4 * (1 - low2) / (low2 * low2))
        root = np.sqrt(1 + d)
        weight_a = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low2) / (low2 * root), 0.0))
        weight_b = (weight_a - 1) ** 2 / 4
        weight_c = weight_a + weight_b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(weight_c) * x, np.eye(n)]))
        step = weight_b / weight_c * x + (weight_a - weight_b / weight_c) / np.sqrt(weight_c) * (q[:n] @ q[n:].T)
        step = (step + step.T) / 2
        moved, x = np.linalg.norm(step - x), step
        low = min(low * (weight_a + weight_b * low2) / (1 + weight_c * low2), 1.0)
        if low > 1 - 10 * EPS and moved < np.cbrt(EPS):
            break
    return x


def split(h: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of `h`, larger eigenvalues first; None if all eigenvalues are equal."""
    n, scale = len(h), np.linalg.norm(h)
    mean = float(np.trace(h)) / n  # lies between the smallest and the largest eigenvalue unless all are equal
    spread = np.linalg.norm(h - mean * np.eye(n))
    if spread <= n * EPS * scale:
        return None
    for attempt in range(40):
        shift = float(np.median(np.diag(h))) if not attempt else mean + spread / np.sqrt(n) * rng.uniform(-0.3, 0.3) * (attempt > 1)
        u = polar_factor(h - shift * np.eye(n))
        upper = int(round((n + np.trace(u)) / 2))
        if not 0 < upper < n or np.linalg.norm(u @ u - np.eye(n)) > 1e-8 * n:
            continue  # nothing on one side, or the shift met an eigenvalue
        # columns of each projector times random ones, then once more, span the two spaces
        p = (np.eye(n) + u) / 2
        first, _ = np.linalg.qr(p @ rng.standard_normal((n, upper)))
        first, _ = np.linalg.qr(p @ first)
        second = (np.eye(n) - p) @ rng.standard_normal((n, n - upper))
        second, _ = np.linalg.qr(second - first @ (first.T @ second))
        second, _ = np.linalg.qr(second - first @ (first.T @ second))
        if np.linalg.norm(first.T @ h @ second) <= 100 * n * EPS * scale:
            return first, second
    raise ArithmeticError("no shift splits the spectrum")


def components(h: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Spaces below those that are asked for are not split. Equal eigenvalues keep any basis of their space.
    """
    n, rng = len(h), np.random.default_rng(1)
    done: list[np.ndarray] = []
    open_spaces = [np.eye(n)]  # the largest eigenvalues last
    while open_spaces and sum(b.shape[1] for b in done) < most:
        basis = open_spaces.pop()
        part = basis.T @ h @ basis
        halves = split((part + part.T) / 2, rng) if basis.shape[1] > 1 else None
        if halves is None:
            done.append(basis)
        else:
            open_spaces += [basis @ halves[1], basis @ halves[0]]
    basis, _ = np.linalg.qr(np.hstack(done)[:, :most]) if done else (np.zeros((n, 0)), None)
    values = np.einsum("ij,ij->j", basis, h @ basis)
    order = np.argsort(-values, kind="stable")
    return values[order], basis[:, order]


# --- over rows --------------------------------------------------------------------------------------------------

def whole_numbers(column: pa.Array, scale: int, offset: int, width: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows remain, and their entries as whole numbers; with no `width` only the first, and all lengths."""
    column = column.cast(pa.list_(pa.float64()))
    known = np.asarray(column.is_valid())
    length = np.where(known, np.asarray(column.value_lengths().fill_null(0)), -1)
    flat = column.flatten()
    entry = np.floor(scale * flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(float))
    fine = np.isfinite(entry) & (np.abs(entry) < LARGEST)
    ends = np.cumsum(np.maximum(length, 0))
    bad = np.concatenate([[0], np.cumsum(~fine)])
    clean = known & (bad[ends] == bad[ends - np.maximum(length, 0)])
    if width is None:
        return np.flatnonzero(clean), length
    rows = np.flatnonzero(clean & (length == width))
    at = (ends - np.maximum(length, 0))[rows][:, None] + np.arange(width)
    return rows, entry[at].astype(np.int64) + offset if width and len(rows) else np.zeros((len(rows), width), np.int64)


def exact_product(y: np.ndarray) -> list[np.ndarray]:
    """y'y of a matrix of whole numbers, as matrices of longs whose sum it is."""
    most = int(np.abs(y).max(initial=0))
    if most * most >= 1 << 52:  # beyond what doubles hold: by 20-bit digits
        high, low = y >> 20, y & ((1 << 20) - 1)
        raise_to = (1 << 40, 1 << 20, 1)
        hh, hl, ll = (exact_product_of(a, b) for a, b in ((high, high), (high, low), (low, low)))
        return [hh.astype(object) * raise_to[0] + (hl + hl.T).astype(object) * raise_to[1] + ll.astype(object)]
    step = max(1, (1 << 52) // max(most * most, 1))
    return [(f.T @ f).astype(np.int64) for f in (y[k:k + step].astype(float) for k in range(0, len(y), step))]


def exact_product_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.T @ b  # longs: digits of 20 and 21 bits over at most ROWS rows


class _Sum:
    """Sums of whole numbers: in longs as long as they fit, handed on before they could overflow."""

    def __init__(self, size: int):
        self.total = np.zeros(size, object)
        self.fast, self.room = np.zeros(size, np.int64), 1 << 62

    def add(self, x: np.ndarray) -> None:
        x = x.ravel()
        if x.dtype == object:
            self.total = self.total + x
            return
        most = int(np.abs(x).max(initial=0))
        if most >= self.room:
            self.flush()
        self.fast += x
        self.room -= most

    def flush(self) -> None:
        self.total = self.total + self.fast.astype(object)
        self.fast, self.room = np.zeros_like(self.fast), 1 << 62


def _summed(vectors: DataFrame, size: int, add: Callable[[_Sum, pa.Array], None]) -> list[int]:
    """Sums over all rows: each task hands on one number a place, and Spark adds them by place."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Sum(size)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                add(total, batch.column(0).slice(at, ROWS))
        total.flush()
        places = np.flatnonzero(total.total)
        for at in range(0, len(places), 1 << 14):
            part = places[at:at + (1 << 14)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total.total[part].tolist(), pa.decimal128(38, 0))],
                                             ["place", "n"])

    told = vectors.mapInArrow(run, "place int, n decimal(38,0)").groupBy("place").agg(F.sum("n").alias("n")).collect()
    out = [0] * size
    for r in told:
        out[r["place"]] = int(r["n"])
    return out


@dataclass
class Whitening:
    """What is fitted: rows, sums, eigenvalues and unit eigenvectors (columns), trace, and the measured identity error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int = SCALE
    offset: int = OFFSET
    identity_error: float = 0.0

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, max(self.n, 1))) for s in self.sums])

    @property
    def real(self) -> np.ndarray:
        """Which components vary at all."""
        return self.values > 8 * self.width * EPS * max(self.trace, 0.0)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of whole numbers; NaN on components that do not vary."""
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.where(self.real, np.sqrt(np.maximum(self.values, 0)), np.nan)
            return ((x - self.mean) @ self.vectors) / root

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n*x - S)^2, exactly."""
        most = max(int(np.abs(x).max(initial=0)) * self.n, *(abs(s) for s in self.sums), 0) if self.sums else 0
        if most < 1 << 61:
            y = self.n * x - np.array(self.sums, np.int64)
            if int(np.abs(y).max(initial=0)) ** 2 * max(self.width, 1) < 1 << 62:
                return (y * y).sum(axis=1).tolist()
        y = x.astype(object) * self.n - np.array(self.sums, object)
        return [int(sum(v * v for v in row)) for row in y]


def usual_width(vectors: DataFrame, scale: int = SCALE) -> int:
    """The most frequent length among clean vectors that are not empty, of equals the largest."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows, length = whole_numbers(batch.column(0).slice(at, ROWS), scale, 0, None)
                for k, n in zip(*np.unique(length[rows], return_counts=True)):
                    if k:
                        seen[int(k)] = seen.get(int(k), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["width", "n"])

    best = (vectors.mapInArrow(run, "width int, n bigint").groupBy("width").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), F.desc("width")).limit(1).collect())
    return best[0]["width"] if best else 0


def fit(vectors: DataFrame, components_most: int = COMPONENTS, vector: str = "embedding", scale: int = SCALE,
        offset: int = OFFSET) -> Whitening:
    """Fit on all clean vectors of the most frequent length, in four passes over the one column."""
    only = vectors.select(F.col(vector).cast("array<double>").alias("v"))
    width = usual_width(only, scale)

    def add_sums(total: _Sum, column: pa.Array) -> None:
        rows, x = whole_numbers(column, scale, offset, width)
        total.add(np.append(x.sum(axis=0), len(rows)).astype(np.int64))

    *sums, n = _summed(only, width + 1, add_sums)
    if not n or not width:
        return Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0, scale, offset)
    middle = np.array([s // n for s in sums], np.int64)

    def add_products(total: _Sum, column: pa.Array) -> None:
        _, x = whole_numbers(column, scale, offset, width)
        for part in exact_product(x - middle):
            total.add(part)

    products = _summed(only, width * width, add_products)
    rest = [s - n * int(m) for s, m in zip(sums, middle)]  # sums of what is centred, each between 0 and n
    v = np.array([[float(Fraction(n * products[i * width + j] - rest[i] * rest[j], n * n)) for j in range(width)]
                  for i in range(width)])
    values, basis = components(v, min(components_most, width))
    fitted = Whitening(n, sums, values, basis, float(np.trace(v)), scale, offset)
    fitted.identity_error = _identity_error(only, fitted)
    return fitted


def _identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on all rows."""
    real = np.flatnonzero(fitted.real)
    k, width, scale, offset = len(real), fitted.width, fitted.scale, fitted.offset

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k + k)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                _, x = whole_numbers(batch.column(0).slice(at, ROWS), scale, offset, width)
                w = fitted.apply(x)[:, real]
                total += np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["place", "s"])

    if not k:
        return 0.0
    told = vectors.mapInArrow(run, "place int, s double").groupBy("place").agg(F.sum("s").alias("s")).collect()
    total = np.zeros(k * k + k)
    for r in told:
        total[r["place"]] = r["s"]
    mean = total[k * k:] / fitted.n
    return float(np.abs(total[:k * k].reshape(k, k) / fitted.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, fitted: Whitening, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per clean vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    schema = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    k = len(fitted.values)
    explained = fitted.values / fitted.trace if fitted.trace > 0 else np.full(k, np.nan)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows, x = whole_numbers(part.column(1), fitted.scale, fitted.offset, fitted.width)
                if not len(rows) or not k:
                    continue
                m = len(rows) * k
                ids = part.column(0).take(pa.array(np.repeat(rows, k)))
                far = pa.array(fitted.deviation(x), pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(len(rows)), k)))
                white, share = (pa.array(a, mask=np.isnan(a)) for a in (fitted.apply(x).ravel(), np.tile(explained, len(rows))))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(m, fitted.n)), far, white,
                     share, pa.array(np.full(m, fitted.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col(key).cast("bigint"), F.col(vector).cast("array<double>")).mapInArrow(run, schema)


def whitening(vectors: DataFrame, components_most: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Fit on `vectors` and whiten them.

    Vectors that are null, hold a null, an entry that is not finite (or of 2^40 / 1024 and more in size), or have not the
    most frequent length, are left out of the fit and the result. Rows that repeat a key, or have none, are rows like any
    other. A component that does not vary (equal rows, fewer rows than dimensions) has whitened null, and explained null if
    nothing varies. An empty table, or one of empty vectors, gives no rows. Other columns are not read. A deviation beyond
    38 digits raises an error.
    """
    return whiten(vectors, fit(vectors, components_most, vector), vector, key)
